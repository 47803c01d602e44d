"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant;
all others are users with their name in the header, and only the speaker's own turns are in the loss mask.

A dialogue is rendered in blocks of `block_turns` consecutive turns by rank, so a conversation with a third of
all rows is never gathered in one row or task: a dialogue of up to that many turns is one row, a longer one
continues in the next block, which begins with the dialogue's opening system turn again. Ranks come from ranges of
(conversation, turn): a place inside a range plus the number of the conversation's turns in the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.llm.common import partitions, table, written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BLOCK_TURNS = 64


def _header(role: Column, speaker: Column, system_role: str) -> Column:
    label = F.when(role == speaker, F.lit("assistant")).when(role == system_role, F.lit("system"))
    return F.concat(F.lit(OPEN), label.otherwise(F.concat(F.lit("user name="), role)), F.lit("\n"))


def ranked(rows: DataFrame) -> DataFrame:
    """Turns with their `rank` in the conversation, from 0; no task holds a whole conversation that is large."""
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), F.col("row")]
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), F.col("conv_id"), *order)
    dealt = written(dealt.withColumn("range", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("range", "conv_id").orderBy(*order)
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(
        F.col("conv_id").alias("in_conv"), F.col("range").alias("in_range"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    placed = dealt.withColumn("place", F.row_number().over(inside) - 1)
    joined = placed.join(counts, (F.col("range") == F.col("in_range")) & F.col("conv_id").eqNullSafe(F.col("in_conv")))
    return joined.select("conv_id", "role", "text", (F.col("place") + F.col("before")).alias("rank"))


def rotate(turns: DataFrame, *, block_turns: int = BLOCK_TURNS, system_role: str = "system") -> DataFrame:
    """Turns (conv_id, turn, role, text) to one row per conversation, speaker and block.

    Columns: conv_id, speaker, block (rank of the turn // block_turns), n_turns, text, mask (spans of the
    speaker's contents with their end marker, in characters of `text`, end exclusive). If the first turn is a
    system turn, later blocks begin with it too; `n_turns` counts a block's own turns.

    Turns are ordered by number, nulls last, then by role and text, so ties have a fixed order; gaps between
    numbers don't matter. A null text is empty, a null role is the participant "unknown", null conv_ids are one
    conversation. System turns are context: they are rendered in every perspective and give none, so a
    conversation without other turns has no rows. Repeated rows are repeated turns. Other columns are ignored.
    """
    role = F.coalesce(F.col("role"), F.lit("unknown"))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = written(ranked(rows), "ranked-turns").withColumn("block", F.floor(F.col("rank") / block_turns).cast("long"))
    blocks = numbered.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("rank", "role", "text"))).alias("said")
    )
    opening = numbered.where((F.col("rank") == 0) & (F.col("role") == system_role)).select(
        F.col("conv_id").alias("open_conv"), F.array(F.struct("rank", "role", "text")).alias("opening")
    )
    continues = F.col("conv_id").eqNullSafe(F.col("open_conv")) & (F.col("block") > 0)
    blocks = blocks.join(opening, continues, "left").withColumn("n_turns", F.size("said"))
    blocks = blocks.withColumn("said", F.when(F.col("opening").isNull(), F.col("said")).otherwise(F.concat("opening", "said")))
    speakers = rows.where(F.col("role") != system_role).select(
        F.col("conv_id").alias("speaker_conv"), F.col("role").alias("speaker")
    )
    joined = blocks.join(speakers.distinct(), F.col("conv_id").eqNullSafe(F.col("speaker_conv")))
    pieces = F.transform(
        "said",
        lambda t: F.struct(
            _header(t.role, F.col("speaker"), system_role).alias("head"),
            F.concat(t.text, F.lit(CLOSE)).alias("body"),
            (t.role == F.col("speaker")).alias("own"),
        ),
    )
    joined = joined.withColumn("pieces", pieces)
    size = lambda p: F.length(p.head) + F.length(p.body)
    spans = F.transform(
        "pieces",
        lambda p, i: F.struct(
            p.own.alias("own"),
            (
                F.aggregate(F.slice("pieces", F.lit(1), i), F.lit(0), lambda a, q: a + size(q)) + F.length(p.head)
            ).alias("start"),
            F.length(p.body).alias("length"),
        ),
    )
    mask = F.transform(
        F.filter(spans, lambda s: s.own),
        lambda s: F.struct(s.start.alias("start"), (s.start + s.length).alias("end")),
    )
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p.head, p.body)), "")
    return joined.select(
        "conv_id", "speaker", "block", "n_turns", text.alias("text"), mask.alias("mask")
    )


def op2_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from every participant's view; the mask as text `start-end` pairs with commas."""
    out = rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat(s.start.cast("string"), F.lit("-"), s.end.cast("string")))
    return out.withColumn("mask", F.array_join(spans, ","))


OP2_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS n
  FROM conversations),
p AS (
  SELECT *, n // 64 AS block, 1 AS mine FROM t
  UNION ALL
  SELECT t.conv_id, t.role, t.text, -1, unnest(range(1, (SELECT max(n) // 64 + 1 FROM t AS u
                                                         WHERE u.conv_id IS NOT DISTINCT FROM t.conv_id))), 0
  FROM t WHERE n = 0 AND role = 'system'),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (
  SELECT p.conv_id, s.speaker, p.block, p.n, p.mine, p.role = s.speaker AS own,
         '<|im_start|>' || CASE WHEN p.role = s.speaker THEN 'assistant' WHEN p.role = 'system' THEN 'system'
                                ELSE 'user name=' || p.role END || chr(10) AS head,
         p.text || '<|im_end|>' || chr(10) AS body
  FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (
              PARTITION BY conv_id, speaker, block ORDER BY n) - length(body) AS start
  FROM r)
SELECT conv_id, speaker, CAST(block AS BIGINT) AS block, CAST(sum(mine) AS INTEGER) AS n_turns,
       string_agg(head || body, '' ORDER BY n) AS text,
       coalesce(string_agg(CAST(start AS VARCHAR) || '-' || CAST(start + length(body) AS VARCHAR), ',' ORDER BY n)
                FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, speaker, block"""
