"""Product quantisation in integers, with bounds from the net displacement of codebook entries.

Vectors are cut into equal parts; each part position has a codebook of its own, moved by rounds of assignment and
floored means. For every part of a vector two bounds are kept, each stamped with the round it was computed in: an
upper one of the distance to its entry, a lower one of the distance to every other. All codebooks since the first
are kept too. In a later round the upper bound grows by how far its entry is now from where it was in the bound's
round, and the lower one shrinks by the farthest any other entry is from there. That is the norm of the sum of an
entry's moves, which is never more than the sum of their norms, the drift that a bound updated round by round
would gather: an entry that went and came back costs nothing. While the upper bound is below the lower one the part
keeps its entry unseen; else the upper one is made exact, and only if that doesn't do, all entries are compared in
integers, ties to the lower index.

A round reads the rows with their bounds and writes them with the new ones, together with the sums of its parts, in
one table, so it costs one pass and no shuffle but of the sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.llm.common import discard, ship, table, written
from lonja.llm.whole_vectors import (
    Sums,
    by_length,
    collected,
    column_sums,
    doubles,
    fitting,
    floor_mean,
    matrix_of,
    squared,
    usable,
    whole,
)

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SLACK = 1e-9
STATE = ["codes", "upper", "lower", "upper_round", "lower_round"]
KINDS = {"codes": "u1", "upper": "<f8", "lower": "<f8", "upper_round": "u1", "lower_round": "u1"}


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    """Where the parts of a vector lie; equal, or as equal as can be."""
    at = [dim * i // parts for i in range(parts + 1)]
    return list(zip(at, at[1:], strict=False))


class History:
    """The codebooks of one part position since the first round, and how far entries are from where they were."""

    def __init__(self, codebooks: list[np.ndarray]):
        self.entries = codebooks[-1]
        with np.errstate(all="ignore"):
            net = [np.sqrt(doubles(squared(*fitting(self.entries, old)))) for old in codebooks]
            self.net = np.array(net) * (1 + SLACK)  # by round and entry
        k = len(self.entries)
        others = np.where(np.eye(k, dtype=bool)[None], 0.0, self.net[:, None, :])
        self.farthest = others.max(axis=2) if k else self.net  # by round and the entry that is left out

    def rescan(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, distance, distance of the next nearest entry) by comparing with all entries in integers."""
        v, entries = fitting(v, self.entries)
        apart = squared(v[:, None, :], entries[None, :, :])
        code = apart.argmin(axis=1) if apart.dtype != object else np.array([r.index(min(r)) for r in apart.tolist()])
        rows = np.arange(len(v))
        best = np.sqrt(doubles(apart[rows, code]))
        rest = doubles(apart)
        rest[rows, code] = np.inf
        return code, best, np.sqrt(rest.min(axis=1))

    def assign(self, v: np.ndarray, state: dict[str, np.ndarray], now: int) -> np.ndarray:
        """Brings the codes and bounds of some rows up to date; returns which were compared with all entries."""
        code = state["codes"]
        with np.errstate(all="ignore"):
            up = state["upper"] + self.net[state["upper_round"], code]
            low = state["lower"] - self.farthest[state["lower_round"], code]
            doubt = np.flatnonzero(~(up * (1 + SLACK) + SLACK < low))
            exact = np.sqrt(doubles(squared(*fitting(v[doubt], self.entries[code[doubt]]))))
            state["upper"][doubt], state["upper_round"][doubt] = exact, now
            doubt = doubt[~(exact * (1 + SLACK) + SLACK < low[doubt])]
        return self._compared(v, state, doubt, now)

    def _compared(self, v: np.ndarray, state: dict[str, np.ndarray], at: np.ndarray, now: int) -> np.ndarray:
        if len(at):
            state["codes"][at], state["upper"][at], state["lower"][at] = self.rescan(v[at])
            state["upper_round"][at] = state["lower_round"][at] = now
        return at

    def first(self, v: np.ndarray, state: dict[str, np.ndarray]) -> np.ndarray:
        return self._compared(v, state, np.arange(len(v)), 0)


def quantise(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: tuple[str, ...] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    progress: Callable[[int, int, int], None] | None = None,
) -> tuple[DataFrame, dict[int, list[list[list[int]]]]]:
    """(vec_id, codes, error, dim, kept columns under `kept`) per usable row, and each length's final codebooks.

    Null vectors and those with null or non-finite components are left out. Vectors of different lengths have
    codebooks of their own; lengths that can't be cut equally are cut as equally as can be, empty vectors have the
    code 0 throughout. Codebooks start with the smallest vec_ids, null ones last and of equal ids the smaller
    vector first; fewer rows than entries make fewer entries. Repeated rows count as often as they occur. `codes`
    holds one byte per part. An error beyond 64 bits fails the query. `progress` gets the round, the parts and how
    many of them were compared with all entries. The driver holds codebooks and their sums only.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(vector_col).cast("array<double>")
    kept = F.struct(*keep) if keep else F.lit(None).cast("struct<none:int>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), kept.alias("kept"))
    rows = rows.where(usable(F.col("v")))
    place = F.row_number().over(Window.partitionBy(F.size("v")).orderBy(F.col("vec_id").asc_nulls_last(), "v"))
    first = rows.select("vec_id", "v").withColumn("place", place).where(F.col("place") <= entries).collect()
    begin: dict[int, list] = {}
    for r in sorted(first, key=lambda r: r.place):
        begin.setdefault(len(r.v), []).append(r.v)
    starts = {d: whole(np.array(x, float).reshape(len(x), d), scale) for d, x in begin.items()}
    books = {(d, p): [m[:, lo:hi]] for d, m in starts.items() for p, (lo, hi) in enumerate(cuts(d, parts))}
    slots, n_slots = {}, 1  # the first slot counts comparisons
    for (d, p), history in books.items():
        slots[d, p] = n_slots
        n_slots += history[0].shape[0] * (history[0].shape[1] + 1)
    kept_type = rows.schema["kept"].dataType.simpleString()
    fields = f"vec_id long, v array<double>, kept {kept_type}, {', '.join(f'{c} binary' for c in STATE)}"
    fields += ", error long, slot long, limb int, s long"
    names = ["vec_id", "v", "kept", *STATE, "error", "slot", "limb", "s"]

    def work(now: int, last: bool) -> Callable:
        given = dict(books)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            history = {key: History(found) for key, found in given.items()}
            sums, kinds = Sums(n_slots), {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                kinds["kept"] = batch.schema.field("kept").type
                n = batch.num_rows
                state = {c: np.zeros((n, parts), k) for c, k in KINDS.items()}
                if now:
                    for c, k in KINDS.items():
                        state[c][:] = np.frombuffer(b"".join(batch.column(c).to_pylist()), k).reshape(n, parts)
                error = np.zeros(n, object)
                for d, at, x in by_length(batch.column("v")):
                    ints = whole(x, scale)
                    for p, (lo, hi) in enumerate(cuts(d, parts)):
                        book, part = history[d, p], ints[:, lo:hi]
                        mine = {c: np.ascontiguousarray(m[at, p]) for c, m in state.items()}
                        seen = book.assign(part, mine, now) if now else book.first(part, mine)
                        sums.totals[0] += len(seen)
                        for c, m in state.items():
                            m[at, p] = mine[c]
                        if last:
                            error[at] += squared(*fitting(part, book.entries[mine["codes"]])).astype(object)
                            continue
                        for k in np.unique(mine["codes"]).tolist():
                            members = part[mine["codes"] == k]
                            slot = slots[d, p] + k * (hi - lo + 1)
                            sums.add(slot, np.append(column_sums(members), len(members)))
                packed = [pa.array([r.tobytes() for r in state[c]], pa.binary()) for c in STATE]
                errors = pa.array(error.tolist(), pa.int64()) if last else pa.nulls(n, pa.int64())
                none = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64())]
                cols = [batch.column("vec_id"), batch.column("v"), batch.column("kept"), *packed, errors, *none]
                yield pa.RecordBatch.from_arrays(cols, names)
            found = sums.rows()
            if found:
                columns = zip(*found, strict=True)
                total = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64()), strict=True)]
                empty = [pa.int64(), pa.list_(pa.float64()), kinds["kept"], *[pa.binary()] * len(STATE), pa.int64()]
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(found), t) for t in empty], *total], names)

        return run

    stored = rows
    for now in range(rounds + 1):
        done = written(stored.mapInArrow(work(now, now == rounds), fields), f"codes-{now}")
        totals = collected(done.where("slot IS NOT NULL").select("slot", "limb", "s"), n_slots)
        if stored is not rows:
            discard(before)
        before, stored = done, done.where("slot IS NULL").select("vec_id", "v", "kept", *STATE)
        if progress:
            progress(now, stored.count() * parts, totals[0])
        if now == rounds:
            break
        for key, history in books.items():
            (k, width), at, new = history[0].shape, slots[key], []
            for e in range(k):
                *sums, count = totals[at + e * (width + 1) : at + (e + 1) * (width + 1)]
                new.append(floor_mean(sums, count) if count else history[-1][e].tolist())
            books[key] = [*history, matrix_of(new).reshape(k, width)]
    found = before.where("slot IS NULL").select("vec_id", "codes", "error", F.size("v").alias("dim"), "kept")
    return found, {d: [books[d, p][-1].tolist() for p in range(parts)] for d in begin}


def op13_net_bound_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as 8 codes of 4 bits each after 6 rounds, with their errors, also added up by label.

    One row per label is joined; Spark broadcasts it if it is small and splits a skewed label if it isn't.
    """
    found, books = quantise(table(spark, sf_dir, "embeddings"), keep=("label",))
    text = {d: ",".join(str(x) for part in b for entry in part for x in entry) for d, b in books.items()}
    digests = [(d, hashlib.sha256(t.encode()).hexdigest()) for d, t in text.items()]
    digest = F.lit(None).cast("string")
    for d, value in digests:
        digest = F.when(F.col("dim") == d, F.lit(value)).otherwise(digest)
    rows = found.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "dim", F.col("kept.label").alias("label"))
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = rows.alias("r").join(by_label.alias("l"), F.col("r.label").eqNullSafe(F.col("l.label")))
    return joined.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def codes_sql(rounds: int = ROUNDS) -> str:
    apart = "list_sum(list_transform(list_zip(p.w, k.w), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    steps = [
        """
v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] AS w FROM v, range(8) AS t(part))",
        "x AS MATERIALIZED (SELECT r, part, i, w[i] AS x FROM p, range(1, 9) AS t(i) WHERE i <= len(w))",
        "k0 AS MATERIALIZED (SELECT part, r - 1 AS entry, w FROM p WHERE r <= 16)",
    ]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, part ORDER BY d, entry) AS place
                 FROM (SELECT r, part, entry, CAST({apart} AS BIGINT) AS d FROM p JOIN k{i} AS k USING (part)))
  WHERE place = 1)""")
        if i < rounds:
            mean = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
            steps.append(f"""
k{i + 1} AS MATERIALIZED (
  SELECT k.part, k.entry, coalesce(m.w, k.w) AS w FROM k{i} AS k LEFT JOIN (
    SELECT part, entry, list(x ORDER BY i) AS w FROM (
      SELECT part, entry, i, {mean} AS x FROM a{i} JOIN x USING (r, part) GROUP BY part, entry, i)
    GROUP BY part, entry) AS m USING (part, entry))""")
    return f"""WITH {",".join(steps)},
g AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) FROM k{rounds}) AS codebooks_sha256
FROM v JOIN g USING (r)"""
