"""Small tables with the awkward rows that every operator must take: nulls, empty and long texts, repeated rows,
ties, and columns whose names the operators use themselves."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "doc long, crc long, row string, node long, shard int, slot long, digest string, bands string"
)


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "Beta", "gamma", "délta", "ε", "zeta,", "eta\n", "theta"]) + str(rng.randrange(40)) for _ in range(n))


def rows() -> list[tuple]:
    long = prose(6000, 1)
    near = long.split(" ")
    near[100:104] = ["quite", "other", "words", "here"]
    passage = prose(60, 2)
    texts = [
        (1, "one two three"),
        (1, "one two three"),
        (2, None),
        (None, "a null id " + passage),
        (3, ""),
        (4, " \t\n"),
        (5, long),
        (6, " ".join(near)),
        (7, long),
        (8, prose(30, 3) + " " + passage + " " + prose(30, 4)),
        (9, passage + "\n" + passage),
        (10, "word"),
        (11, "WORD"),
        (12, "x" * 50_000),
        (13, "日本語 テキスト 🙂 <|endoftext|> it's 12345 \x00 end"),
        (8, "another text with the same id as eight"),
    ]
    clash = (0, 0, "r", 0, 0, 0, "d", "b")
    return [(i, t, None if k % 5 == 0 else "en", "src" if k % 3 else None, len(t) if t else None, *clash) for k, (i, t) in enumerate(texts)]


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)


def write_tables(spark, path: str, **tables) -> str:
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return path
