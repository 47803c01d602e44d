"""Substring dedup, near-dedup, packing, token counts, BPE and sharding against brute force on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations, pairwise

import edge
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import public_tokenizers
from lonja.llm import bbit_minhash, bm25_packing, lempel_ziv, prefix_bpe, ring, token_counts, word_ids
from lonja.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return edge.documents(spark)


@pytest.fixture(scope="module")
def sf_edge(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    return edge.write_tables(spark, path, documents=edge.documents(spark))


@pytest.fixture(scope="module")
def sf_empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    return edge.write_tables(spark, path, documents=edge.documents(spark, []))


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def test_lempel_ziv_matches_brute_force(spark, sf_edge):
    docs = [(-1 << 63 if r[0] is None else r[0], WORDS.findall(r[1] or ""), r[0]) for r in edge.rows()]
    first: dict[tuple, tuple] = {}
    for rank, words, _ in docs:
        for i in range(len(words) - 19):
            w = tuple(words[i : i + 20])
            first[w] = min(first.get(w, (rank, i)), (rank, i))
    expected = Counter()
    for rank, words, doc_id in docs:
        gone = set()
        for i in range(len(words) - 19):
            if first[tuple(words[i : i + 20])] < (rank, i):
                gone |= set(range(i, i + 20))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        expected[doc_id, len(words), len(gone), sha(kept.encode())] += 1
    got = Counter(map(tuple, lempel_ziv.op1_lempel_ziv_dedup(spark, sf_edge).collect()))
    assert got == expected
    assert sum(k[2] for k in expected) > 6000


def equal_crcs(one, other, mask):
    """Texts of two families with equal low bits of their CRCs."""
    a, b = ([f"{t} {sha(str(i).encode())[:12]}" for i in range(40_000)] for t in (one, other))
    seen = {zlib.crc32(t.encode()) & mask: t for t in a}
    return next((seen[c], t) for t in b if (c := zlib.crc32(t.encode()) & mask) in seen)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_with_one_id_and_equal_crcs_keep_their_own_hits(spark, doc_id):
    passage, clean = edge.prose(30, 2), edge.prose(40, 3)
    twice, other = equal_crcs(f"{passage} {edge.prose(9, 4)} {passage}", clean, 0xFFFFFF)
    short = edge.prose(25, 5)
    edges, end = equal_crcs(f"{edge.prose(60, 6)} {passage} {edge.prose(60, 7)}", short, 0xFFFFFF)
    texts = [twice, other, edges, end]
    found = lempel_ziv.parse(edge.documents(spark, [(doc_id, t, None, None, 0, *(0, 0, "r", 0, 0, 0, "d", "b")) for t in texts]))
    got = Counter((r.kept_words, r.n_removed) for r in found.collect())
    first = {}
    for t in texts:
        words = WORDS.findall(t)
        for i in range(len(words) - 19):
            w = tuple(words[i : i + 20])
            first[w] = min(first.get(w, i), i)
    expected = Counter()
    for t in texts:
        words, gone = WORDS.findall(t), set()
        for i in range(len(words) - 19):
            if first[tuple(words[i : i + 20])] < i:
                gone |= set(range(i, i + 20))
        expected[" ".join(w for i, w in enumerate(words) if i not in gone), len(gone)] += 1
    assert got == expected and expected[" ".join(WORDS.findall(other)), 0] == 1


def test_one_of_each_of_null_and_repeated_ids(spark):
    a, b = edge.prose(300, 8), edge.prose(300, 9)
    rows = [(None, a), (None, a + " x"), (None, b), (7, b + " y"), (7, b + " z"), (None, None), (None, None)]
    rest = (None, None, 0, 0, 0, "r", 0, 0, 0, "d", "b")
    got = bbit_minhash.one_of_each(edge.documents(spark, [(*r, *rest) for r in rows])).collect()
    kept = Counter("a" if r.text and r.text.startswith(a) else r.doc_id if r.text else "empty" for r in got)
    assert kept == {"a": 1, 7: 1, "empty": 1}


def test_factors_point_at_equal_earlier_text(docs):
    texts = {r[0]: WORDS.findall(r[1] or "") for r in edge.rows() if r[0] not in (1, 8)}
    found = lempel_ziv.parse(docs.where("doc_id NOT IN (1, 8) OR doc_id IS NULL")).collect()
    factors = [(r.doc_id, f) for r in found for f in r.factors]
    assert factors
    for doc_id, f in factors:
        src = None if f.src_doc == lempel_ziv.FIRST_ID else f.src_doc
        assert f.words >= 20
        assert texts[doc_id][f.start : f.start + f.words] == texts[src][f.src_start : f.src_start + f.words]
    whole = [f for doc_id, f in factors if doc_id == 7]
    assert sum(f.words for f in whole) >= 6000  # the copy of a long text is a few long factors
    assert len(whole) < 60


def test_equal_rows_are_parsed_like_one(spark):
    rest = (None, None, 0, 0, 0, "r", 0, 0, 0, "d", "b")
    text, before = edge.prose(450, 11), edge.prose(90, 12)
    source = before + " " + text + " " + edge.prose(30, 13)

    def parsed(n):
        rows = [(1, source, *rest), *[(5, f"new words first {text} and last", *rest)] * n]
        found = lempel_ziv.parse(edge.documents(spark, rows)).collect()
        return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_words, len(r.factors)) for r in found)

    (one,) = [k for k in parsed(1) if k[0] == 5]
    many = parsed(2000)  # two millions of pairs, were each row's copies joined to each row
    assert many[one] == 2000 and one[4] <= 2 and one[2] >= 450


def test_cut_copies_keeps_rows_columns_and_layout(docs):
    out = lempel_ziv.cut_copies(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = {(r.doc_id, (r.text or "")[:20]): r for r in out.collect()}
    assert len(out.collect()) == len(edge.rows())
    assert next(r for k, r in rows.items() if k[0] == 2).text is None
    assert next(r for k, r in rows.items() if k[0] == 7).text == ""
    assert next(r for k, r in rows.items() if k[0] == 5).text == edge.rows()[6][1]
    assert all(r.n_chars == len(r.text) for k, r in rows.items() if k[0] in (7, 8, 9))


def shingles(text: str | None, size: int) -> frozenset:
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(docs, size):
    given = [(r[0], r[1], shingles(r[1], size)) for r in edge.rows()]
    root = list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(given)), 2):
        a, b = given[i][2], given[j][2]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(j)] = find(i)
    expected = Counter()
    for i, (doc_id, text, s) in enumerate(given):
        group = [given[j][0] for j in range(len(given)) if find(j) == find(i) and given[j][0] is not None]
        lowest = (min(group) if group else None) if s else doc_id
        expected[doc_id, zlib.crc32((text or "").encode()), len(s), lowest, doc_id == lowest] += 1
    got = Counter(map(tuple, bbit_minhash.near_duplicates(docs, shingle=size).collect()))
    assert got == expected


def test_one_of_each_keeps_one_row_per_group(docs):
    out = bbit_minhash.one_of_each(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert ids == Counter([1, 2, 3, 4, 5, 8, 8, 9, 10, 12, 13])  # the null id is linked with 9


def test_estimate_is_close_to_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        common = int(2000 * share / (1 + share) * 2)
        values = rng.integers(0, 1 << 63, 4000 - common, dtype=np.uint64)
        a, b = values[:2000], values[2000 - common :]
        got = bbit_minhash.estimate(*bbit_minhash.signatures(bbit_minhash.minima([a, b])))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(got - true) < 0.15


def test_blocks_give_the_same_groups(docs, monkeypatch):
    expected = Counter(map(tuple, bbit_minhash.near_duplicates(docs, shingle=2).collect()))
    monkeypatch.setattr(bbit_minhash, "BUCKET_BLOCK", 1)
    monkeypatch.setattr(bbit_minhash, "CLUSTER_BLOCK", 1000)
    assert Counter(map(tuple, bbit_minhash.near_duplicates(docs, shingle=2).collect())) == expected


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {199: 199, 200: 199}


def check_packing(rows, texts, window):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for doc_id, text in texts:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[doc_id, zlib.crc32(ids.tobytes())] += 1
    pieces = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    at = {}
    for r in pieces:
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
        assert r.length > 0
    assert max(at.values()) <= window
    return expected, pieces, at


def test_packing_places_every_id_once(docs, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bm25_packing.pack(docs, path, window=256, with_ids=True).collect()
    expected, pieces, at = check_packing(rows, [r[:2] for r in edge.rows()], 256)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in pieces)
    unique = Counter(r[0] for r in edge.rows())
    whole = Counter()
    for doc_id in (i for i, n in unique.items() if n == 1):
        mine = sorted((r for r in pieces if r.doc_id == doc_id), key=lambda r: r.start)
        assert all(r.doc_tokens == sum(x.length for x in mine) for r in mine)
        whole[doc_id, zlib.crc32(b"".join(r.ids for r in mine))] += 1
    assert whole == Counter({k: n for k, n in expected.items() if unique[k[0]] == 1})
    assert sum(256 - n for n in at.values()) < 256  # one window has padding


def test_document_frequencies_are_of_whole_documents(docs):
    path, window = public_tokenizers.path("word_bpe_49k.json"), 64
    encoder = word_ids.word_ids(path)
    flat, at = encoder.encode(pa.array([r[1] or "" for r in edge.rows()]))
    ids = [np.append(flat[a:b], 1).astype(int) for a, b in pairwise(at)]
    whole = np.zeros(encoder.vocabulary, np.int64)
    for one in ids:
        whole[np.unique(one)] += 1
    tails = [len(one) % window for one in ids if len(one) % window]
    tokens = bm25_packing.tokenised(docs, path, window=window, end_id=1, with_ids=False)
    df, rows, mean = bm25_packing.frequencies(tokens, len(whole), encoder.kind)
    assert (df == whole).all() and rows == len(ids) and mean == sum(tails) / len(tails)
    # documents of full windows alone count as well
    df, rows, mean = bm25_packing.frequencies(
        bm25_packing.tokenised(docs, path, window=1, end_id=1, with_ids=False), len(whole), encoder.kind
    )
    assert (df == whole).all() and rows == len(ids) and mean == 0


def bm25_best(tails, df, k):
    """The k best neighbours of every tail among all of them, term by term."""
    n, mean = len(tails), sum(map(len, tails)) / len(tails)
    idf = {t: math.log1p((n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    weight = [
        {t: f * (bm25_packing.K1 + 1) / (f + bm25_packing.K1 * (1 - bm25_packing.B + bm25_packing.B * len(ids) / mean)) for t, f in Counter(ids).items()}
        for ids in tails
    ]
    best = []
    for i, mine in enumerate(weight):
        scores = [(-sum(idf[t] * other[t] for t in mine if t in other), j) for j, other in enumerate(weight) if j != i]
        best.append([j for _, j in sorted(scores)[:k]])
    return best


def test_many_shards_keep_the_neighbours_of_the_whole_corpus(spark):
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(5)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in ("a", "e", "i", "o", "u", "an", "er", "ist")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(3))
    common, topics = [word() for _ in range(300)], [[word() for _ in range(25)] for _ in range(60)]
    texts = [" ".join(rng.choice(topics[i % 60] if rng.random() < 0.5 else common) for _ in range(80)) for i in range(600)]
    rows = bm25_packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, shard_tokens=12_000).collect()
    shard = {r.doc_id: r.sequence_id >> 32 for r in rows}
    assert len(set(shard.values())) >= 10
    model = Tokenizer.from_file(path)
    tails = [[*model.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert max(map(len, tails)) < bm25_packing.WINDOW
    best = bm25_best(tails, Counter(t for ids in tails for t in set(ids)), 5)
    together = [shard[i] == shard[j] for i, mine in enumerate(best) for j in mine]
    assert sum(together) >= 0.9 * len(together)


def test_copies_leave_shards_bounded(spark):
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(6)
    texts = ["the same page again and again " * 5] * 400 + [" ".join(f"w{rng.randrange(900)}" for _ in range(30)) for _ in range(400)] + [None, ""]
    rows = bm25_packing.pack(
        spark.createDataFrame([(None if i % 7 == 0 else i, t) for i, t in enumerate(texts)], "doc_id long, text string"), path, shard_tokens=5_000
    ).collect()
    expected, pieces, at = check_packing(rows, list(enumerate(texts)), bm25_packing.WINDOW)
    held, heads = Counter(), Counter()
    for r in rows:
        held[r.sequence_id >> 32] += r.length
        heads[r.sequence_id >> 32] += r.start == 0
    assert sum(heads.values()) == len(texts) and sum(held.values()) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert max(n + bm25_packing.ROW_COST * heads[k] for k, n in held.items()) < 2 * 5_000


def test_ranking_is_whole_beyond_the_first():
    rng = np.random.default_rng(0)
    tails = [rng.integers(0, 30, 12) for _ in range(500)]
    df = np.bincount(np.concatenate([np.unique(t) for t in tails]), minlength=30)
    index, unused = bm25_packing.Index(tails, df, 500, 12.0), np.ones(500, bool)
    unused[0] = False
    got = list(index.neighbours(0, unused))
    scores = np.zeros(500, np.float32)
    lo, hi = index.bounds[0], index.bounds[1]
    for t in index.term[lo:hi][np.argsort(-index.rare[lo:hi], kind="stable")]:
        at = slice(index.first[t], index.first[t + 1])
        scores[index.docs[at]] += index.weights[at] * index.idf[t]
    assert got == [i for i in np.argsort(-scores, kind="stable").tolist() if scores[i] > 0 and i]


def test_packing_takes_neighbours_first():
    tails = [np.array(t) for t in ([1, 2, 3, 4], [9, 8, 7, 6], [1, 2, 3, 5], [9, 8, 7, 5])]
    df = np.bincount(np.concatenate(tails), minlength=10)
    index = bm25_packing.Index(tails, df, 4, 4.0)
    assert bm25_packing.fill(index, [4] * 4, 8) == [
        (0, 0, 4, 0, 0), (2, 0, 4, 0, 4), (1, 0, 4, 1, 0), (3, 0, 4, 1, 4)
    ]


@pytest.mark.parametrize("remembered", [0, 5, 150_000])
def test_word_ids_equal_whole_texts(remembered):
    path = public_tokenizers.path("word_bpe_49k.json")
    model, encoder = Tokenizer.from_file(path), word_ids.WordIds(path, remembered)
    texts = [r[1] or "" for r in edge.rows()]
    texts += ["é ́a　b c d", "<|startoftext|>x <|endoftext|>", "Σ ΑΣ İ's", "a,b it's! 'twas <|endoftext|>, x<|endoftext|>! <|"]
    texts += ["ªb º. don't'll ĳ ŉ ſt ﬁ.", "\x0b\x0c\r\n\x1c\x85 word\x00 \u200b,", "AÄÖÜß... ǅ, Ǆ! ɏ? ɐ? K", "", " ", "!!! ... ''s"]
    for some in (texts, texts[::-1], texts[:3], []):
        ids, at = encoder.encode(pa.array(some, pa.string()))
        got = [ids[a:b].tolist() for a, b in pairwise(at)]
        assert got == [model.encode(t, add_special_tokens=False).ids for t in some]
    assert list(word_ids.slices(pa.array(["a" * 9, "b", "", "c" * 20, "d"]), 10)) == [(0, 3), (3, 1), (4, 1)]


def test_prefix_bpe_equals_the_library(spark, sf_edge, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    model = prefix_bpe.Ranks(path)
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.rank, special_tokens={})
    expected = Counter()
    for r in edge.rows():
        ids = np.array(library.encode_ordinary(r[1] or ""), "<u4")
        expected[r[0], len(ids), sha(ids.tobytes()), sha((r[1] or "").encode())] += 1
    assert Counter(map(tuple, prefix_bpe.op9_prefix_bpe(spark, sf_edge).collect())) == expected
    encoded = prefix_bpe.encode(docs, path, public_tokenizers.PATTERN)
    back = prefix_bpe.decode(encoded, path, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.content).decode()) for r in back) == Counter((r[0], r[1] or "") for r in edge.rows())


def test_prefix_table_appends_and_edits():
    ranks = prefix_bpe.Ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    data = ("the thing of things " * 60).encode()
    table = prefix_bpe.PrefixTable(ranks, data[:100])
    table.append(data[100:])
    assert table.last == prefix_bpe.PrefixTable(ranks, data).last
    for start, end, new in ((0, 0, b"x"), (500, 504, "né".encode()), (700, 700, b""), (1190, 1200, b"")):
        done = table.edit(start, end, new)
        assert table.last == prefix_bpe.PrefixTable(ranks, table.data).last
        assert done < 4 * ranks.longest or start > 1000
    assert table.ids() == ranks.merge(table.data)


def test_token_counts_and_what_the_cache_encodes(spark, docs, tmp_path, monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in edge.rows())
    cache = str(tmp_path / "cache")
    assert Counter(map(tuple, token_counts.count_tokens(docs, cache, path).collect())) == expected
    texts = {r[1] or "" for r in edge.rows()}
    assert spark.read.parquet(cache).count() == len(texts)
    more = docs.unionByName(docs.limit(1).selectExpr("99L AS doc_id", "'a new text' AS text", *docs.columns[2:]))
    assert token_counts.count_tokens(more, cache, path).count() == len(edge.rows()) + 1
    assert spark.read.parquet(cache).count() == len(texts) + 1  # only the new text was encoded
    token_counts.count_tokens(docs, cache, path, settings="other").count()
    assert spark.read.parquet(cache).count() == 2 * len(texts) + 1
    by_json = token_counts.count_tokens(docs, str(tmp_path / "json"), public_tokenizers.path("byte_bpe_50k.json"))
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert Counter((r.doc_id, r.n_tokens) for r in by_json.collect()) == Counter(
        (r[0], len(other.encode(r[1] or "", add_special_tokens=False).ids)) for r in edge.rows()
    )


def test_ring_fills_shards_evenly(spark, sf_edge, sf_dir):
    for path, n in ((sf_edge, len(edge.rows())), (sf_dir, 200)):
        rows = ring.op5_bounded_ring(spark, path).collect()
        assert len(rows) == n
        slots = {}
        for r in rows:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots.get(s, [])) for s in range(24)]
        assert max(counts) - min(counts) <= 1
    expected = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in edge.rows())
    assert Counter(map(tuple, ring.op5_bounded_ring(spark, sf_edge).select("doc_id", "size", "text_crc32").collect())) == expected


def test_ring_by_hand():
    """Keys go to the first shard with room clockwise of their cell."""
    nodes = ring.virtual_nodes(3, 2, 100)
    counts = {(c, 0): 1 for c in range(90)}
    plan = ring.walk(counts, 3, vnodes=2, cells=100, slack=0)
    home = {c: next((s for cell, s in nodes if cell >= c), nodes[0][1]) for c in range(90)}
    placed = {c: s for c, _, lo, hi, s, _ in plan}
    assert sorted(Counter(placed.values()).values()) == [30, 30, 30]
    full = {s for s, n in Counter(home.values()).items() if n >= 30}
    assert all(placed[c] == home[c] or home[c] in full for c in placed)


def test_ring_moves_few_rows_when_it_grows():
    counts = {(c, 0): 5 for c in range(ring.CELLS)}
    options = {"vnodes": ring.VNODES, "cells": ring.CELLS, "slack": 0.25}
    before, after = (
        {(c, r): s for c, _, lo, hi, s, _ in ring.walk(counts, n, **options) for r in range(lo, hi)} for n in (24, 25)
    )
    moved = [k for k in before if before[k] != after[k]]
    assert sum(after[k] == 24 for k in moved) > 0.9 * len(moved)
    assert len(moved) < 0.06 * len(before)
    assert max(Counter(after.values()).values()) <= 1.26 * len(after) / 25


def test_write_shards(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = ring.op5_bounded_ring(spark, sf_dir)
    ring.write_shards(docs, placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 24


@pytest.mark.parametrize(
    "query",
    [
        lempel_ziv.op1_lempel_ziv_dedup,
        bm25_packing.op3_bm25_packing,
        bbit_minhash.op4_bbit_minhash,
        ring.op5_bounded_ring,
        prefix_bpe.op9_prefix_bpe,
        token_counts.op10_token_counts,
    ],
)
def test_empty_tables_give_no_rows(spark, sf_empty, query):
    assert query(spark, sf_empty).collect() == []


def test_pieces_are_encoded_without_normalising():
    """Lower-cased pieces need none, and all other words still go through it."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, seen = word_ids.WordIds(path), []
    library, before = encoder._library, str(encoder.model.normalizer)
    encoder._library = lambda x: seen.append(encoder.model.normalizer is None) or library(x)
    texts = ["Éa ÀÖ. Ÿes STRASSE!! ßa ªº", "<|x|> ÉTÉ it's ΑΣ 12"]
    ids, at = encoder.encode(pa.array(texts))
    assert seen == [True, False] and str(encoder.model.normalizer) == before
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.model.encode(text, add_special_tokens=False).ids


def test_packing_keeps_the_tokenizer_off_the_driver(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("the driver loads a tokenizer")

    word_ids.word_ids.cache_clear()
    monkeypatch.setattr(word_ids.WordIds, "__init__", refuse)
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert bm25_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count() == 2
