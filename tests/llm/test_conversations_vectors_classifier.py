"""Perspective rotation, vector searches and the classifier on awkward rows; the pipeline stage by stage."""

from __future__ import annotations

import tracemalloc
from collections import Counter

import edge
import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from lonja.llm import cotraining, hnsw, mtree, perspectives, tail_routes, vector_shards

TURNS = "conv_id long, turn long, role string, text string, speaker string, said string, block int"


def talk(rows):
    return [(c, t, r, x, "s", "s", 0) for c, t, r, x in rows]


def test_rotation_renders_every_view(spark):
    rows = talk(
        [
            (1, 0, "system", "Be kind."),
            (1, 1, "Ana", "Hi"),
            (1, 2, "Bo", "Hello"),
            (1, 3, "Ana", None),
            (2, 0, "system", "alone"),
            (None, None, None, "x"),
            (None, 0, "Ana", "y"),
        ]
    )
    found = {(r.conv_id, r.speaker): r for r in perspectives.rotate(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(found) == {(1, "Ana"), (1, "Bo"), (None, "Ana"), (None, "unknown")}
    ana = found[1, "Ana"]
    assert ana.text == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi<|im_end|>\n"
        "<|im_start|>user name=Bo\nHello<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    assert [ana.text[m.start : m.end] for m in ana["mask"]] == ["Hi<|im_end|>\n", "<|im_end|>\n"]
    bo = found[1, "Bo"]
    assert [bo.text[m.start : m.end] for m in bo["mask"]] == ["Hello<|im_end|>\n"]


def by_hand(rows, size, system="system"):
    """(conv, speaker, block) to number of turns, text and masked contents."""
    out = {}
    for conv in {r[0] for r in rows}:
        said = [(r[1], r[2] or "unknown", r[3] or "") for r in rows if r[0] == conv]
        said.sort(key=lambda t: (t[0] is None, t[0] or 0, t[1], t[2]))
        for speaker in {t[1] for t in said if t[1] != system}:
            for block in range(-(-len(said) // size)):
                mine = said[block * size : (block + 1) * size]
                shown = [said[0], *mine] if block and said[0][1] == system else mine
                heads = ["assistant" if t[1] == speaker else system if t[1] == system else f"user name={t[1]}" for t in shown]
                text = "".join(f"<|im_start|>{h}\n{t[2]}<|im_end|>\n" for h, t in zip(heads, shown, strict=True))
                out[conv, speaker, block] = len(mine), text, [f"{t[2]}<|im_end|>\n" for t in shown if t[1] == speaker]
    return out


@pytest.mark.parametrize("size", [3, 64])
def test_long_dialogues_continue_by_rank(spark, size):
    rows = [(1, t, "ab"[t % 2], f"t{t}") for t in range(150)]
    rows += [(2, 5, "a", f"x{i:03}") for i in range(70)] + [(2, 5, "a", "x000")] * 2  # equal numbers, repeated rows
    rows += [(3, 0, "system", "Rules."), *[(3, 100 * t, "abc"[t % 3], "word " * 900 if t == 40 else f"s{t}") for t in range(1, 90)]]
    rows += [(4, None, None, None)] * 5 + [(4, 9, "system", "not first"), (4, 3, "a", "first"), (None, 1, "z", "no id"), (None, 0, "system", "s")]
    found = perspectives.rotate(spark.createDataFrame(talk(rows), TURNS), block_turns=size).collect()
    got = {(r.conv_id, r.speaker, r.block): (r.n_turns, r.text, [r.text[m.start : m.end] for m in r["mask"]]) for r in found}
    assert got == by_hand(rows, size) and len(got) == len(found)
    assert perspectives.rotate(spark.createDataFrame([], TURNS)).collect() == []


VECTORS = "vec_id long, embedding array<float>, label int, v string, number long, dim int"


def vectors(spark, pairs):
    return spark.createDataFrame([(i, v, 0, "v", 0, 0) for i, v in pairs], VECTORS)


def awkward(seed=0, n=300, dim=8):
    rng = np.random.default_rng(seed)
    pairs = [(i, rng.normal(size=dim).astype("f4").tolist()) for i in range(n)]
    hot = pairs[7][1]
    pairs += [(1000 + i, hot) for i in range(120)] + [(50, hot), (100, None), (150, [0.0] * dim), (151, [float("nan")] * dim)]
    pairs += [(152, [float("inf")] * dim), (153, [None] * dim), (154, []), (None, hot), (155, [1.0] * 3), (200, [2.0] * 3)]
    return pairs


def brute(pairs, measure, takes):
    rows = [(i, np.array(v, float)) for i, v in pairs if v and takes(v)]
    out = {}
    for i, v in rows:
        if i is not None and i % 50 == 0:
            scored = [(measure(v, w), j) for j, w in rows if j != i and len(w) == len(v)]
            scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
            out.setdefault(i, []).append([(j, s) for s, j in scored[:5]])
    return out


def finite(v):
    return all(x is not None and np.isfinite(x) for x in v)


def test_mtree_is_exact(spark):
    pairs = awkward()
    whole = [(i, [float(np.floor(256 * x)) if x is not None and np.isfinite(x) else x for x in v] if v else v) for i, v in pairs]
    expected = brute(whole, lambda a, b: int(a @ b), finite)
    got = mtree.largest_products(vectors(spark, pairs), "vec_id % 50 = 0", shard_rows=100, block_queries=3).collect()
    lists = Counter()
    for q, found in expected.items():
        for one in found:
            lists.update((q, rank, j, s) for rank, (j, s) in enumerate(one, 1))
    assert Counter(map(tuple, got)) == lists


@pytest.mark.parametrize("outliers", [12, 300])
def test_mtree_takes_large_components_as_sql_does(spark, tmp_path, outliers):
    rng = np.random.default_rng(5)
    v = np.floor(rng.normal(size=(300, 40)) * 300) / 256
    for n, i in enumerate(rng.permutation(300)[:outliers].tolist()):
        v[i, n % 3] = rng.choice([-1, 1, 1]) * rng.choice([65536.0, 7e4, 1e6 + n, 1e7 - n])  # 256 * 1e7 squared is above 2**62
    v[50, 0], v[100, 1], v[7] = 65536.0, -1e7, v[50]
    pairs = list(enumerate(v.astype("f4").tolist()))
    path = edge.write_tables(spark, str(tmp_path), embeddings=vectors(spark, pairs))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet'")
    expected = Counter(con.execute(mtree.OP7_SQL).fetchall())
    got = mtree.largest_products(vectors(spark, pairs), "vec_id % 50 = 0", shard_rows=100, block_queries=3).collect()
    assert Counter(map(tuple, got)) == expected and len(got) == 30


def test_mtree_covers_and_bounds():
    x = np.floor(np.random.default_rng(3).normal(size=(500, 6)) * 100)
    tree = mtree.build_tree(x, 1)
    children, objects = (np.frombuffer(tree[c], np.int64) for c in ("children", "objects"))
    assert sorted(objects[children < 0].tolist()) == list(range(500))  # every row in one leaf


def test_hnsw_finds_nearly_all(spark):
    pairs = awkward(n=900)
    cosine = lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    expected = brute(pairs, cosine, lambda v: finite(v) and any(v))
    rows = hnsw.nearest(vectors(spark, pairs), "vec_id % 50 = 0", shard_rows=300).collect()
    found: dict = {}
    for r in rows:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(expected)
    hits = total = 0
    for q, lists in expected.items():
        scores = sorted((s for one in lists for _, s in one), reverse=True)
        mine = sorted((r.score for r in found[q]), reverse=True)
        assert len(mine) == len(scores)
        hits += sum(abs(a - b) < 1e-9 for a, b in zip(scores, mine, strict=True))
        total += len(scores)
    assert hits >= 0.95 * total
    hot = [r.vec_id for r in sorted(found[50], key=lambda r: (r.rank, r.vec_id)) if r.score > 1 - 1e-9]
    assert hot[:3] == [7, 1000, 1001]  # ties by vec_id


def test_hnsw_recall_on_the_table(spark, sf_dir):
    rows = hnsw.op6_hnsw(spark, sf_dir).collect()
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in data])
    x = np.array([r.embedding for r in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        s[q] = -2
        hits += len(set(ids[np.argsort(-s)[:5]]) & {r.vec_id for r in rows if r.query_id == ids[q]})
        total += 5
    assert hits >= 0.95 * total


def test_searches_without_rows_or_queries(spark):
    for pairs in ([], [(1, [1.0, 2.0])], [(100, [1.0, 2.0])]):
        assert hnsw.nearest(vectors(spark, pairs), "vec_id % 50 = 0").collect() == []
        assert mtree.largest_products(vectors(spark, pairs), "vec_id % 50 = 0").collect() == []


def test_smallest_ids_with_repeats():
    ids, ends = np.array([1, 1, 2, 3, 4, 9]), np.array([5, 6])
    assert vector_shards.smallest_ids(0, ids, ends, 2, 1) == [2, 3]
    assert vector_shards.smallest_ids(0, ids, ends, 2, 3) == [1, 1]
    assert vector_shards.smallest_ids(1, ids, ends, 2, 9) == []


def good(n, rng):
    ends = rng.choice(["on", "art", "ime", "et", "ula"], (n, 2))
    return ["".join(w) for w in np.column_stack([rng.choice(list("bcdfglmnp"), n), ends]).tolist()]


def prose(n, seed):
    return " ".join(good(n, np.random.default_rng(seed)))


def corpus(spark, n=400):
    """Good prose, shouted junk and prose with bad words, with labels for most."""
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(n):
        words = good(60, rng)
        kind = i % 4
        if kind == 1:
            words = [w.upper() + "!!" for w in words]
        elif kind == 2:
            words[3] = words[40] = "nasty"
        docs.append((i, " ".join(words), "en", f"src{i % 3}", None, 0, 0, "r", 0, 0, 0, "d", "b"))
        if i % 8 < 6:
            labels.append((i, int(kind != 1), int(kind == 2)))
    return edge.documents(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cotraining_on_rows_without_labels(spark):
    docs, labels = corpus(spark)
    model = cotraining.train(docs, labels)
    rows = cotraining.score(docs, model).select("row.doc_id", "kept", "p_content", "p_metadata").collect()
    assert len(rows) == 400
    wrong = [r.doc_id for r in rows if r.doc_id % 8 >= 6 and r.kept == (r.doc_id % 4 in (1, 2))]
    assert len(wrong) <= 4
    shouted = [r.p_metadata for r in rows if r.doc_id % 4 == 1]
    nasty = [r.p_content for r in rows if r.doc_id % 4 == 2]
    assert min(shouted) > 0.5 and min(nasty) > 0.5  # each view sees its own


def spelt(i):
    """A word of its own for every number, without digits."""
    return "w" + "".join("abcdefghij"[int(d)] for d in f"{i:05}") + "xy"


def test_evidence_does_not_grow_with_the_length(spark):
    """Many clean texts in a row stay clean to the content view, a rare word that speaks a little for bad included."""
    docs, labels = corpus(spark)
    model = cotraining.train(docs, labels)
    clean = {r.doc_id: r.text for r in docs.collect() if r.doc_id % 4 not in (1, 2)}
    rng = np.random.default_rng(4)
    glued = [(5000 + i, "\n".join(clean[int(k)] for k in rng.choice(sorted(clean), 40)), "en", "src0", None) for i in range(40)]
    glued += [(6000, " ".join(clean.values()), "en", "src0", None)]
    rows = [(*g, *(0, 0, "r", 0, 0, 0, "d", "b")) for g in glued]
    assert cotraining.score(edge.documents(spark, rows), model).where("p_content >= 0.5").count() == 0
    slight = cotraining.Content({xxhash.xxh64_intdigest(spelt(i)): 0.05 for i in range(2000)}, -4.0)
    scorer = cotraining.Scorer(cotraining.Model(slight, None, None, None))
    scores = [scorer.content({spelt(i) for i in range(n)}) for n in (10, 500, 2000)]
    assert scores[0] == pytest.approx(-3.5) and scores[1] == pytest.approx(scores[2]) and scores[1] < 0.05 * 1000


def test_fit_and_score_see_the_same_numbers():
    rng = np.random.default_rng(6)
    texts = [" ".join(spelt(i) for i in rng.integers(0, 400, n)) + (" nasty" if n % 2 else "") for n in range(30, 3030, 10)]
    texts += [t + " nasty nastier nastiest" for t in texts[::3]]
    reader = cotraining.Reader()
    features = [reader.features(set(t.split())) for t in texts]
    content = cotraining.Content.fit(features, np.array([float("nasty" in t) for t in texts]))
    scorer = cotraining.Scorer(cotraining.Model(content, None, None, None))
    assert content.weights and max(map(len, features)) > cotraining.FULL_TEXT
    assert np.allclose(content.score(features), [scorer.content(set(t.split())) for t in texts])


def shouting(spark, n):
    """Pages of which every fourth shouts words of its own; the first 60 have labels, and never the last word."""
    rng = np.random.default_rng(8)
    texts = []
    for i in range(n):
        words = [spelt(k) for k in rng.integers(0, 300, 40)]
        if i % 4 == 1:
            more = [spelt(1000 + int(k)) for k in rng.integers(0, 30, 6)] + (["zorgblat"] if i >= 60 and i % 8 == 1 else [])
            words = [w.upper() + "!!!" for w in words + more] + ["#$%", "#$%"] * 10
        texts.append(" ".join(words))
    docs = edge.documents(spark, [(i, t, "en", "src0", None, 0, 0, "r", 0, 0, 0, "d", "b") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(i % 4 != 1), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    return docs, labels, texts


def test_rounds_teach_the_other_view(spark):
    """A word that no labelled document has is learnt from pages whose layout is surely bad."""
    docs, labels, texts = shouting(spark, 600)
    assert not any("ZORGBLAT" in t for t in texts[:60])
    model = cotraining.train(docs, labels)
    assert model.content.weights[xxhash.xxh64_intdigest("zorgblat")] > 0
    scorer = cotraining.Scorer(model)
    assert scorer.content({"quiet", "zorgblat"}) > scorer.content({"quiet"})
    wrong = cotraining.score(docs, model).where("kept = (row.doc_id % 4 = 1)").count()
    assert wrong <= 6


def test_lessons_are_sums_over_all_rows(spark):
    docs, labels, texts = shouting(spark, 240)
    model = cotraining.train(docs, labels)
    docs = docs.select("text", "lang", "source", "n_chars").unionAll(docs.limit(3).selectExpr("null", "null", "source", "n_chars"))
    found = [cotraining._judged(docs.repartition(n), model.content, model.metadata) for n in (1, 7)]
    assert found[0][0] == found[1][0] and found[0][1].n == found[1][1].n > 0
    for name in ("gradient", "curvature"):
        assert (getattr(found[0][1], name) == getattr(found[1][1], name)).all()
    # brute force over all pages at once
    looks, mine = [], []
    for r in docs.collect():
        words = (r.text or "").split()
        looks.append((r.asDict(), cotraining.layout(r.text or "", words, len(set(words)))))
        mine.append(cotraining.Scorer(model).content(set(words)))
    x = np.column_stack([model.metadata.matrix(looks), np.ones(len(looks))])
    p, q = cotraining.sigmoid(x @ model.metadata.weights), cotraining.sigmoid(np.array(mine))
    bad = (q >= cotraining.SURE_BAD) & (p > cotraining.DENIES)
    use = bad | ((q <= cotraining.SURE_GOOD) & (p < 0.5))
    taught = found[0][1]
    assert taught.n == use.sum()
    assert np.allclose(taught.gradient, x[use].T @ (p[use] - bad[use]), atol=0.01 * use.sum())
    assert np.allclose(taught.curvature, (x[use].T * (p * (1 - p))[use]) @ x[use], atol=0.02 * use.sum())
    assert cotraining._judged(docs.limit(0), model.content, model.metadata) == ({}, None)


def test_classifier_takes_awkward_rows(spark):
    docs, labels = corpus(spark)
    model = cotraining.train(docs, labels)
    odd = edge.documents(spark)
    out = cotraining.score(odd, model)
    assert out.count() == odd.count() and out.where("p_bad IS NULL OR isnan(p_bad)").count() == 0
    assert cotraining.score(edge.documents(spark, []), model).collect() == []
    none = cotraining.train(docs, labels.where("quality = 5"))
    assert none is None and cotraining.score(odd, none).where("kept").count() == odd.count()
    nulls = spark.createDataFrame([(None, 1, 0), (1, None, 1), (2, 0, None)], labels.schema)
    assert cotraining.train(docs, nulls) is None


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """A corpus with planted copies run through the stages, each written as the check does."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs, labels = corpus(spark)
    passage = prose(60, 9)
    base = prose(200, 10)
    more = [
        (1000, base), (1001, base), (1002, base + " tail"), (1003, prose(100, 11) + " " + passage),
        (1004, passage + " " + prose(100, 12)), (1005, None), (None, prose(50, 13)), (1006, ""),
    ]
    extra = [(i, t, "en", "src0", None, 0, 0, "r", 0, 0, 0, "d", "b") for i, t in more]
    docs = docs.unionByName(edge.documents(spark, extra))
    edge.write_tables(spark, path, documents=docs, labels=labels)
    kept, docs = [], spark.read.parquet(f"{path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{path}/out{k}")
        docs = spark.read.parquet(f"{path}/out{k}")
        kept.append(docs)
    return path, kept


def test_pipeline_stages(spark, stages):
    path, (quality, near, cut, packed) = stages
    given = spark.read.parquet(f"{path}/documents.parquet")
    assert quality.columns == near.columns == cut.columns == given.columns
    ids = {r.doc_id for r in quality.collect()}
    assert {1000, 1001, 1002, 1003, 1004, None} <= ids
    assert sum(i % 4 in (1, 2) for i in ids if i is not None and i < 1000) <= 8
    after = {r.doc_id for r in near.collect()}
    assert 1000 in after and not {1001, 1002} & after and {1003, 1004, None} <= after
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert set(texts) == after
    assert prose(60, 9) in texts[1003] and texts[1004].split() == prose(100, 12).split()
    assert {r.doc_id for r in packed.collect()} == after


def test_pipeline_run_equals_its_stages(spark, stages):
    path, (*_, packed) = stages
    got = corpus_pipeline.run(spark, path)
    whole = lambda df: Counter((r.doc_id, r.doc_tokens) for r in df.collect() if r.start == 0)
    assert whole(got) == whole(packed)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    _, labels = corpus(spark, 8)
    edge.write_tables(spark, path, documents=edge.documents(spark, []), labels=labels)
    assert corpus_pipeline.run(spark, path).collect() == []


ODD_TEXTS = ["", " \t\n", "Éclair ÉCLAIR! eclair, Eclair", "one\x1ftwo two two THREE", "  #$% 12 a a a  ", "ΑΣ Σ ς İX", "nasty " * 300]


def test_words_of_a_slice_are_those_of_its_texts(monkeypatch):
    """Looks, scores and counts of whole slices equal those of single texts, and a word's letters are sought once."""
    texts = ODD_TEXTS + [f"{spelt(i)} Nasty, {spelt(i % 3)}" for i in range(20)] + ["\n"]
    words = cotraining.Words(pa.array(texts))
    split = [t.split() for t in texts]
    assert [{words.words[k] for k in words.which[words.owner == i]} for i in range(len(texts))] == [set(s) for s in split]
    looks = [cotraining.layout(t, s, len(set(s))) for t, s in zip(texts, split, strict=True)]
    assert np.allclose(words.looks, looks, rtol=1e-15)
    weights = {f: 0.1 * k for k, f in enumerate(cotraining.word_features("nasty") + cotraining.word_features(spelt(2)))}
    pages = [({"lang": "en", "source": f"s{i % 2}", "n_chars": None}, x) for i, x in enumerate(looks)]
    metadata = cotraining.Metadata.fit(pages * 10, np.arange(10 * len(pages)) % 3 == 0)
    metadata.weights[-1] = -20.0  # all are surely good to this view
    content = cotraining.Content(weights, -9.0)
    plain = content.score([np.array([f for w in set(s) for f in cotraining.word_features(w)], np.uint64) for s in split])
    asked, letters = [], cotraining.letters
    monkeypatch.setattr(cotraining, "letters", lambda w: asked.append(w) or letters(w))
    sums = cotraining.Sums(content, metadata)
    for some in (slice(0, 5), slice(5, None)):
        sums.add(pa.array(texts[some]), [p for p, _ in pages[some]])
    key, start, bad, good = sums.counts()
    assert sorted(set(asked) - {""}) == sorted(w for w in asked if w) == sorted({w for s in split for w in s})
    assert np.allclose(cotraining.Scorer(cotraining.Model(content, None, None, None)).contents(words)[0], plain)
    counted = {}
    for s in split:
        for w in set(s):
            counted[letters(w)] = counted.get(letters(w), 0) + 1
    counted.pop("")
    assert dict(zip(key, good, strict=True)) == {xxhash.xxh64_intdigest(c) - (1 << 63): n for c, n in counted.items()}
    assert not any(bad) and set(start) == {c[:8] for c in counted}


def test_fitting_holds_few_copies_of_the_views():
    rng = np.random.default_rng(2)
    features = [rng.integers(0, 40_000, 2000).astype(np.uint64) for _ in range(400)]
    y = (np.arange(400) % 4 == 0).astype(float)
    tracemalloc.start()
    cotraining.Content.fit(features, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4.5 * sum(f.nbytes for f in features)


def test_splitting_holds_few_copies_of_the_sketches():
    x = np.random.default_rng(3).normal(size=(6000, 512)).astype(np.float16)
    tracemalloc.start()
    tree = tail_routes.Tree.fit(x, 12)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tree.leaves == 12 and peak < 5 * x.nbytes  # two bytes a number, four in single precision
