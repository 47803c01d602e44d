"""Token files, filtered clustering and bounded quantisation against brute force on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from math import floor
from pathlib import Path

import edge
import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from lonja.llm import net_bound_codes, pca_clusters, token_files, whole_vectors

VOCABULARY = "word_bpe_49k.json"
VECTORS = "vec_id long, embedding array<float>, label int, v string, codes int, error string, dim string, cluster int"


def expected_files(rows, end=2):
    """(doc_id, start, ids) in file order, up to the order of rows with one doc_id."""
    model = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    ids = [(r[0], [*model.encode(r[1] or "", add_special_tokens=False).ids, end]) for r in rows]
    return sorted(ids, key=lambda x: (x[0] is not None, x[0] or 0))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_every_document_in_order(spark, tmp_path):
    folder, path = f"file://{tmp_path}/files", public_tokenizers.path(VOCABULARY)
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "part-000000-of-a-failed-attempt.ids").write_bytes(b"left over")
    token_files.write_token_files(edge.documents(spark), folder, path)
    expected = expected_files(edge.rows())
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [i for i, _ in expected]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((i, len(x), crc(x)) for i, x in expected)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    files = token_files.TokenFiles(folder)
    assert len(files.parts) > 1 and files.n_docs == len(expected) and files.n_ids == sum(len(x) for _, x in expected)
    assert {p.name for p in Path(tmp_path / "files").glob("part-*")} == {f"{p['name']}.{s}" for p in files.parts for s in token_files.SUFFIXES}
    whole = []
    for place, r in enumerate(found):
        doc_id, start, ids = files.document(place)
        assert (doc_id, start, crc(ids)) == (r.doc_id, r.start, r.ids_crc32) and ids.dtype == "<u2"
        whole += ids.tolist()
    for start, n in ((0, 10), (files.n_ids - 3, 10), (5, files.n_ids), (files.n_ids, 4)):
        assert files.ids(start, n).tolist() == whole[start : start + n]
    with pytest.raises(IndexError):
        files.document(files.n_docs)


def test_a_hot_document_is_spread_over_parts(spark, tmp_path):
    rows = [(7, "the same words again", None, None, 0, *(0, 0, "r", 0, 0, 0, "d", "b"))] * 400
    parts = token_files.write_token_files(edge.documents(spark, rows), f"{tmp_path}/hot", public_tokenizers.path(VOCABULARY))
    assert len(parts) > 2 and max(p["n_docs"] for p in parts) < 250 and sum(p["n_docs"] for p in parts) == 400
    assert [p["base"] for p in parts] == np.cumsum([0] + [p["n_ids"] for p in parts])[:-1].tolist()


def test_end_ids_beyond_the_vocabulary_widen_the_files(spark, tmp_path):
    rows = [(1, "two words", None, None, 0, *(0, 0, "r", 0, 0, 0, "d", "b"))]
    token_files.write_token_files(edge.documents(spark, rows), f"{tmp_path}/w", public_tokenizers.path(VOCABULARY), end_id=70_000)
    files = token_files.TokenFiles(f"{tmp_path}/w")
    assert files.kind == "<u4" and files.document(0)[2].tolist()[-1] == 70_000


def test_token_files_of_the_query_and_of_an_empty_table(spark, tmp_path):
    sf = edge.write_tables(spark, str(tmp_path / "sf"), documents=edge.documents(spark))
    found = token_files.op11_token_files(spark, sf)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.count() == len(edge.rows())
    none = edge.write_tables(spark, str(tmp_path / "none"), documents=edge.documents(spark, []))
    assert token_files.op11_token_files(spark, none).collect() == []


# --- vectors ---------------------------------------------------------------------------------------


def table(spark, pairs):
    return spark.createDataFrame([(i, v, None if i is None or i % 4 == 0 else i % 3, "v", 0, "e", "d", 0) for i, v in pairs], VECTORS)


def awkward(dim, n=120, seed=5):
    """Groups, copies, ties, nulls, other lengths, and a zero vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    rows = [(i, (centres[i % 9] + rng.normal(size=dim) * 0.2).astype("f4").tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(n // 2)] + [rows[0], rows[0], (None, rows[5][1]), (None, rows[5][1])]
    rows += [(900, None), (901, [1.0] * (dim - 1) + [None]), (902, [float("nan")] + [0.0] * (dim - 1))]
    return rows + [(903, [float("inf")] * dim), (904, [0.0] * dim), (905, [-0.0] * dim), (906, [1.0, 2.0]), (907, [])]


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def ints(v, scale):
    return [floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale for x in v]


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def moved(members, old):
    return [sum(c) // len(members) for c in zip(*members, strict=True)] if members else old


def brute_clusters(rows, dim=64, k=8, rounds=10, scale=1024):
    kept = [(i, tuple(v)) for i, v in rows if usable(v) and len(v) == dim]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    x = [ints(v, scale) for _, v in kept]
    centroids = [ints(v, scale) for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for step in range(rounds + 1):
        near = [min((apart(v, c), j) for j, c in enumerate(centroids)) for v in x]
        if step < rounds:
            centroids = [moved([v for v, (_, j) in zip(x, near, strict=True) if j == c], old) for c, old in enumerate(centroids)]
    return Counter((i, j, d) for (i, _), (d, j) in zip(kept, near, strict=True)), centroids


def outlier(dim, size):
    return [size] + [0.5] * (dim - 1)


@pytest.mark.parametrize("more", [[], [(500, outlier(64, 3e7)), (501, outlier(64, -3e5))]])
def test_clusters_match_brute_force(spark, more):
    rows = awkward(64) + more
    work = []
    found, centroids = pca_clusters.cluster(table(spark, rows), progress=lambda n, tried: work.append((n, tried)))
    expected, last = brute_clusters(rows)
    assert Counter(map(tuple, found.collect())) == expected and centroids == last
    assert len(work) == 10 and all(n <= tried for n, tried in work)
    if not more:
        assert sum(t for _, t in work) < 0.5 * sum(8 * n for n, _ in work)  # the filter spares most distances
    digests = pca_clusters.with_digests(found, centroids).collect()
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, last[r.cluster])).encode()).hexdigest() for r in digests)
    assert {r.inertia for r in digests} == {sum(d * n for (_, _, d), n in expected.items())}


def test_clusters_of_vectors_beyond_64_bits(spark):
    far = 2.0**80
    rows = [(i, [far * (1 + i % 3), *[float(i // 30)] * 3]) for i in range(90)]
    found, centroids = pca_clusters.cluster(table(spark, rows), dim=4, clusters=6, leading=2)
    expected, last = brute_clusters(rows, dim=4, k=6)
    # three starts at most share a far component, so all distances are small
    assert centroids == last and Counter(map(tuple, found.collect())) == expected


def test_ties_go_to_the_smaller_number_and_few_rows_make_few_clusters(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(6)]
    found, centroids = pca_clusters.cluster(table(spark, rows), dim=2, leading=1)
    expected, last = brute_clusters(rows, dim=2)
    assert Counter(map(tuple, found.collect())) == expected and centroids == last and len(last) == 6
    for none in ([], [(1, None), (2, [1.0])]):
        found, centroids = pca_clusters.cluster(table(spark, none), dim=2, leading=1)
        assert found.collect() == [] and centroids == []


def test_bounds_are_below_distances():
    rng = np.random.default_rng(3)
    v, c = rng.integers(-2000, 2000, (300, 64)), rng.integers(-2000, 2000, (8, 64))
    rotation = pca_clusters.Rotation(v.mean(axis=0), np.linalg.eigh(np.cov(v.T))[1][:, :8])
    bounds = pca_clusters.Centroids(c, rotation).bounds(*rotation.apply(v.astype(float)))
    assert (bounds <= whole_vectors.squared(v[:, None], c[None])).all() and (bounds > 0).any()


def brute_codes(rows, parts=8, k=16, rounds=6, scale=4096):
    kept = [(i, v) for i, v in rows if usable(v)]
    out, books = Counter(), {}
    for dim in {len(v) for _, v in kept}:
        mine = sorted(((i, tuple(v)) for i, v in kept if len(v) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        x = [ints(v, scale) for _, v in mine]
        codes, errors, books[dim] = [[] for _ in x], [0] * len(x), []
        for lo, hi in net_bound_codes.cuts(dim, parts):
            w = [v[lo:hi] for v in x]
            book = w[:k]
            for step in range(rounds + 1):
                near = [min((apart(v, c), j) for j, c in enumerate(book)) for v in w]
                if step < rounds:
                    book = [moved([v for v, (_, j) in zip(w, near, strict=True) if j == c], old) for c, old in enumerate(book)]
            books[dim].append(book)
            for r, (d, j) in enumerate(near):
                codes[r].append(j)
                errors[r] += d
        out += Counter((i, bytes(c), e, dim) for (i, _), c, e in zip(mine, codes, errors, strict=True))
    return out, books


@pytest.mark.parametrize("more", [[], [(500, outlier(64, 3e6)), (501, outlier(64, -3e4))]])
def test_codes_match_brute_force(spark, more):
    rows = awkward(64) + more
    work = []
    found, books = net_bound_codes.quantise(table(spark, rows), progress=lambda *x: work.append(x))
    expected, last = brute_codes(rows)
    assert Counter((r.vec_id, bytes(r.codes), r.error, r.dim) for r in found.collect()) == expected
    assert books == last and set(books) == {0, 2, 64}
    assert [w[0] for w in work] == list(range(7)) and work[0][1] == work[0][2]
    if not more:
        assert sum(w[2] for w in work[1:]) < 0.5 * sum(w[1] for w in work[1:])  # bounds spare most comparisons


def test_net_displacement_forgets_a_way_back():
    far, near = np.array([[0], [100], [1000]]), np.array([[0], [700], [1000]])
    one = net_bound_codes.History([near, far, near])
    assert one.net[0].max() < 1e-6 and one.farthest[0].max() < 1e-6 and one.net[1][1] >= 600
    state = {"codes": np.array([1], "u1"), "upper": np.array([5.0]), "lower": np.array([290.0])}
    state |= {"upper_round": np.array([0], "u1"), "lower_round": np.array([0], "u1")}
    assert len(one.assign(np.array([[705]]), state, 2)) == 0 and state["upper_round"][0] == 0
    # bounds of the round in between, when the entry was away, don't do
    state |= {"lower": np.array([100.0]), "lower_round": np.array([1], "u1"), "codes": np.array([2], "u1")}
    state |= {"upper": np.array([295.0]), "upper_round": np.array([1], "u1")}
    assert one.assign(np.array([[705]]), state, 2).tolist() == [0] and state["codes"][0] == 1


def test_codes_of_the_query_by_label(spark, tmp_path):
    rows = [(i, v) for i, v in awkward(64) if v is None or len(v) == 64]
    sf = edge.write_tables(spark, str(tmp_path / "sf"), embeddings=table(spark, rows))
    found = net_bound_codes.op13_net_bound_codes(spark, sf).collect()
    expected, books = brute_codes(rows)
    digest = hashlib.sha256(",".join(str(x) for p in books[64] for e in p for x in e).encode()).hexdigest()
    assert Counter((r.vec_id, r.code, r.error) for r in found) == Counter({(i, c.hex(), e): n for (i, c, e, _), n in expected.items()})
    assert {r.codebooks_sha256 for r in found} == {digest}
    by_label = Counter()
    for r in found:
        by_label[None if r.vec_id is None or r.vec_id % 4 == 0 else r.vec_id % 3] += r.error
    assert all(r.label_error == by_label[None if r.vec_id is None or r.vec_id % 4 == 0 else r.vec_id % 3] for r in found)
    none = edge.write_tables(spark, str(tmp_path / "none"), embeddings=table(spark, []))
    assert net_bound_codes.op13_net_bound_codes(spark, none).collect() == []
    assert pca_clusters.op12_pca_clusters(spark, none).collect() == []


def test_sums_of_any_size_come_back():
    sums = whole_vectors.Sums(4)
    for x in (3, -(10**30), 2**41, -7):
        sums.add(0, np.array([x, -x, 0, abs(x)], object))
    totals = [0] * 4
    for slot, limb, s in sums.rows():
        assert -(1 << 63) <= s < 1 << 63
        totals[slot] += s << whole_vectors.LIMB * limb
    assert totals == sums.totals
