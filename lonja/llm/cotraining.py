"""Quality classifier by co-training on two views of a document.

The content view sees which words, and which beginnings of words, a text has. The metadata view sees where the
page comes from and what it looks like: source, language, declared length, and shares of character classes,
repeated and upper-case words. Both are logistic models, first fitted on labelled documents. In every round both
views judge the whole corpus in one pass, and each is taught the documents that the other is sure about, but for bad
ones that it is sure are good, and good ones that it holds for bad:

* the content view learns from counts: in how many documents sure to be bad, and sure to be good, a word occurs. The
  log odds of the features that speak for bad most add up to a number of its own, so words that no labelled document
  has are learnt, and the labelled documents decide how much it counts;
* the metadata view learns from the loss's gradient and curvature at its present weights, summed over the documents.
  All corpus documents together weigh as much as all labelled ones.

Tasks add up whole numbers, or fractions of fixed steps, so the sums don't depend on how rows are dealt. At the end
both views are calibrated on labelled documents that no fit has seen, and a logistic combination of the two calibrated
scores is fitted there; it scores all documents.

The driver holds the views of at most `SAMPLE` labelled documents (drawn by a hash of doc_id, whole texts read in
tasks), the sums of the metadata view and the `CORPUS_FEATURES` log odds; a model is at most `WORD_FEATURES` and these
weights, and a small table for the metadata.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm.common import discard, ship, table, written
from lonja.llm.word_ids import slices

SAMPLE = 5000
WORD_FEATURES, LEAST_Z, LEAST_DOCS = 1500, 4.0, 3
STARTS = (4, 5, 6, 7)
ROUNDS = 2
SURE_BAD, SURE_GOOD, DENIES = 0.95, 0.2, 0.04
CORPUS_FEATURES, CORPUS_Z, CORPUS_DOCS = 3000, 8.0, 10
BLOCK_ROWS = 500
LEAST_ODDS, MOST_ODDS = 1.0, 3.0  # of a feature, as logarithms
SLICE_BYTES = 4_000_000
NUMBER_STEP, WEIGHT_STEP = 2.0**-8, 2.0**-12
REJECT = 0.5
CACHED_WORDS = 150_000
FULL_TEXT = 1000  # word features (some 220 different words) beyond which a text's evidence is a share
VIEWS = ("lang", "source", "n_chars")

# classes of bytes: other symbols, lower, upper, digit, blank, line end, usual punctuation, beyond ASCII
BYTE_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n", b".,;:'\"-()?"), 1):
    BYTE_CLASS[list(_bytes)] = _k
BYTE_CLASS[128:] = 7


def letters(word: str) -> str:
    """The word in lower case without what isn't a letter at its ends."""
    if word.isalpha():
        return word.lower()
    lo, hi = 0, len(word)
    while lo < hi and not word[lo].isalpha():
        lo += 1
    while hi > lo and not word[hi - 1].isalpha():
        hi -= 1
    return word[lo:hi].lower()


def word_features(word: str) -> list[int]:
    """64-bit hashes of the word and of its beginnings."""
    return core_features(letters(word))


def core_features(core: str) -> list[int]:
    if not core:
        return []
    return [xxhash.xxh64_intdigest(core)] + [
        xxhash.xxh64_intdigest("^" + core[:n]) for n in STARTS if len(core) > n
    ]


def beginnings(cores: list[str]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """For each of STARTS, the positions of the longer cores, and the features that their beginnings are."""
    size, marked = np.fromiter(map(len, cores), np.int64, len(cores)), ["^" + core for core in cores]
    for n in STARTS:
        at = np.flatnonzero(size > n)
        yield at, [xxhash.xxh64_intdigest(marked[i][: n + 1]) for i in at.tolist()]


def layout(text: str, words: list[str], different: int) -> np.ndarray:
    """What a text looks like, as numbers near 0 to 1."""
    n = max(1, len(words))
    data = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(BYTE_CLASS[data], minlength=8) / max(1, len(data))
    more = [
        different / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        min(1.0, len(text) / n / 20),
        min(1.0, np.log1p(len(words)) / 12),
    ]
    return np.append(share, more)


class Words:
    """The different words of some texts (no null), which text has which, and what the texts look like.

    Arrow splits where `str.split` does and names the words, so that each is worked on once, not once per text.
    """

    def __init__(self, texts: pa.Array):
        trimmed = pc.utf8_trim_whitespace(texts)
        split = pc.utf8_split_whitespace(trimmed)
        coded = split.flatten().dictionary_encode()
        self.words, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        n, full = np.diff(split.offsets.to_numpy()), pc.binary_length(trimmed).to_numpy() > 0
        owner, size = np.repeat(np.arange(len(n)), n), max(1, len(self.words))
        if not full.all():  # a blank text is split into one empty word
            code, owner, n = code[full[owner]], owner[full[owner]], n * full
        key = np.sort(owner * size + code)
        key = key[np.diff(key, prepend=-1) > 0]
        self.n, self.owner = len(n), key // size
        self.which = key - self.owner * size  # the different words of each text, in the order of `owner`
        upper = np.fromiter(map(str.isupper, self.words), bool, len(self.words))[code]
        again = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
        self.looks = self._looks(texts, n, [self.owner, owner[1:][again], owner[upper]])

    def _looks(self, texts: pa.Array, n: np.ndarray, counted: list[np.ndarray]) -> np.ndarray:
        """`layout` of every text."""
        share, some = np.zeros((len(n), 8)), np.maximum(1, n)
        for i, data in enumerate(texts.cast(pa.binary()).to_pylist()):
            share[i] = np.bincount(BYTE_CLASS[np.frombuffer(data, np.uint8)], minlength=8) / max(1, len(data))
        chars = pc.utf8_length(texts).to_numpy()
        more = [np.bincount(x, minlength=len(n)) / some for x in counted]
        more += [np.minimum(1.0, chars / some / 20), np.minimum(1.0, np.log1p(n) / 12)]
        return np.column_stack([share, *more])


def numbered(words: list[str], known: dict[str, int]) -> tuple[np.ndarray, list[str]]:
    """The numbers of different words, and the new ones among them, which `known` numbers in their order from now on."""
    new = [w for w in words if w not in known]
    known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), new


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Taught:
    """Sums over corpus documents: a model's gradient and curvature at `at`, and their number."""

    at: np.ndarray
    gradient: np.ndarray
    curvature: np.ndarray
    n: int


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, taught: Taught | None = None) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression by Newton's method.

    `taught` adds the quadratic form of other rows, which together weigh as much as these.
    """
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    share = len(x) / taught.n if taught else 0.0
    for _ in range(25):
        p = sigmoid(x @ w)
        slope, curve = x.T @ (p - y) + penalty * w, np.diag(penalty)
        for some in range(0, len(x), BLOCK_ROWS):  # no second matrix of this size
            part = x[some : some + BLOCK_ROWS]
            curve += (part.T * (p * (1 - p))[some : some + BLOCK_ROWS]) @ part
        if taught:
            slope += share * (taught.gradient + taught.curvature @ (w - taught.at))
            curve += share * taught.curvature
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def share_of(features: int) -> float:
    """What a count is multiplied by in a text of so many features."""
    return FULL_TEXT / max(FULL_TEXT, features)


@dataclass
class Content:
    """Weights of word features; a text's feature counts its different words that have it.

    In texts of more than FULL_TEXT features the counts are scaled down to that many, so that evidence doesn't
    grow with the length alone: a long text is judged by the share of its words that speak for bad. Fitting and
    scoring see the same numbers.
    """

    weights: dict[int, float]
    constant: float

    @staticmethod
    def fit(
        features: list[np.ndarray], y: np.ndarray, weight_of_prior: float = 2.0, corpus: dict[int, float] | None = None
    ) -> Content:
        """Keeps the features that speak for bad most, by a z-score of their documents, and fits weights.

        `corpus`: weights that the corpus suggests. A text's sum of them is one more number, whose weight (how far
        the corpus is trusted) is fitted with the others.
        """
        once = [np.unique(f) for f in features]
        names, docs = np.unique(np.concatenate(once), return_counts=True)  # the driver has little room: no inverse
        seen, n = np.unique(np.concatenate([f for f, v in zip(once, y.tolist(), strict=True) if v]), return_counts=True)
        del once
        bad, rate = np.zeros(len(names)), y.mean()
        bad[np.searchsorted(names, seen)] = n
        z = (bad - docs * rate) / np.sqrt(docs * rate * (1 - rate) + 1e-9)
        keep = np.flatnonzero((docs >= LEAST_DOCS) & (z >= LEAST_Z))
        keep = np.sort(keep[np.argsort(-z[keep], kind="stable")[:WORD_FEATURES]])
        x = np.zeros((len(features), len(keep)), np.float32)
        for i, f in enumerate(features):
            at = np.searchsorted(names[keep], f)
            at[at == len(keep)] = 0
            if len(keep):
                hit = names[keep][at] == f
                x[i] = np.bincount(at[hit], minlength=len(keep)) * share_of(len(f))
        found = names[keep].tolist()
        if not corpus:
            w = logistic(x, y, weight_of_prior)
            return Content(dict(zip(found, w[:-1].tolist(), strict=True)), float(w[-1]))
        evidence = Content(corpus, 0.0).score(features)
        w = logistic(np.column_stack([x, evidence]), y, weight_of_prior)
        trust = max(0.0, float(w[-2]))
        weights = {f: v * trust for f, v in corpus.items()}
        for f, v in zip(found, w[:-2].tolist(), strict=True):
            weights[f] = weights.get(f, 0.0) + v
        return Content(weights, float(w[-1]))

    def score(self, features: list[np.ndarray]) -> np.ndarray:
        get = self.weights.get
        return np.array([self.constant + sum(get(f, 0.0) for f in doc.tolist()) * share_of(len(doc)) for doc in features])


@dataclass
class Metadata:
    """Weights of layout numbers (with squares) and of the most frequent sources and languages."""

    names: dict[tuple[str, str], int]
    weights: np.ndarray

    @staticmethod
    def fit(pages: list[tuple[dict, np.ndarray]], y: np.ndarray, taught: Taught | None = None) -> Metadata:
        seen: dict[tuple[str, str], int] = {}
        for values, _ in pages:
            for key in ("lang", "source"):
                seen[key, str(values[key])] = seen.get((key, str(values[key])), 0) + 1
        often = sorted((k for k, n in seen.items() if n >= 10), key=lambda k: (-seen[k], k))[:200]
        model = Metadata({k: i for i, k in enumerate(often)}, np.zeros(0))
        model.weights = logistic(model.matrix(pages), y, 0.5, taught)
        return model

    def matrix(self, pages: list[tuple[dict, np.ndarray]]) -> np.ndarray:
        named = np.zeros((len(pages), len(self.names)))
        numbers = []
        for i, (values, looks) in enumerate(pages):
            for key in ("lang", "source"):
                k = self.names.get((key, str(values[key])))
                if k is not None:
                    named[i, k] = 1
            n = values["n_chars"]
            said = np.log1p(max(0, n)) / 12 if n is not None else 0.0
            numbers.append(np.concatenate([looks * 4, np.sqrt(looks) * 4, [said, float(n is None)]]))
        return np.column_stack([named, np.array(numbers)])

    def score(self, pages: list[tuple[dict, np.ndarray]]) -> np.ndarray:
        return self.matrix(pages) @ self.weights[:-1] + self.weights[-1] if pages else np.zeros(0)


@dataclass
class Model:
    """Both views and how their scores are combined."""

    content: Content
    metadata: Metadata
    scales: np.ndarray  # slope and constant of either view's calibration
    combine: np.ndarray

    def chances(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chances to be bad by content, by metadata and together."""
        (sa, ca), (sb, cb) = self.scales
        za, zb = a * sa + ca, b * sb + cb
        w = self.combine
        return sigmoid(za), sigmoid(zb), sigmoid(np.clip(za, -12, 12) * w[0] + np.clip(zb, -12, 12) * w[1] + w[2])


class Reader:
    """Turns texts into the two views; the features of words seen before are remembered up to a bound."""

    def __init__(self):
        self.known: dict[str, np.ndarray] = {}

    def words(self, text: str) -> tuple[list[str], set[str]]:
        words = text.split()
        return words, set(words)

    def features(self, different: set[str]) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        found = []
        for w in different:
            f = self.known.get(w)
            if f is None:
                f = self.known[w] = np.array(word_features(w), np.uint64)
            found.append(f)
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


class Scorer:
    """A model applied to texts; what the words seen before add is remembered until `forget`."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.cores: dict[str, int] = {}
        self.core = np.zeros(0, np.int64)  # of each word
        self.weight, self.number = np.zeros(0), np.zeros(0, np.int64)  # of each core: its features' weight, and how many

    def known(self, words: list[str]) -> np.ndarray:
        """The numbers of the different words' cores."""
        found, new = numbered(words, self.words)
        if new:
            core = list(map(letters, new))
            _, cores = numbered(list(dict.fromkeys(core)), self.cores)
            self.core = np.append(self.core, np.fromiter(map(self.cores.__getitem__, core), np.int64, len(core)))
            get = self.model.content.weights.get
            weight = np.array([get(xxhash.xxh64_intdigest(c), 0.0) if c else 0.0 for c in cores], float)
            number = np.array([c != "" for c in cores], np.int64)
            for at, features in beginnings(cores):
                weight[at] += [get(f, 0.0) for f in features]
                number[at] += 1
            self.weight, self.number = np.append(self.weight, weight), np.append(self.number, number)
        return self.core[found]

    def contents(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The texts' scores by content, and the cores of their different words in the order of `words.owner`."""
        if len(self.words) > CACHED_WORDS:
            self.forget()
        core = self.known(words.words)[words.which]
        total = np.bincount(words.owner, self.weight[core], words.n)
        features = np.bincount(words.owner, self.number[core], words.n)
        return self.model.content.constant + total * (FULL_TEXT / np.maximum(FULL_TEXT, features)), core

    def content(self, different: set[str]) -> float:
        """The score of a text with these words."""
        core = self.known(list(different))
        return self.model.content.constant + float(self.weight[core].sum()) * share_of(int(self.number[core].sum()))


def cotrain(labelled: list[tuple], y: np.ndarray, judged) -> Model | None:
    """`labelled`: (word features, (values, layout)) of documents; y: 1 for bad. None if y is all one.

    `judged(content, metadata)` gives what the corpus teaches under these views: weights of features and a `Taught`.
    """
    if len(y) < 8 or not 0 < y.mean() < 1:
        return None
    held = np.random.default_rng(len(y)).permutation(len(y)) % 4 == 3  # for calibration
    if not 0 < y[held].mean() < 1 or not 0 < y[~held].mean() < 1:
        held[:] = False
    learn = np.flatnonzero(~held)
    words, pages = [labelled[i][0] for i in learn], [labelled[i][1] for i in learn]
    content, metadata = Content.fit(words, y[learn]), Metadata.fit(pages, y[learn])
    for _ in range(ROUNDS):
        corpus, taught = judged(content, metadata)
        content, metadata = Content.fit(words, y[learn], corpus=corpus), Metadata.fit(pages, y[learn], taught)
    at = np.flatnonzero(held) if held.any() else np.arange(len(y))
    a, b = content.score([labelled[i][0] for i in at]), metadata.score([labelled[i][1] for i in at])
    scales = np.array([logistic(s[:, None], y[at], 0.1) for s in (a, b)])
    both = np.column_stack([np.clip(s * m + c, -12, 12) for s, (m, c) in zip((a, b), scales, strict=True)])
    return Model(content, metadata, scales, logistic(both, y[at], 0.1))


def lessons(p: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which documents the other view is sure are bad, and good, and this view, with chances `p`, doesn't deny.

    Some pages are bad by one view alone, so a view without evidence isn't sure: it gives such a page the share of the
    other view's bad ones, which is why SURE_GOOD is above that share.
    """
    return (other >= SURE_BAD) & (p > DENIES), (other <= SURE_GOOD) & (p < 0.5)


class Sums:
    """What a task's documents teach: word counts, and sums of the metadata view."""

    def __init__(self, content: Content, metadata: Metadata):
        self.scorer, self.metadata = Scorer(Model(content, metadata, None, None)), metadata
        self.words = np.zeros((2, 0), np.int64)  # by the scorer's cores: documents sure to be bad, and good
        self.n = np.zeros(3, np.int64)  # documents that teach content bad, content good, metadata
        size = len(metadata.weights)
        self.gradient, self.curvature = np.zeros(size), np.zeros((size, size))

    def add(self, texts: pa.Array, pages: list[dict]) -> None:
        words = Words(pc.fill_null(texts, ""))
        a, core = self.scorer.contents(words)
        looks = list(zip(pages, words.looks, strict=True))
        x = np.column_stack([self.metadata.matrix(looks), np.ones(len(looks))])
        mine, pb = sigmoid(a), sigmoid(x @ self.metadata.weights)
        known = len(self.scorer.cores)
        self.words = np.pad(self.words, ((0, 0), (0, known - self.words.shape[1])))
        for k, rows in enumerate(lessons(mine, pb)):
            self.n[k] += rows.sum()
            self.words[k] += np.bincount(core[rows[words.owner]], minlength=known)
        bad, good = lessons(pb, mine)
        use = bad | good
        self.n[2] += use.sum()
        x, p = np.round(x[use] / NUMBER_STEP) * NUMBER_STEP, np.round(pb[use] / WEIGHT_STEP) * WEIGHT_STEP
        curve = np.round(p * (1 - p) / WEIGHT_STEP) * WEIGHT_STEP
        self.gradient += x.T @ (p - bad[use])
        self.curvature += (x.T * curve) @ x

    def counts(self) -> list[list]:
        """Hashes of the words, their first letters, bad, good; and forgets them."""
        cores = list(self.scorer.cores)
        at = [i for i in np.flatnonzero(self.words.any(0)).tolist() if cores[i]]
        found = [[xxhash.xxh64_intdigest(cores[i]) - (1 << 63) for i in at], [cores[i][: STARTS[-1] + 1] for i in at]]
        found += self.words[:, at].tolist()
        self.scorer.forget()
        self.words = np.zeros((2, 0), np.int64)
        return found

    def numbers(self) -> list[list]:
        """The other sums, as whole numbers of their smallest steps, by position."""
        step = NUMBER_STEP * WEIGHT_STEP
        flat = np.concatenate([self.n, self.gradient / step, self.curvature.ravel() / (step * NUMBER_STEP)]).astype(np.int64)
        at = np.flatnonzero(flat)
        return [at.tolist(), [None] * len(at), flat[at].tolist(), [0] * len(at)]


SUMS = "key long, start string, bad long, good long"


def _judged(docs: DataFrame, content: Content, metadata: Metadata) -> tuple[dict[int, float], Taught | None]:
    """One pass over all rows of `docs`: weights that word counts suggest, and the metadata view's sums."""
    shared = docs.sparkSession.sparkContext.broadcast((content, metadata))
    names = [c.split()[0] for c in SUMS.split(", ")]

    def rows(found: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(*shared.value)
        for batch in batches:
            for lo, n in slices(pc.fill_null(batch.column("text"), ""), SLICE_BYTES):  # few texts' words are held at a time
                some = batch.slice(lo, n)
                sums.add(some.column("text"), some.select(list(VIEWS)).to_pylist())
                if len(sums.scorer.words) > CACHED_WORDS:
                    yield rows(sums.counts())
        yield rows(sums.counts())
        yield rows(sums.numbers())

    size, step = len(metadata.weights), NUMBER_STEP * WEIGHT_STEP
    found = docs.select("text", *VIEWS).mapInArrow(run, SUMS).groupBy("key", "start")
    found = written(found.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "cotraining-sums")
    flat = np.zeros(3 + size + size * size)
    numbers = found.where("start IS NULL").select("key", "bad").toArrow()  # a row per number of the view
    flat[numbers.column("key").to_numpy()] = numbers.column("bad").to_numpy()
    bad, good, n = flat[:3].tolist()
    gradient, curvature = flat[3 : 3 + size] * step, flat[3 + size :].reshape(size, size) * step * NUMBER_STEP
    weights = _odds(found.where("start IS NOT NULL"), bad, good) if bad and good else {}
    discard(found)
    return weights, Taught(metadata.weights, gradient, curvature, int(n)) if n else None


def _odds(words: DataFrame, bad: float, good: float) -> dict[int, float]:
    """Weights of the features that speak for bad most: their log odds, shared by the features of a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, start, b, g = batch.columns
            yield pa.RecordBatch.from_arrays([key, b, g], names)  # the whole word's hash is known
            for at, features in beginnings(start.to_pylist()):
                shifted, at = pa.array([f - (1 << 63) for f in features], pa.int64()), pa.array(at)
                yield pa.RecordBatch.from_arrays([shifted, b.take(at), g.take(at)], names)

    names = ["feature", "bad", "good"]
    found = words.mapInArrow(run, "feature long, bad long, good long").groupBy("feature")
    found = found.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rate, docs = bad / (bad + good), F.col("bad") + F.col("good")
    z = (F.col("bad") - docs * rate) / F.sqrt(docs * (rate * (1 - rate)))
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5) * (good / bad))
    found = found.select("feature", z.alias("z"), odds.alias("odds"), "bad")
    found = found.where((F.col("bad") >= CORPUS_DOCS) & (F.col("z") >= CORPUS_Z) & (F.col("odds") >= LEAST_ODDS))
    best = found.orderBy(F.desc("z"), "feature").limit(CORPUS_FEATURES).collect()
    return {r.feature + (1 << 63): min(r.odds, MOST_ODDS) / (1 + len(STARTS)) for r in best}


def _drawn(ids: DataFrame, most: int) -> DataFrame:
    """At most `most` different doc_ids, those with the smallest hashes; few rows beyond that are sorted."""
    share = min(1.0, 4 * most / max(1, ids.count()))
    h = F.xxhash64("doc_id", F.lit(7))
    near = ids.where(h < F.lit(int(-(1 << 63) + share * ((1 << 64) - 1025))))
    return near.distinct().orderBy(h, "doc_id").limit(most)


EXAMPLE = "lang string, source string, n_chars long, features array<long>, looks array<double>"


def _examples(docs: DataFrame, ids: DataFrame) -> tuple[list[dict], list[tuple]]:
    """The drawn documents' other columns, and their views: whole texts are read in tasks, one row per id.

    The driver gets the views only: hashes of the features of a document's different words, and its looks.
    """
    ship(docs.sparkSession)
    rows = docs.where("text IS NOT NULL").join(F.broadcast(ids), "doc_id").groupBy(*ids.columns)
    one = rows.agg(F.min(F.struct("text", *VIEWS)).alias("d"))
    one = one.select(*ids.columns, "d.text", *[F.col(f"d.{c}").cast(t).alias(c) for c, t in zip(VIEWS, ("string", "string", "long"), strict=True)])
    kept, names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ids.schema), [*ids.columns, *VIEWS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            features, looks = [], []
            for text in batch.column("text").to_pylist():
                words, different = reader.words(text)
                features.append(reader.features(different).view(np.int64))
                looks.append(layout(text, words, len(different)))
            cols = [pa.array(features, pa.list_(pa.int64())), pa.array(looks, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *cols], [*names, "features", "looks"]
            )

    found = one.mapInArrow(run, f"{kept}, {EXAMPLE}").orderBy("doc_id").toArrow().combine_chunks()
    if not found.num_rows:
        return [], []
    flat, looks = (found.column(c).combine_chunks() for c in ("features", "looks"))
    at, numbers = flat.offsets.to_numpy(), looks.flatten().to_numpy().reshape(found.num_rows, -1)
    hashes = flat.values.to_numpy(zero_copy_only=False).view(np.uint64)
    others = found.drop(["features", "looks"]).to_pylist()
    views = [(hashes[lo:hi], (r, x)) for r, lo, hi, x in zip(others, at[:-1], at[1:], numbers, strict=True)]
    return others, views


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model | None:
    """Fits a model from `docs` (doc_id, text, lang, source, n_chars) and `labels` (doc_id, quality, toxic).

    Bad is quality 0 or toxic 1; of several labels for a document one bad one decides. Labels with nulls take no
    part, and of documents with a null doc_id or text none is a labelled one. All rows of `docs` are judged in every
    round, null texts as empty ones and repeated rows as often as they occur. Without labels of both kinds there is no
    model.
    """
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("double")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(bad).alias("bad"))
    types = zip(("doc_id", "text", *VIEWS), ("long", "string", "string", "string", "long"), strict=True)
    docs = docs.select(*[F.col(c).cast(t).alias(c) for c, t in types])
    drawn = _drawn(known.select("doc_id"), sample)
    rows, labelled = _examples(docs, drawn.join(known, "doc_id"))
    y = np.array([r["bad"] for r in rows])
    del rows
    model = cotrain(labelled, y, lambda a, b: _judged(docs, a, b))
    del labelled
    pa.default_memory_pool().release_unused()  # the driver has little room for what comes next
    return model


def score(docs: DataFrame, model: Model | None, *, row: tuple[str, ...] = ()) -> DataFrame:
    """(row, p_content, p_metadata, p_bad, kept): every row of `docs` as a struct with its chances to be bad.

    Rows with p_bad below REJECT are kept. A null text is empty, null metadata is a value of its own, and a
    text's whole length is read. Without a model nothing is known: chances are null and every row is kept. `row` names
    the columns that come back, if not all do; the text then goes to Python only.
    """
    views = [F.struct("text", *VIEWS).alias("views")] if row else []
    whole = docs.select(F.struct(*(row or "*")).alias("row"), *views)
    if model is None:
        nulls = [F.lit(None).cast("double").alias(c) for c in ("p_content", "p_metadata", "p_bad")]
        return whole.select("row", *nulls, F.lit(True).alias("kept"))
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            rows, seen = batch.column("row"), batch.column("views" if row else "row")
            texts = pc.fill_null(seen.field("text"), "")
            pages = [dict(zip(VIEWS, v, strict=True)) for v in zip(*(seen.field(c).to_pylist() for c in VIEWS), strict=True)]
            for lo, n in slices(texts, SLICE_BYTES):
                words = Words(texts.slice(lo, n))
                looks = list(zip(pages[lo : lo + n], words.looks, strict=True))
                found = scorer.model.chances(scorer.contents(words)[0], scorer.model.metadata.score(looks))
                cols = [pa.array(x, pa.float64()) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(lo, n), *cols, pa.array(found[2] < REJECT)], ["row", "p_content", "p_metadata", "p_bad", "kept"]
                )

    kind = whole.schema["row"].dataType.simpleString()
    return whole.mapInArrow(run, f"row {kind}, p_content double, p_metadata double, p_bad double, kept boolean")


def op8_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the chances that the two views and their combination give, and whether they are kept."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, row=("doc_id",)).select("row.doc_id", "p_content", "p_metadata", "p_bad", "kept")
