"""Ids of whole texts under tokenizers that lower case and never join across white space, word by word.

Texts are cut at ASCII white space, which such a tokenizer drops, and A-Z is lower-cased beforehand, so that fewer
words differ. Arrow splits a batch and names its distinct words; the library sees each of them once, however often
it occurs, and those met lately are remembered in two generations, of which only the older is ever forgotten. Ids
of the whole batch are then gathered by numpy.

A word of Latin letters with ASCII punctuation behind it is two parts, between which the tokenizer cuts as well;
one with an apostrophe is not, as that may begin an ending like 's. Such parts are one piece each to the
tokenizer, so many go into one call, and the ids of a part end with the first that closes a word. All other words
are encoded on their own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from lonja.llm.common import ship

REMEMBERED, TOGETHER, LONG_WORD = 150_000, 256, 64
# fixed values: letters below U+0250 that keep their form under NFC and lower-casing apart from case; ASCII
# punctuation but the apostrophe; the ending of tokens that close a word
LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-įı-ɏ"
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
CLOSES = "</w>"
BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")
LOW_BLANKS = BLANKS.lower()

TWO_PARTS = f"^(?P<letters>[{LETTERS}]+)(?P<rest>[{re.escape(PUNCTUATION)}]*)$"


class Recent:
    """A mapping that keeps what was asked for lately: at most two generations of `size` keys, and a batch."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def look_up(self, keys: list[str]) -> tuple[list, list[int]]:
        """Values, None where there is none, and the positions of these."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, keys))
        at = [i for i, value in enumerate(found) if value is None]
        again = list(map(self.old.get, [keys[i] for i in at]))
        for i, value in zip(at, again, strict=True):
            if value is not None:
                found[i] = self.young[keys[i]] = value
        return found, [i for i, value in zip(at, again, strict=True) if value is None]

    def add(self, keys: list[str], values: list[bytes]) -> None:
        pairs = zip(keys, values, strict=True)
        if max(map(len, keys), default=0) > LONG_WORD:
            pairs = [(k, v) for k, v in pairs if len(k) <= LONG_WORD]
        self.young.update(pairs)


def gathered(ids: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches `which` of ids that lie in a row with the given sizes, and where each of them ends."""
    count = size[which]
    until = np.cumsum(count)
    at = np.repeat((np.cumsum(size) - size)[which] - until + count, count)
    at += np.arange(len(at))
    return ids[at], until


class WordIds:
    """The ids of texts under the tokenizer of a file; ids are kept in the narrowest unsigned type."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.vocabulary = self.model.get_vocab_size()
        self.kind = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.closes = np.zeros(self.vocabulary, bool)
        self.closes[[i for token, i in self.model.get_vocab().items() if token.endswith(CLOSES)]] = True
        self.known = Recent(remembered)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of texts that are one piece each; normalising leaves their lower case as it is."""
        if not pieces:
            return []
        lines = [" ".join(pieces[i : i + TOGETHER]).lower() for i in range(0, len(pieces), TOGETHER)]
        normalizer = self.model.normalizer
        try:
            self.model.normalizer = None
            ids = np.concatenate(self._library(lines))
        finally:
            self.model.normalizer = normalizer
        blob, ends = ids.tobytes(), ((np.flatnonzero(self.closes[ids]) + 1) * ids.itemsize).tolist()
        if len(ends) != len(pieces) or ends[-1] != len(blob):
            raise ValueError("this tokenizer doesn't close every word")
        return [blob[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]

    def _parts(self, parts: list[str], piece: np.ndarray) -> list[bytes]:
        """Ids of distinct parts; `piece` says which are one piece."""
        found, missing = self.known.look_up(parts)
        alike = piece[missing]
        for some, encode in (
            (np.array(missing, np.int64)[alike].tolist(), self._pieces),
            (np.array(missing, np.int64)[~alike].tolist(), lambda x: [ids.tobytes() for ids in self._library(x)]),
        ):
            names = [parts[i] for i in some]
            values = encode(names)
            for i, value in zip(some, values, strict=True):
                found[i] = value
            self.known.add(names, values)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text begins and the last ends); texts hold no null."""
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(1, np.int64)
        # special tokens are in lower case, and must be so in the text
        plain = [t.translate(BLANKS if b"<|" in t else LOW_BLANKS) for t in map(str.encode, texts.to_pylist())]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()  # between two blanks there is an empty word
        two = pc.extract_regex(coded.dictionary, TWO_PARTS)
        whole = two.is_null()
        letters = pc.if_else(whole, coded.dictionary, two.field("letters"))
        rest = pc.if_else(whole, "", two.field("rest")).cast(letters.type)
        parts = pa.concat_arrays([letters, rest]).dictionary_encode()
        first, second = np.split(parts.indices.to_numpy(), 2)
        names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        piece = np.zeros(len(names), bool)
        piece[first[~whole.to_numpy(zero_copy_only=False)]] = True
        piece[second] = True
        if "" in names:
            piece[names.index("")] = False
        found = self._parts(names, piece)
        ids = np.frombuffer(b"".join(found), self.kind)
        size = np.fromiter(map(len, found), np.int64, len(found)) // ids.itemsize
        words, ends = gathered(ids, size, np.column_stack([first, second]).ravel())
        ends = ends[1::2]
        ids, until = gathered(words, np.diff(ends, prepend=0), coded.indices.to_numpy())
        return ids, np.append(0, until)[split.offsets.to_numpy()]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def numbering(spark: SparkSession, path: str) -> tuple[str, int]:
    """The type of a tokenizer's ids and their number, asked for in a task: the driver has little room for a tokenizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = word_ids(path)
            yield pa.RecordBatch.from_pydict(
                {"kind": [encoder.kind] * batch.num_rows, "vocabulary": [encoder.vocabulary] * batch.num_rows}
            )

    ship(spark)
    return tuple(spark.range(0, 1, 1, 1).mapInArrow(run, "kind string, vocabulary long").first())


def slices(texts: pa.Array, size: int):
    """(first, number) of runs of texts of about `size` bytes; a longer text is a run of its own."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > size:
            yield first, i - first
            first, held = i, 0
        held += n
    if first < len(texts):
        yield first, len(texts) - first
