"""Words of whole texts: A-Z lowered, split at the ASCII white space characters 9 to 13 and 32."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """The same texts with offsets from 0: Arrow's lowering and splitting misread texts that were cut out of longer arrays."""
    if not len(texts) or not texts.offset and np.frombuffer(texts.buffers()[1], np.int64, 1)[0] == 0:
        return texts
    return texts.take(pa.array(np.arange(len(texts))))


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """bounds (one more than texts), index of each word in the vocabulary, and the distinct words as binary.

    Null and empty texts, and those of white space alone, have no words.
    """
    texts = whole(texts.cast(pa.large_string()).fill_null(""))
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_binary())
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    bounds = cut.offsets.to_numpy().astype(np.int64)
    words = cut.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = bounds - bounds[0]
    empty = pc.equal(pc.binary_length(words), 0)
    if pc.any(empty).as_py():  # white space at an end of a text
        some = ~empty.to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(some)])[bounds]
        words = words.filter(pa.array(some))
    coded = words.dictionary_encode()
    return bounds, coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_binary())


_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of 64 bits of each range of a buffer, eight bytes of all ranges at a time."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    size = end - start
    h, at, k = _mixed(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), None, 0
    longest = int(size.max(initial=0))
    while k < longest:
        at = np.flatnonzero(size > k) if k else slice(None)
        x, rest = eight[start[at] + k], size[at] - k
        short = rest < 8
        x[short] &= (np.uint64(1) << (np.uint64(8) * rest[short].astype(np.uint64))) - np.uint64(1)
        h[at] = _mixed(h[at] * np.uint64(0x9E3779B97F4A7C15) + x)
        k += 8
    return h


class Spans:
    """Words of whole texts as ranges of one buffer of lowered bytes: bounds (words of each text), start, end and hash of each."""

    def __init__(self, texts: pa.Array):
        texts = whole(texts.cast(pa.large_string()).fill_null(""))
        cut = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1) if len(texts) else np.zeros(1, np.int64)
        n = int(cut[-1])
        raw = np.frombuffer(texts.buffers()[2], np.uint8, n) if n else np.zeros(0, np.uint8)
        word = ~_WHITE[raw]
        first, last = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        first[cut], last[cut] = True, True  # nothing reaches from a text into the next one
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1] | first[1:n]
        ends[:-1] &= ~word[1:] | last[1:n]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.buf = _LOWER[raw]
        self.bounds = np.searchsorted(self.start, cut)
        self.hash = hashes(self.buf, self.start, self.end)

    def bytes(self, at: np.ndarray) -> list[bytes]:
        data = memoryview(self.buf.tobytes())
        return [bytes(data[a:b]) for a, b in zip(self.start[at].tolist(), self.end[at].tolist())]


def _count(end: bytes | None, flush: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[bytes, int] = {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "c"])

    for batch in batches:
        spans = Spans(batch.column("text"))
        _, example, counts = np.unique(spans.hash, return_index=True, return_counts=True)
        for w, c in zip(spans.bytes(example), counts.tolist()):
            total[w] = total.get(w, 0) + c
        if end is not None and batch.num_rows:
            total[end] = total.get(end, 0) + batch.num_rows
        if len(total) > flush:
            yield rows()
            total.clear()
    if total:
        yield rows()


def count_words(docs: DataFrame, end: bytes | None = None, flush: int = 300_000) -> DataFrame:
    """Columns word (binary) and c: how often each word occurs in column text; `end` is counted once a text, if given."""
    part = docs.select("text").mapInArrow(lambda b: _count(end, flush, b), "word binary, c long")
    return part.groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, limit: int) -> Column:
    """Whether a row of a (word, c) table has so high a count that at most `limit` words have as much.

    Counts fall into levels a quarter of an octave wide; whole levels are taken from the top, so no sort is needed and
    the rows taken have a bound whatever the size of the vocabulary.
    """
    level = F.floor(F.log2("c") * 4).cast("int")
    kept, least = 0, None
    for lev, n in sorted(((r[0], r[1]) for r in counts.groupBy(level).count().collect()), reverse=True):  # a row per level
        if kept + n > limit:
            break
        kept, least = kept + n, lev
    return F.lit(False) if least is None else level >= least


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of a (word, c) table that are `frequent`."""
    return counts.filter(frequent(counts, limit))
