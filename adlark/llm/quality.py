"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k (operator 8).

Features of a text are its words, lowered and without marks at their ends, and pairs of neighbouring word shapes (letters as
a or A, digits as 0, marks as they are, runs once). Each kind is hashed to BUCKETS buckets, and a model draws features of
each kind from a smoothed distribution over them. The raw model is learnt from all documents; the target model from
labelled clean ones, drawn from half of at most LABELLED labelled rows by a hash of their id. The log importance weight of a
text is the sum over all its features of log target probability - log raw probability.

That sum alone can't show a few insults within long clean prose: on 51,000 documents it rejects all of low quality and 4 % of
toxic ones. So a weight is also bounded by that of the text's weakest passage of PASSAGE words under models that count in how
many texts a feature occurs (a text that repeats itself counts once). The other half of the labelled rows, so that no text is
judged by its own words, sets a cut for whole texts and one for passages, and the bound is shifted by their difference.

Keys are log weight + Gumbel noise (a hash of the row) and the k largest are kept, which samples k documents without
replacement in proportion to their weights. k is a parameter; by default it is the number of documents whose log weight
reaches the cut for whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import drop, prepare, stored, tidied
from .words import words_of

BUCKETS = 1 << 17
SHAPES = 1 << 12
LABELLED = 20_000
PASSAGE = 3
#: What the raw model expects of a bucket is added so many times to both counts: of features, of texts.
PRIOR, TEXT_PRIOR = 20.0, 4.0
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_MARK = np.isin(np.arange(256), list(MARKS))
_SHAPE = np.array([ord("a") if 97 <= b <= 122 or b > 127 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256)], np.uint8)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)
#: Longer ranges get their CRC one by one.
LONG = 64


def crcs(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """zlib.crc32 of each range of a buffer, a byte of all ranges at a time."""
    size = end - start
    long = size > LONG
    steps = np.where(long, 0, size).astype(np.int16)
    order = np.argsort(steps, kind="stable")[::-1]  # ranges with a k-th byte come first, for any k
    many = len(steps) - np.cumsum(np.bincount(steps, minlength=1))
    at, crc = start[order], np.full(len(steps), 0xFFFFFFFF, np.uint32)
    for k, n in enumerate(many[:-1].tolist()):
        crc[:n] = _CRC[(crc[:n] ^ buf[at[:n] + k]) & 255] ^ crc[:n] >> 8
    out = np.empty(len(steps), np.int64)
    out[order] = ~crc
    for i in np.flatnonzero(long).tolist():
        out[i] = zlib.crc32(buf[start[i] : end[i]])
    return out


def stripped(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of a buffer without marks at their ends; those of marks alone are empty."""
    plain = ~_MARK[raw]
    place, before = np.flatnonzero(plain), np.concatenate([[0], np.cumsum(plain)])
    first, last = before[start], before[end]
    some = first < last
    a, z = start.copy(), start.copy()
    a[some], z[some] = place[first[some]], place[last[some] - 1] + 1
    return a, z


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """bounds of texts, and for each word its bucket and that of its shape after the shape before it.

    A shape has the word's classes of characters, each run once: that of "Word," is "Aa,", that of "WORD!!" is "A!".
    """
    bounds, index, vocab = words_of(texts, lower=False)
    if not len(index):
        return bounds, index, index
    edges = np.frombuffer(vocab.buffers()[1], np.int64)[vocab.offset : vocab.offset + len(vocab) + 1]
    raw = np.frombuffer(vocab.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    word = crcs(_LOWER[raw], *stripped(raw, edges[:-1], edges[1:])) % BUCKETS
    shape = _SHAPE[raw]
    fresh = np.append(True, shape[1:] != shape[:-1])
    fresh[edges[:-1]] = True
    runs = np.concatenate([[0], np.cumsum(fresh)])[edges]
    kind = crcs(shape[fresh], runs[:-1], runs[1:]) % SHAPES
    k = kind[index]
    before = np.empty_like(k)
    before[1:] = k[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = SHAPES
    return bounds, word[index], (before * 31 + k) % BUCKETS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, texts = np.zeros(2 * BUCKETS, np.int64), np.zeros(2 * BUCKETS, np.int64)
    for batch in batches:
        bounds, word, pair = features(batch.column("text"))
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * (2 * BUCKETS)
        for bucket in (word, pair + BUCKETS):
            total += np.bincount(bucket, minlength=2 * BUCKETS)
            each = np.sort(doc + bucket)
            texts += np.bincount(each[np.diff(each, prepend=-1) > 0] % (2 * BUCKETS), minlength=2 * BUCKETS)
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full]), pa.array(texts[full])], names=["bucket", "n", "texts"])


def counts(docs: DataFrame) -> np.ndarray:
    """How often features of each bucket occur, and in how many texts: two rows of 2 * BUCKETS numbers whatever the size of the table."""
    got = docs.select("text").mapInArrow(lambda b: tidied(_count(b)), "bucket int, n long, texts long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).toArrow()
    out = np.zeros((2, 2 * BUCKETS))
    out[:, got["bucket"].to_numpy()] = got["n"].to_numpy(), got["texts"].to_numpy()
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log ratio of the two models' probabilities for each bucket, word buckets first, shrunk to 0 by the prior."""
    out = np.zeros(2 * BUCKETS, np.float32)
    for s in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        expected = raw[s] / max(raw[s].sum(), 1) * target[s].sum()
        out[s] = np.log((target[s] + prior) / (expected + prior))
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Of the models of features and of those of texts, from rows of `counts`."""
    return np.stack([log_ratio(target[0], raw[0], PRIOR), log_ratio(target[1], raw[1], TEXT_PRIOR)])


def weights(texts: pa.Array, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weight of each whole text, and that of its weakest passage; 0 without words."""
    bounds, word, pair = features(texts)
    size = np.diff(bounds)
    sums = [np.concatenate([[0], np.cumsum(r[word].astype(np.float64) + r[BUCKETS + pair])]) for r in ratios]
    whole, weakest = (total[bounds[1:]] - total[bounds[:-1]] for total in sums)
    long = np.flatnonzero(size > PASSAGE)
    if len(long):
        # windows of PASSAGE words that start at each word; those that would leave a text don't count
        w = np.append(sums[1][PASSAGE:] - sums[1][:-PASSAGE], np.inf)
        edges = np.column_stack([bounds[long], bounds[long + 1] - PASSAGE + 1]).ravel()
        weakest[long] = np.minimum.reduceat(w, edges)[::2]
    return whole, weakest


def _weigh(ratios, text: str, back: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole, weakest = weights(batch.column(text), ratios.value)
        names = [c for c in batch.schema.names if back or c != text]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(whole), pa.array(weakest)], names=[*names, "_whole", "_weakest"])


def weighed(docs: DataFrame, ratios, shift: float, back: bool = True) -> DataFrame:
    """The columns of docs as c0, c1, ... in their order, so that no name can clash, and _weight and _key; the text only if it shall come back."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(17), docs["doc_id"], F.coalesce(docs["text"], F.lit(""))), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    rows = docs.select(*(docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(docs.columns)), unit.alias("_unit"))
    text = f"c{docs.columns.index('text')}"
    schema = T.StructType([*(f for f in rows.schema.fields if back or f.name != text), T.StructField("_whole", T.DoubleType()), T.StructField("_weakest", T.DoubleType())])
    rows = rows.mapInArrow(lambda b: tidied(_weigh(ratios, text, back, b)), schema)
    weight = F.least(F.col("_whole"), F.col("_weakest") + F.lit(shift))
    return rows.withColumn("_weight", weight).withColumn("_key", F.col("_weight") - F.log(-F.log("_unit"))).drop("_unit", "_whole", "_weakest")


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight from which most rows are rightly called: half the error each of good and bad ones, the middle of the best gap."""
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    lost = np.searchsorted(np.sort(good), cuts) / len(good)
    let = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    error = 10 * lost + let  # a good document lost weighs more than a bad one kept
    at = np.flatnonzero(error <= error.min() + 1e-12)
    return float(cuts[at[len(at) // 2]])


def top_k(keys: DataFrame, k: int) -> float:
    """The k-th largest value of column _key of a stored table, by counting in ever finer bins; no sort, no collected rows."""
    n, low, high = keys.agg(F.count("*"), F.min("_key"), F.max("_key")).first()
    if k >= n or not n:
        return -np.inf
    if k <= 0:
        return np.inf
    above = 0
    for _ in range(6):
        step = (high - low) / 4096
        if step <= 0 or low + step == low:
            break
        place = F.least(F.floor((F.col("_key") - low) / step), F.lit(4095)).cast("int")
        bins = {r[0]: r[1] for r in keys.filter(F.col("_key").between(low, high)).groupBy(place).count().collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b] >= k:
                break
            above += bins[b]
        if bins[b] == k - above == 1 or above + bins[b] == k:
            return low + b * step
        low, high = low + b * step, min(high, low + (b + 1) * step)
    return low


def fit(docs: DataFrame, labels: DataFrame):
    """The log ratios of both models, the least log weight that counts as good, and the shift of passages against whole texts.

    Without labels of both kinds every text counts as good and passages bound nothing.
    """
    marked = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    n = marked.count()
    if n > LABELLED:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * LABELLED / n)))
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good")
    sample, path = stored(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(marked.select("doc_id", good, (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)) == 0).alias("learn")), "doc_id"), "labelled")
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(counts(sample.filter("good and learn")), counts(docs)))
    pairs = sample.filter("good is not null and not learn").select("good", "text").mapInArrow(lambda b: tidied(_weigh(ratios, "text", False, b)), "good boolean, _whole double, _weakest double").toArrow()  # LABELLED rows
    drop(docs.sparkSession, path)
    g = pairs["good"].to_numpy(zero_copy_only=False).astype(bool)
    whole, passage = (best_cut(w[g], w[~g]) for w in (pairs["_whole"].to_numpy(), pairs["_weakest"].to_numpy()))
    return ratios, max(whole, -1e300), max(whole, -1e300) - passage if np.isfinite(passage) else 1e300


def _threshold(docs: DataFrame, labels: DataFrame, k: int | None):
    """The log ratios, the shift, the least key that is kept, and a stored table of doc_id as c0, _weight and _key with its path."""
    spark = docs.sparkSession
    prepare(spark)
    ratios, cut, shift = fit(docs, labels)
    keys, path = stored(weighed(docs.select("doc_id", "text"), ratios, shift, False), "keys")
    least = top_k(keys, keys.filter(F.col("_weight") >= cut).count() if k is None else k)
    return ratios, shift, least, keys, path


def score(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """doc_id, log_weight, gumbel_key and kept for each row. Null and empty texts have weight 0, or the shift if that is less.

    Rows come from the stored table that the threshold was found in, so texts are weighed once. Equal rows agree, so where rows
    tie at the k-th key all of them are kept.
    """
    *_, least, keys, _ = _threshold(docs, labels, k)
    return keys.select(F.col("c0").alias("doc_id"), F.col("_weight").alias("log_weight"), F.col("_key").alias("gumbel_key"), (F.col("_key") >= least).alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of docs, with all their columns, that `score` keeps."""
    ratios, shift, least, _, path = _threshold(docs, labels, k)
    drop(docs.sparkSession, path)
    return weighed(docs, ratios, shift).filter(F.col("_key") >= least).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))
