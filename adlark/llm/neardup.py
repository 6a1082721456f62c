"""Near-duplicates by HyperMinHash (operator 3).

A text's set of five-word shingles is hashed once. The first eight bits of a hash pick one of 256 buckets, and a bucket keeps
of its least hash the number of leading zeros and ten bits of mantissa: two bytes. Bands of five registers are the keys of
candidates; registers of empty buckets borrow from others in a fixed random order, for the bands only. Two sets of a
Jaccard similarity of 0.75 share no band of 51 with a probability of about one in a million.

Equal sets are one node from the start. The members of a band are paired with its least member, which links most groups in
one round and grows with the members, not with their square. Then, in bands that still hold several components, members of
different components are compared by their registers, block by block, so no pair that shares a band is left out but
those whose components are joined already. A pair goes on if its estimate, corrected for registers that agree by
chance, is within five standard errors of the threshold; what is left is confirmed on the full sets of the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .runtime import documents, drop, prepare, stored, tidied, tidy
from .words import words_of

WORDS = 5
REGISTERS, MANTISSA = 256, 10
EMPTY = np.uint16(0xFFFF)
BAND = 5
BANDS = REGISTERS // BAND
NUM, DEN = 75, 100
ERRORS = 5.0
BLOCK = 512
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles; a shorter text's words are one; no words, none."""
    bounds, index, vocab = words_of(texts)
    word = np.array([xxhash.xxh3_64_intdigest(w) for w in vocab.to_pylist()], np.uint64)
    h = word[index] if len(index) else np.zeros(0, np.uint64)
    n = max(len(h) - WORDS + 1, 0)
    whole = np.zeros(n, np.uint64)
    for k in range(WORDS):
        whole += h[k : k + n] * _ODD[k]
    whole = mix(whole)
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(whole[a : b - WORDS + 1]))
        else:
            part = np.array([b - a], np.uint64) if b > a else np.zeros(0, np.uint64)
            for k in range(a, b):
                part = part + h[k : k + 1] * _ODD[k - a : k - a + 1]
            out.append(mix(part))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """256 compressed registers of each set (a row of uint16)."""
    out = np.full((len(sets), REGISTERS), EMPTY, np.uint16)
    size = np.array([len(s) for s in sets], np.int64)
    if not size.sum():
        return out
    u, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    bucket = (u >> np.uint64(56)).astype(np.int64) + row * REGISTERS
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # sets are sorted: a bucket's least hash comes first
    low = (u[first] & np.uint64((1 << 56) - 1)) >> np.uint64(4)
    zeros = (52 - np.frexp(low.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((low << zeros) >> np.uint64(51 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out.ravel()[bucket[first]] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


_PROBES = np.random.default_rng(11).integers(0, REGISTERS, (96, REGISTERS))


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Keys (rows of BANDS) of sets that aren't empty."""
    full = regs.copy()
    for probe in _PROBES:
        if not (full == EMPTY).any():
            break
        full = np.where(full == EMPTY, regs[:, probe], full)
    for _ in range(REGISTERS):  # what is left takes the next register's
        if not (full == EMPTY).any():
            break
        full = np.where(full == EMPTY, np.roll(full, -1, axis=1), full)
    part = full[:, : BANDS * BAND].reshape(len(regs), BANDS, BAND).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(regs), 1), np.uint64)
    for k in range(BAND):
        key = mix(key * _ODD[4] + part[:, :, k] + np.uint64(1))
    return key.view(np.int64)


def octaves(n: np.ndarray) -> np.ndarray:
    """For sets of these sizes, the probability of each number of leading zeros in a register."""
    edge = 0.5 ** np.arange(0, 41)
    edge[-1] = 0
    return np.diff((1 - edge) ** (np.asarray(n, float)[:, None] / REGISTERS), axis=1)


def estimates(ra: np.ndarray, rb: np.ndarray, oa: np.ndarray, ob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarities estimated from rows of registers and their standard errors at the threshold.

    Registers of disjoint sets agree by chance if leading zeros do, with a probability of 2**-MANTISSA; oa, ob: octaves.
    """
    used = (ra != EMPTY) | (rb != EMPTY)
    n = np.maximum(used.sum(axis=1), 1)
    c = (oa * ob).sum(axis=1) / (1 << MANTISSA)
    return ((((ra == rb) & used).sum(axis=1) / n) - c) / (1 - c), np.sqrt(NUM / DEN * (1 - NUM / DEN) / n)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sets given as sorted hashes reach the threshold, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both) and both > 0


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column("text"))
        size = np.array([len(s) for s in sets], np.int64)
        regs = registers(sets)
        keys = band_keys(regs[size > 0])
        at = np.cumsum(size > 0) * BANDS
        with np.errstate(over="ignore"):
            one = np.array([mix(s ^ _ODD[0]).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
            two = np.array([mix(s ^ _ODD[1]).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(size), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array([r.tobytes() for r in regs], pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], at]).astype(np.int32)), pa.array(keys.ravel())),
        ], names=["doc_id", "n_shingles", "set1", "set2", "regs", "bands"])


def _rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            j, error = estimates(_rows(batch.column("ra")), _rows(batch.column("rb")), octaves(batch.column("na").to_numpy()), octaves(batch.column("nb").to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(j >= NUM / DEN - ERRORS * error))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [linked(x, y) for x, y in zip(shingle_sets(batch.column("ta")), shingle_sets(batch.column("tb")))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _link_block(block: pd.DataFrame) -> pd.DataFrame:
    """Links that join different components within a block of a band, or between two of them.

    Pairs are taken by falling estimate and confirmed on full sets, unless links found before have joined their
    components already; so there are fewer links than rows, however many pairs are alike.
    """
    left = block[block["side"] == 0].reset_index(drop=True)
    right = left if block["i"].iloc[0] == block["j"].iloc[0] else block[block["side"] == 1].reset_index(drop=True)
    empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    if not len(left) or not len(right):
        return empty
    rl, rr = _rows(pa.array(left["regs"])), _rows(pa.array(right["regs"]))
    ol, orr = octaves(left["n_shingles"].to_numpy()), octaves(right["n_shingles"].to_numpy())
    cl, cr, found = left["comp"].to_numpy(), right["comp"].to_numpy(), []
    for i in range(len(left)):
        to = np.flatnonzero(cr != cl[i])
        if right is left:
            to = to[to > i]
        if len(to):
            j, error = estimates(rl[i][None, :], rr[to], ol[i][None, :], orr[to])
            ok = j >= NUM / DEN - ERRORS * error
            found.append((j[ok].astype(np.float32), np.full(int(ok.sum()), i, np.int32), to[ok].astype(np.int32)))
    if not found:
        return empty
    est, i, j = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(-est, kind="stable")
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    sets: dict[tuple[int, int], np.ndarray] = {}

    def of(side: int, k: int) -> np.ndarray:
        if (side, k) not in sets:
            sets[side, k] = shingle_sets(pa.array([(left, right)[side]["text"][k]]))[0]
        return sets[side, k]

    out = []
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        ra, rb = root(int(cl[a])), root(int(cr[b]))
        if ra != rb and linked(of(0, a), of(0 if right is left else 1, b)):
            parent[max(ra, rb)] = min(ra, rb)
            out.append((int(left["doc_id"][a]), int(right["doc_id"][b])))
    if len(left) * len(right) > 1 << 16:
        del found, est, i, j, order, sets
        tidy()
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _across(rows: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components of rows (band, doc_id, comp, n) that share a band; blocks of BLOCK rows meet in pairs."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.join(reps.select("doc_id", "regs", "n_shingles"), "doc_id").join(texts, "doc_id").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    spots = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"), (k < F.col("own")).cast("int").alias("side")))
    dealt = rows.select("band", "doc_id", "comp", "regs", "n_shingles", "text", F.explode(spots).alias("at")).select("band", "doc_id", "comp", "regs", "n_shingles", "text", "at.i", "at.j", "at.side")
    return dealt.groupBy("band", "i", "j").applyInPandas(_link_block, "a long, b long")


def _confirmed(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    s = lambda x: sketches.select(F.col("doc_id").alias(x), F.col("regs").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}"))
    pairs = pairs.join(s("a"), "a").join(s("b"), "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(lambda b: tidied(_estimate(b)), "a long, b long")
    t = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}"))
    return pairs.join(t("a"), "a").join(t("b"), "b").select("a", "b", "ta", "tb").mapInArrow(lambda b: tidied(_confirm(b)), "a long, b long")


def _open(bands: DataFrame, shared: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows (band, doc_id, comp, n) of bands that still hold several components besides their least member."""
    label = F.coalesce("comp", "doc_id").alias("comp")
    rows = bands.join(shared.filter("n > 2"), "band").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("band", "doc_id", label, "n", "a")
    rest = rows.filter("doc_id != a").drop("a")
    several = rest.groupBy("band").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 < c2").select("band")
    return rest.join(several, "band")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for each row.

    Null text and text without words: the empty set, linked with nothing. Rows of one doc_id are one document, linked by
    what any of them holds. A null doc_id is linked with nothing: component_id null, kept. Further columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = documents(docs)
    sketch, sketch_path = stored(texts.mapInArrow(lambda b: tidied(_sketch(b)), "doc_id long, n_shingles long, set1 long, set2 long, regs binary, bands array<long>"), "sketch", "snappy")
    some = sketch.filter("n_shingles > 0 and doc_id is not null")
    # a table of its own, so that the join deals both sides anew and a set with very many copies can be split
    classes, classes_path = stored(some.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep")), "classes")
    member, member_path = stored(some.select("doc_id", "set1", "set2").join(classes, ["set1", "set2"]).select("doc_id", "rep", "set1", "set2"), "member")
    first = member.filter("doc_id = rep").select("doc_id", "set1", "set2").distinct()
    reps, reps_path = stored(some.join(first, ["doc_id", "set1", "set2"]).select("doc_id", "n_shingles", "regs", "bands"), "reps", "snappy")
    result_rows, rows_path = stored(sketch.select("doc_id", "n_shingles"), "rows")
    drop(spark, sketch_path, classes_path)
    bands = reps.select("doc_id", F.explode("bands").alias("band"))
    shared, shared_path = stored(bands.groupBy("band").agg(F.min("doc_id").alias("a"), F.count("*").alias("n"), F.max("doc_id").alias("z")).filter("a < z"), "bands")
    cand = bands.join(shared, "band").filter("doc_id > a").select("a", F.col("doc_id").alias("b")).distinct()
    copies = member.filter("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links, links_path = stored(_confirmed(cand, reps, texts), "confirmed")
    comp, comp_path = components(links)
    paths = [member_path, reps_path, rows_path, shared_path, links_path, comp_path]
    joined = lambda: comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))  # noqa: E731  a link for each document says what all links found so far say
    for most in (True, False):  # first each document in its fullest open band, which joins most; then all that is open
        todo, path = stored(_open(bands, shared, comp), "open")
        paths.append(path)
        if not todo.limit(1).count():
            break
        if most:
            one = todo.groupBy("doc_id").agg(F.max(F.struct("n", "band")).alias("at")).select("doc_id", "at.band")
            todo = todo.join(one, ["doc_id", "band"])
        more, path = stored(_across(todo, reps, texts), "more")
        comp, comp_path = components(joined().union(more))
        paths += [path, comp_path]
    comp, comp_path = components(joined().union(copies))
    out = result_rows.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("comp", "doc_id")
    final, _ = stored(out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")), "near")
    drop(spark, comp_path, *paths)
    return final


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose document is the least of its group; of equal doc_ids all rows stay."""
    gone = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
