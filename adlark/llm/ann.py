"""Maximum inner product search by anisotropic product quantisation (operator 1).

A vector is cut into pairs of components, and each pair is coded in four bits by the nearest of 16 centroids. Near in the sense
that counts for inner products: for a residual r of a vector x the loss is |r|^2 + (ETA - 1) (r . x / |x|)^2, so error
along x, which moves its scores, weighs ETA times as much as error across it. Codes are found by coordinate descent over
the pairs, centroids by the weighted least squares of that loss, on a sample of SAMPLE vectors at most; every row is coded.

A query's table has its inner product with each centroid; two codes are one byte, so a scan looks up and adds one
number for two pairs. The RERANK rows that are best by table are a query's shortlist. The k-th of their exact scores is a
floor for the k nearest, and a row's score is at most its approximation plus |query| |residual|: rows whose bound is below
the floor are out, and the others are ranked by exact inner products in double precision. So the result is exact whatever
the rows; codes decide how many rows need their vectors, and vectors that lie close together only take longer.

Rows are coded once and meet the queries in blocks: a task has ROWS rows and QUERIES queries at most (fewer, if vectors are
long), whatever the tables' sizes, and gives the k nearest of its block; the nearest of a query's blocks become one list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import prepare, stored, tasks, tidied

SAMPLE = 20_000
ROWS, QUERIES = 65_536, 16_384
BLOCK_BYTES = 32 << 20
PARALLEL_ROWS = 4_096
RERANK = 128
THRESHOLD = 0.2
CENTROIDS = 16


def _padded(x: np.ndarray) -> np.ndarray:
    """Pairs (rows x pairs x 2) of vectors, an even number of pairs."""
    more = -x.shape[1] % 4
    return np.pad(x, ((0, 0), (0, more))).reshape(len(x), -1, 2).astype(np.float64)


def _assign(x: np.ndarray, books: np.ndarray, eta: float, rounds: int, codes: np.ndarray | None = None) -> np.ndarray:
    unit = x / np.maximum(np.sqrt((x**2).sum(axis=(1, 2), keepdims=True)), 1e-30)
    n, m, _ = x.shape
    if codes is None:
        codes = np.stack([((x[:, j, None] - books[j]) ** 2).sum(axis=2).argmin(axis=1) for j in range(m)], axis=1)
    along = np.stack([((x[:, j] - books[j][codes[:, j]]) * unit[:, j]).sum(axis=1) for j in range(m)], axis=1)
    total = along.sum(axis=1)
    for _ in range(rounds):
        for j in range(m):
            r = x[:, j, None] - books[j]
            a = (r * unit[:, j, None]).sum(axis=2)
            rest = total - along[:, j]
            codes[:, j] = ((r**2).sum(axis=2) + (eta - 1) * (rest[:, None] + a) ** 2).argmin(axis=1)
            along[:, j] = a[np.arange(n), codes[:, j]]
            total = rest + along[:, j]
    return codes


def weight(dim: int) -> float:
    """ETA for scores above THRESHOLD of a vector's norm: at least 1."""
    return max(1.0, (dim - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))


def fit(sample: np.ndarray, rounds: int = 6, seed: int = 5) -> np.ndarray:
    """Centroids (pairs x 16 x 2) for a sample of vectors."""
    x, eta = _padded(sample), weight(sample.shape[1])
    rng = np.random.default_rng(seed)
    books = x[rng.integers(0, len(x), CENTROIDS)].transpose(1, 0, 2).copy()
    books += rng.normal(0, 1e-6, books.shape)
    unit = x / np.maximum(np.sqrt((x**2).sum(axis=(1, 2), keepdims=True)), 1e-30)
    codes = None
    for step in range(2 * rounds):
        plain = step < rounds  # first k-means, then the anisotropic loss
        codes = _assign(x, books, 1.0 if plain else eta, 0 if plain else 1, None if plain else codes)
        e = 0.0 if plain else eta - 1
        along = np.stack([((x[:, j] - books[j][codes[:, j]]) * unit[:, j]).sum(axis=1) for j in range(x.shape[1])], axis=1)
        total = along.sum(axis=1)
        for j in range(x.shape[1]):
            u, c = unit[:, j], codes[:, j]
            rest = total - along[:, j]
            mass = np.bincount(c, minlength=CENTROIDS)
            a = np.zeros((CENTROIDS, 2, 2))
            b = np.zeros((CENTROIDS, 2))
            pull = x[:, j] + e * (rest + (x[:, j] * u).sum(axis=1))[:, None] * u
            for p in range(2):
                b[:, p] = np.bincount(c, pull[:, p], CENTROIDS)
                for q in range(2):
                    a[:, p, q] = np.bincount(c, e * u[:, p] * u[:, q], CENTROIDS) + (p == q) * mass
            full = mass > 0
            books[j][full] = np.linalg.solve(a[full], b[full][:, :, None])[:, :, 0]
            books[j][~full] = x[rng.integers(0, len(x), int((~full).sum())), j]
            along[:, j] = ((x[:, j] - books[j][c]) * u).sum(axis=1)
            total = rest + along[:, j]
    return books


def encode(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Codes of vectors: a byte for two pairs, the first in its low half."""
    codes = _assign(_padded(x), books, weight(x.shape[1]), 2).astype(np.uint8)
    return codes[:, ::2] | codes[:, 1::2] << 4


def errors(x: np.ndarray, codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """For each vector a number that times |query| bounds the error of an approximate score, rounding in `scan` included."""
    halves = np.stack([codes & 15, codes >> 4], axis=2).reshape(len(codes), -1)
    made = books[np.arange(books.shape[0])[None, :], halves]
    with np.errstate(over="ignore", invalid="ignore"):
        missed = np.sqrt(((_padded(x) - made) ** 2).sum(axis=(1, 2)))
    most = (missed + (codes.shape[1] + 4) * 2.0**-22 * np.sqrt((made**2).sum(axis=(1, 2)))) * (1 + 1e-9)
    return np.where(np.isnan(most), np.inf, most)


def tables(queries: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Inner products of queries with the centroids of two pairs at a time: queries x bytes x 256."""
    one = np.einsum("qmd,mkd->qmk", _padded(queries), books).astype(np.float32)
    return (one[:, 1::2, :, None] + one[:, ::2, None, :]).reshape(len(queries), -1, 256)


def scan(codes: np.ndarray, lut: np.ndarray) -> np.ndarray:
    """Approximate scores: queries x rows."""
    out = np.zeros((len(lut), len(codes)), np.float32)
    for j in range(codes.shape[1]):
        out += np.take(lut[:, j], codes[:, j], axis=1)
    return out


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component to the last."""
    return np.cumsum(x * q, axis=1)[:, -1] + 0.0


def nearest_in(codes: np.ndarray, most: np.ndarray, x: np.ndarray, ids: np.ndarray, asked: np.ndarray, asked_ids: np.ndarray, books: np.ndarray, scale: float, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row (places) and score of the k rows of largest inner product for each query, but those of its own id."""
    found = []
    largest = np.abs(asked).max(axis=1, keepdims=True)
    small = asked / largest  # queries of moderate numbers: their tables stay finite
    length = np.sqrt((small**2).sum(axis=1))
    peak = np.abs(x).max(axis=1)
    rounding = 4 * x.shape[1] * 2.0**-52 * peak * np.sqrt(((x / peak[:, None]) ** 2).sum(axis=1))  # of a score, in units of |query|
    for a in range(0, len(asked), 32):
        approx = scan(codes, tables(small[a : a + 32], books))
        for i, q in enumerate(asked[a : a + 32], a):
            row, own, unit = approx[i - a], ids == asked_ids[i], length[i] * largest[i, 0]
            row[own] = -np.inf
            short = np.argpartition(row, -rerank)[-rerank:] if rerank < len(row) else np.arange(len(row))
            short = short[~own[short]]
            with np.errstate(over="ignore", invalid="ignore"):
                floor = _kth(x[short] @ q - rounding[short] * unit, k)
                at = np.flatnonzero(~own & ~((row + length[i] * most) * (scale * largest[i, 0]) < floor - abs(floor) * 1e-9 - 1e-300))
                rough, slack = x[at] @ q, rounding[at] * unit  # in an order of its own: only those near the k-th are summed in turn
                at = at[~(rough + slack < _kth(rough - slack, k))]
                score = products(x[at], q)
            order = np.lexsort((ids[at], -np.where(np.isnan(score), np.inf, score), ~np.isnan(score)))[:k]  # not a number first, as in Spark
            found.append((np.full(len(order), i), at[order], score[order]))
    return tuple(np.concatenate(f) for f in zip(*found))


def _kth(scores: np.ndarray, k: int) -> float:
    """The k-th largest, what isn't a number counting as the largest; -inf if there are fewer."""
    if len(scores) < k:
        return -np.inf
    return float(np.partition(np.where(np.isnan(scores), np.inf, scores), -k)[-k])


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """Vectors in units of the sample's largest component, so that squares and tables stay finite; for codes only."""
    return np.clip(x / scale, -1e3, 1e3)


def _coded(model, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    books, scale = model.value
    for batch in batches:
        if batch.num_rows:
            x = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False))
            codes = encode(scaled(x, scale), books)
            most = errors(x / scale, codes, books)
            packed = [pa.array([r.tobytes() for r in part], pa.binary()) for part in (codes, x.astype(kind))]
            names = ["uid", "vec_id", "asked", "searched"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), packed[0], pa.array(most), packed[1]], names=[*names, "code", "most", "vector"])


def _search(model, kind: str, k: int, rerank: int, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if not len(rows) or not len(queries):
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    books, scale = model.value
    matrix = lambda column, t: np.frombuffer(b"".join(column), t).reshape(len(column), -1)
    codes, x, asked = matrix(rows["code"], np.uint8), matrix(rows["vector"], kind).astype(np.float64), matrix(queries["vector"], kind).astype(np.float64)
    ids, asked_ids = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    q, r, score = nearest_in(codes, rows["most"].to_numpy(), x, ids, asked, asked_ids, books, scale, k, rerank)
    return pd.DataFrame({"query_id": asked_ids[q], "vec_id": ids[r], "score": score})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part: ids and vectors that aren't null, all components finite, not all zero."""
    finite = F.forall("embedding", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite & F.exists("embedding", lambda v: v != 0)).dropDuplicates(["vec_id", "embedding"])


def nearest(vectors: DataFrame, is_query, k: int = 20, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score of the k rows of largest inner product for each row where is_query holds.

    Equal rows count once; a row with the query's id isn't its neighbour. Rows of one id with different vectors are rows of
    their own; as queries they share one list. Of equal vectors only the k + 1 of smallest ids can be among k nearest, so
    others aren't searched (they still are queries). Vectors of another length than most take no part. Fewer candidates:
    fewer ranks. An empty table: no rows. Further columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    good = usable(vectors)
    sizes = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = good.filter(F.size("embedding") == sizes["d"])
    n = sizes["count"]
    sample = good.select("embedding") if n <= SAMPLE else good.filter(F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n)).select("embedding")
    drawn = np.stack(sample.limit(2 * SAMPLE).toPandas()["embedding"].to_numpy())  # at most 2 * SAMPLE vectors
    scale = float(np.abs(drawn).max(initial=0.0)) or 1.0
    model = spark.sparkContext.broadcast((fit(scaled(drawn[np.lexsort(drawn.T[::-1])], scale)), scale))
    copy = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    marked = good.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("asked"), copy.alias("copy")).filter((F.col("copy") <= k + 1) | F.col("asked"))
    numbered = marked.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "embedding", "asked", (F.col("copy") <= k + 1).alias("searched"))
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    rows, _ = stored(numbered.mapInArrow(lambda b: tidied(_coded(model, kind, b)), "uid long, vec_id long, asked boolean, searched boolean, code binary, most double, vector binary"), "codes")
    left, right = rows.filter("searched").select("uid", "vec_id", "code", "most", "vector"), rows.filter("asked").select("uid", "vec_id", "vector")
    fit_in = lambda count: max(1, min(count, BLOCK_BYTES // (8 * sizes["d"])))
    g, h = max(1, -(-n // fit_in(ROWS))), max(1, -(-right.count() // fit_in(QUERIES)))
    g = max(g, min(-(-tasks(spark) // h), -(-n // PARALLEL_ROWS)))  # small tables: a task for each core
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    block = lambda count: F.pmod(F.xxhash64("uid"), F.lit(count)).cast("int")
    left = left.withColumn("g", block(g)).withColumn("h", spread(h))
    right = right.withColumn("h", block(h)).withColumn("g", spread(g))
    found = left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInPandas(lambda a, b: _search(model, kind, k, rerank, a, b), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
