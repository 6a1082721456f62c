"""Cost-balanced packing of token ids into sequences (operator 4).

The cost of a piece of n tokens is n + n * n / capacity: a linear part for the layers and a quadratic one for attention.
Documents meet in groups of a few hundred by a hash of their id. Within a group a full sequence is cut off a long document
as often as it fills one; what remains of each goes, the costliest first, to the sequence of least cost that still
holds it whole. Remainders that fit nowhere are cut to fill the gaps. A group's sequences hold exactly its tokens: full
ones, and for the last tokens one for each power of two, which needs no padding either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import encoder
from .runtime import documents, prepare, tidied

CAPACITY = 4096
GROUP_DOCS = 512
END_ID = 2


def cost(n, capacity: int = CAPACITY):
    """Estimated cost of attending over n tokens."""
    return n + n * n / capacity


def plan(sizes: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold each token of documents of these sizes once.

    Ties: the earlier document and the earlier sequence first. Documents without tokens get no piece.
    """
    pieces, left, full = [], [], 0
    for d, n in enumerate(np.asarray(sizes, np.int64).tolist()):
        for k in range(n // capacity):
            pieces.append((d, k * capacity, capacity, full, 0))
            full += 1
        if n % capacity:
            left.append((n % capacity, d, n - n % capacity))
    total = sum(x[0] for x in left)
    room = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if total % capacity >> b & 1]
    room, spent = np.array(room, np.int64), np.zeros(len(room))
    used, rest = np.zeros(len(room), np.int64), []

    def put(s: int, d: int, start: int, n: int) -> None:
        pieces.append((d, start, n, full + s, int(used[s])))
        used[s] += n
        spent[s] += cost(n, capacity)

    for n, d, start in sorted(left, key=lambda x: (-x[0], x[1])):
        fits = np.flatnonzero(room - used >= n)
        if len(fits):
            put(int(fits[np.argmin(spent[fits])]), d, start, n)
        else:
            rest.append((n, d, start))
    gaps = iter(np.flatnonzero(used < room).tolist())
    s = next(gaps, None)
    for n, d, start in rest:
        while n:
            if used[s] == room[s]:
                s = next(gaps)
            take = int(min(n, room[s] - used[s]))
            put(s, d, start, take)
            start, n = start + take, n - take
    return pieces


def _encode(path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    kind = "<u2" if max(enc.size, end_id + 1) <= 1 << 16 else "<u4"
    for batch in batches:
        offsets, ids = enc.encode(batch.column("text"))
        ids, offsets = np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))
        flat, item = ids.astype(kind).tobytes(), int(kind[-1])
        data = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * item).astype("<i8").tobytes()), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("bin"), data.cast(pa.binary()), pa.array(np.full(len(data), item), pa.int32())], names=["doc_id", "bin", "ids", "item"])


def _pack(capacity: int, group: pd.DataFrame) -> pd.DataFrame:
    group = group.assign(crc=[zlib.crc32(x) for x in group["ids"]]).sort_values(["doc_id", "crc"], kind="stable", na_position="first")
    ids = [np.frombuffer(x, f"<u{n}").astype("<u4") for x, n in zip(group["ids"], group["item"])]
    docs, base = group["doc_id"].tolist(), int(group["bin"].iloc[0]) << 32
    rows = [(docs[d], start, n, zlib.crc32(ids[d][start : start + n].tobytes()), len(ids[d]), base + s, at) for d, start, n, s, at in plan(np.array([len(x) for x in ids]), capacity)]
    out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return out.assign(doc_id=out["doc_id"].astype("Int64"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pack whole documents, each ended by end_id, into sequences of at most `capacity` tokens (a power of two).

    A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null text: empty, so one token.
    Null doc_ids and repeated rows are documents like others. No documents: no rows. Further columns are ignored.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = docs.sparkSession
    prepare(spark)
    groups = max(1, -(-docs.count() // group_docs))  # reads no column; a group stays small at any size
    rows = documents(docs).withColumn("bin", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    coded = rows.mapInArrow(lambda b: tidied(_encode(tokenizer, end_id, b)), "doc_id long, bin long, ids binary, item int")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return coded.groupBy("bin").applyInPandas(lambda g: _pack(capacity, g), schema)
