"""Token ids in fixed-width bit-packed shards with block offsets (operator 5).

A shard is one file:

    4s magic, u32 bits, u32 ids in a block, u32 blocks, u64 ids, u64 documents
    u64[blocks + 1]     byte offset of each block behind the tables
    i64[documents]      doc_id, u8[documents] 1 where doc_id is null
    u64[documents + 1]  first id of each document in the shard
    blocks              each id in `bits` bits, least significant bit first, each block from a byte boundary

All offsets are known before an id is decoded, so any block, document or range is read alone: `Shard` reads the tables and then
just the bytes of the blocks that a range needs. `unpack`, `read_range` and `header` do the same on bytes in memory.

Workers write and read files through Arrow's file systems (file, hdfs, s3, gs, abfs). A file gets its name when it is complete,
and a task that runs again writes the same bytes under the same name.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pieces import encoder
from .runtime import documents, prepare, shared_dir, stored, tasks, tidied

MAGIC = b"ABP1"
HEAD = struct.Struct("<4sIIIQQ")
BLOCK_IDS = 1024
SHARD_IDS = 2_000_000
#: Ids that a reader asks for at a time.
READ_IDS = 1 << 18
END_ID = 2


def width(vocabulary: int) -> int:
    """Bits that the largest id of a vocabulary needs."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """ids in `bits` bits each, least significant first; the last byte is filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (planes.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(np.uint32)


def pack(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> bytes:
    """One shard of documents whose ids lie one after another; starts has one entry more than doc_ids."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id doesn't fit {bits} bits")
    blocks = [pack_bits(ids[k : k + block], bits) for k in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)]).astype("<u8")
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], "u1")
    return b"".join([HEAD.pack(MAGIC, bits, block, len(blocks), len(ids), len(doc_ids)), offsets.tobytes(), known.tobytes(), null.tobytes(), starts.astype("<u8").tobytes(), *blocks])


def header(data: bytes) -> dict:
    """Tables of a shard; `body` is the byte where its blocks begin."""
    magic, bits, block, blocks, n, docs = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a shard of packed ids")
    at = HEAD.size
    offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
    at += 8 * (blocks + 1)
    ids, null = np.frombuffer(data, "<i8", docs, at), np.frombuffer(data, "u1", docs, at + 8 * docs)
    at += 9 * docs
    return {"bits": bits, "block": block, "n": n, "offsets": offsets, "doc_ids": ids, "null": null, "starts": np.frombuffer(data, "<u8", docs + 1, at).astype(np.int64), "body": at + 8 * (docs + 1)}


def read_range(data: bytes, first: int, last: int, head: dict | None = None) -> np.ndarray:
    """Ids first to last - 1 of a shard; only the blocks that hold them are read."""
    h = head or header(data)
    first, last = max(0, first), min(last, h["n"])
    if last <= first:
        return np.zeros(0, np.uint32)
    a, b = first // h["block"], (last - 1) // h["block"]
    out = [unpack_bits(data[h["body"] + h["offsets"][k] : h["body"] + h["offsets"][k + 1]], min(h["block"], h["n"] - k * h["block"]), h["bits"]) for k in range(a, b + 1)]
    return np.concatenate(out)[first - a * h["block"] : last - a * h["block"]]


def unpack(data: bytes) -> np.ndarray:
    """All ids of a shard."""
    h = header(data)
    if h["bits"] in (8, 16, 32) and h["block"] * h["bits"] % 8 == 0:  # then the blocks join without gaps
        return unpack_bits(data[h["body"] :], h["n"], h["bits"])
    return read_range(data, 0, h["n"], h)


def write_file(path: str, data: bytes) -> None:
    """A file that appears whole or not at all."""
    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    unfinished = f"{at}.{uuid.uuid4().hex}"
    with store.open_output_stream(unfinished, compression=None) as f:
        f.write(data)
    store.move(unfinished, at)


class Shard:
    """A shard's file: its tables are read at once, ids by ranges of blocks."""

    def __init__(self, path: str):
        store, at = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(at)
        _, _, _, blocks, _, docs = HEAD.unpack(self.file.read_at(HEAD.size, 0))
        self.head = header(self.file.read_at(HEAD.size + 8 * (blocks + 1) + 9 * docs + 8 * (docs + 1), 0))

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *error) -> None:
        self.file.close()

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first to last - 1; only the blocks that hold them are read."""
        h = self.head
        first, last = max(0, first), min(last, h["n"])
        if last <= first:
            return np.zeros(0, np.uint32)
        a, b = first // h["block"], (last - 1) // h["block"] + 1
        begin, end = int(h["offsets"][a]), int(h["offsets"][b])
        data, n = self.file.read_at(end - begin, h["body"] + begin), min(b * h["block"], h["n"]) - a * h["block"]
        if h["block"] * h["bits"] % 8 == 0:  # then the blocks join without gaps
            out = unpack_bits(data, n, h["bits"])
        else:
            cut = (h["offsets"][a : b + 1] - begin).tolist()
            out = np.concatenate([unpack_bits(data[x:y], min(h["block"], n - k * h["block"]), h["bits"]) for k, (x, y) in enumerate(zip(cut, cut[1:]))])
        return out[first - a * h["block"] : last - a * h["block"]]


def _shards(folder: str, path: str, end_id: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc, part = encoder(path), TaskContext.get().partitionId()
    bits = width(max(enc.size, (end_id or 0) + 1))
    docs, sizes, held, n, k = [], [], [], 0, 0

    def shard() -> pa.RecordBatch:
        ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
        data = pack(docs, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), ids, bits)
        write_file(name := f"{folder}/{part:06d}-{k:06d}.abp", data)
        return pa.RecordBatch.from_pydict({"shard_id": pa.array([(part << 32) + k], pa.int64()), "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()), "n_bytes": pa.array([len(data)], pa.int64()), "path": pa.array([name], pa.string())})

    for batch in batches:
        offsets, ids = enc.encode(batch.column("text"))
        if end_id is not None:
            ids, offsets = np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))
        for doc, a, b in zip(batch.column("doc_id").to_pylist(), offsets, offsets[1:]):
            docs.append(doc)
            sizes.append(b - a)
            held.append(ids[a:b])
            n += b - a
            if n >= SHARD_IDS:
                yield shard()
                docs, sizes, held, n, k = [], [], [], 0, k + 1
    if docs:
        yield shard()


def write_shards(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID, folder: str | None = None) -> DataFrame:
    """Encode whole texts and write files of bit-packed shards in ascending doc_id order to `folder`, by default one in the shared folder.

    A row per file: shard_id (ascends with doc_id), n_docs, n_ids, n_bytes, path. Null text: empty. Null doc_id: first, kept as null.
    Repeated doc_ids stay separate documents, in the order of their texts. No documents: no shards. Further columns
    are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = documents(docs).repartitionByRange(tasks(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    folder = folder or f"{shared_dir(spark)}/adlark-shards-{uuid.uuid4().hex}"
    schema = "shard_id long, n_docs long, n_ids long, n_bytes long, path string"
    return stored(rows.mapInArrow(lambda b: tidied(_shards(folder, tokenizer, end_id, b)), schema), "shards")[0]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document of each file, from ranges of READ_IDS ids (or of one longer document)."""
    for batch in batches:
        for shard, path in zip(batch.column("shard_id").to_pylist(), batch.column("path").to_pylist()):
            with Shard(path) as s:
                h, starts = s.head, s.head["starts"]
                a, docs = 0, len(s.head["doc_ids"])
                while a < docs:
                    b = max(a + 1, int(np.searchsorted(starts, starts[a] + READ_IDS, side="right")) - 1)
                    at = (starts[a : b + 1] - starts[a]).tolist()
                    flat = memoryview(s.ids(int(starts[a]), int(starts[b])).astype("<u4").tobytes())
                    yield pa.RecordBatch.from_pydict({
                        "shard_id": pa.array(np.full(b - a, shard), pa.int64()),
                        "doc_id": pa.array(h["doc_ids"][a:b], pa.int64(), mask=h["null"][a:b].astype(bool)),
                        "at": pa.array(starts[a:b], pa.int64()),
                        "n_tokens": pa.array(np.diff(starts[a : b + 1]), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(flat[4 * x : 4 * y]) for x, y in zip(at, at[1:])], pa.int64()),
                    })
                    a = b


def read_index(shards: DataFrame) -> DataFrame:
    """A row per document read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, shard_id."""
    prepare(shards.sparkSession)
    before = Window.orderBy("shard_id").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard of millions of ids
    base = shards.select("shard_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    rows = shards.select("shard_id", "path").mapInArrow(lambda b: tidied(_read(b)), "shard_id long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(base, "shard_id").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard_id")
