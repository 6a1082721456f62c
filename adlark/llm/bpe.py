"""Byte-level BPE with ranks, encoding by Spark's higher-order functions and decoding by joining byte pieces (operator 9).

Each match of the vocabulary's pattern is a word. A word's bytes are folded by `aggregate`: the state is an array in which pieces, as
ids, take turns with the rank of their union with the next piece, between two pieces that unite with nothing; a step
merges the first pair of least rank and looks up two new ranks. A rank is the id of the union, so no bytes are joined. The ranks of
pairs are a literal, an array that rows of the left piece share (`pair_table`). Pieces that no merges reach are looked up before, in
small maps picked by CRC-32 of the word in hexadecimal, since a map of Spark's is searched from end to end.

Distinct words are encoded once: words are counted over all texts, and the frequent ones, of which there are HEAD_WORDS at
most, are encoded in one pass and sent to the workers. A text's other words are encoded in its own row by the same
fold, so nothing has to be joined or shuffled for them. Words of over LONG_BYTES bytes, on which a fold over arrays takes
quadratic time, are merged by a heap in Python; texts with them stay whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pieces import BYTE_PATTERN, LOOSE, SPLIT
from .runtime import drop, prepare, stored, tidied
from .words import hashes, most_frequent, whole

HEAD_WORDS = 1_500_000
LONG_BYTES = 200
BUCKETS = 65536
#: Bits of a rank; and what is added to an id in the fold's state, where it is then above all ranks.
SHIFT = 17
PIECE = 1 << SHIFT


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file: a line has a piece in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def rank_literal(ranks: dict[bytes, int]) -> str:
    """SQL of the ranks as array<map<hex string, int>>; a piece is in the map at CRC-32 of its hex string modulo BUCKETS."""
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        h = piece.hex().upper()
        maps[zlib.crc32(h.encode()) % BUCKETS][h] = rank
    return f"from_json('{json.dumps(maps, separators=(',', ':'))}', 'array<map<string,int>>')"


def pair_table(ranks: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray, dict[bytes, int]]:
    """The number of ids, offsets by id, owned ranks, and pieces that no merges reach: neighbours a, b are united to the id at offsets[a] + b, if a owns it.

    The rows of a table of pairs are laid over each other, the longest first, where they meet no other; an entry has its owner,
    plus PIECE, above SHIFT bits and the rank below. A piece has one pair: merges outside a piece's bytes don't change the order of
    those within, so whatever the word, its bytes come to the two parts that they come to alone.
    """
    rows: dict[int, dict[int, int]] = {}
    apart = {}
    for piece, rank in ranks.items():
        parts = merge_long(piece, ranks, False)
        if len(parts) == 2:
            rows.setdefault(parts[0], {})[parts[1]] = rank
        elif len(piece) > 1:
            apart[piece] = rank
    n = max(ranks.values()) + 1
    if any(bytes([b]) not in ranks for b in range(256)) or n >= 1 << SHIFT:
        raise ValueError(f"ranks have all 256 bytes and are below {(1 << SHIFT) - 1}")
    span, rng = 3 * sum(map(len, rows.values())) + 1, np.random.default_rng(1)
    offsets, owned, end = np.zeros(n + 1, np.int64), np.zeros(span + n + 1, np.int64), span + n + 1
    free = np.ones(len(owned), bool)
    for a, row in sorted(rows.items(), key=lambda x: (-len(x[1]), x[0])):
        b = np.fromiter(row, np.int64, len(row))
        for k in range(12):
            tried = rng.integers(0, span, min(8 << k, max(8, 200_000 // len(b))))
            fits = np.flatnonzero(free[tried[:, None] + b].all(axis=1))
            if len(fits):
                offsets[a] = tried[fits[0]]
                break
        else:  # beyond all others
            offsets[a], end = end, end + n + 1
            owned, free = np.concatenate([owned, np.zeros(n + 1, np.int64)]), np.concatenate([free, np.ones(n + 1, bool)])
        free[offsets[a] + b] = False
        owned[offsets[a] + b] = (a + PIECE) << SHIFT | np.fromiter(row.values(), np.int64, len(row))
    return n, offsets, owned, apart


def encode_words(words: str, ranks: dict[bytes, int]) -> Column:
    """Ids (array<array<int>>) of each word of an array<string> column, the fold described above. A null array stays null."""
    n, offsets, owned, apart = pair_table(ranks)
    edge, none = n + PIECE, PIECE

    def literal(x: np.ndarray) -> str:
        return f"from_json('{json.dumps(x.tolist(), separators=(',', ':'))}', 'array<bigint>')"

    def union(a: str, b: str) -> str:
        return f"(v[d[{a} - {PIECE}L] + {b}] ^ shiftleft({a}, {SHIFT}))"

    def let(value: str, name: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    merged = f"""concat(slice(q, 1, i - 3), array({union("q[i - 4]", "p")}, p, {union("p", "q[i + 2]")}), slice(q, i + 3, size(q)))"""
    step = let("array_min(q)", "m", f"if(m >= {1 << SHIFT}L, q, {let('int(array_position(q, m))', 'i', let(f'm + {PIECE}L', 'p', merged))})")
    pairs = f"flatten(transform(sequence(0, size(c) - 2), k -> array(c[k], {union('c[k]', 'c[k + 1]')})))"
    pairs = f"if(size(c) < 2, cast(array() as array<bigint>), {pairs})"
    first = f"concat(array({edge}L, {none}L), {pairs}, array(c[size(c) - 1], {none}L, {edge}L))"
    ids = f"q -> transform(sequence(3, size(q) - 2, 2), k -> int(q[k - 1] - {PIECE}L))"
    pieces = "transform(split(decode(encode(x, 'UTF-8'), 'ISO-8859-1'), ''), y -> b[ascii(y)])"
    fold = let(pieces, "c", f"aggregate(sequence(1, size(c)), {first}, (q, j) -> {step}, {ids})")
    each = f"if(x = '', cast(array() as array<int>), {fold})"
    if apart:
        known = f"try_element_at(t[cast(crc32(h) % {BUCKETS} as int)], h)"
        each = let("hex(encode(x, 'UTF-8'))", "h", let(known, "w", f"if(w is null, {each}, array(w))"))
    every = f"transform({words}, x -> {each})"
    single = np.array([ranks[bytes([k])] + PIECE for k in range(256)])
    for name, value in [("b", literal(single)), ("d", literal(offsets - PIECE)), ("v", literal(owned)), *([("t", rank_literal(apart))] if apart else [])]:
        every = let(value, name, every)
    return F.expr(every)


def merge_long(word: bytes, ranks: dict[bytes, int], whole: bool = True) -> list[int]:
    """Ids of a word by a heap of neighbouring pairs: O(n log n). Not whole: those before the last merge, if the word is a piece."""
    if not whole:
        ranks = ChainMap({word: None}, ranks) if len(word) > 1 else ranks
    elif word in ranks:
        return [ranks[word]]
    n = len(word)
    end, nxt, prev, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if not alive[i] or nxt[i] != j or j >= n or not alive[j] or end[j] != e or end[i] != j:
            continue
        alive[j], end[i], nxt[i] = False, e, nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (r := ranks.get(word[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, nxt[i], end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i] : e])) is not None:
            heapq.heappush(heap, (r, prev[i], i, e))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


#: Parts that the pattern surely takes as one word: letters of Latin blocks, whose classes all Unicode versions agree on.
LETTERS = " ?[A-Za-z\\x{C0}-\\x{D6}\\x{D8}-\\x{F6}\\x{F8}-\\x{24F}]+"
#: And that it takes as two: marks follow.
MARKS = ",.;:!?"


class Splitter:
    """Words (matches of the pattern) of texts, by the distinct parts of a batch."""

    def __init__(self):
        self.find = regex.compile(BYTE_PATTERN).findall

    def parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """bounds, index of each part in the vocabulary, and the distinct parts; all but a text's first begin with their space."""
        import pyarrow.compute as pc

        texts = whole(texts.cast(pa.large_string()).fill_null(""))
        if len(texts) == 0:
            return np.zeros(1, np.int64), np.zeros(0, np.int64), []
        loose = pc.match_substring_regex(texts, LOOSE).to_numpy(zero_copy_only=False)
        if loose.any():
            cut = [(SPLIT.split(t) if odd else t.split(" ")) for t, odd in zip(texts.to_pylist(), loose)]
            bounds, words = np.concatenate([[0], np.cumsum([len(c) for c in cut])]), pa.array([w for c in cut for w in c], pa.large_string())
        else:
            cut = pc.split_pattern(texts, " ")
            bounds = cut.offsets.to_numpy().astype(np.int64)
            words, bounds = cut.values.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]
        coded = words.dictionary_encode()
        index, vocab = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        first = bounds[:-1]
        starts, place = np.unique(index[first], return_inverse=True)
        index = index.copy()
        index[first] = len(vocab) + place
        return bounds, index, [" " + v for v in vocab] + [vocab[k] for k in starts.tolist()]


    def words(self, parts: list[str]) -> tuple[np.ndarray, list[str]]:
        """How many words each part has, and the words."""
        import pyarrow.compute as pc

        column, found, find = pa.array(parts, pa.large_string()), [(p,) for p in parts], self.find
        plain, marked = (pc.match_substring_regex(column, f"^{LETTERS}{end}$").to_numpy(zero_copy_only=False) for end in ("", f"[{MARKS}]+"))
        for k in np.flatnonzero(marked).tolist():
            p = parts[k]
            w = p.rstrip(MARKS)
            found[k] = w, p[len(w) :]
        for k in np.flatnonzero(~(plain | marked)).tolist():
            found[k] = find(parts[k])
        return np.fromiter(map(len, found), np.int64, len(found)), [w for x in found for w in x]


def _count(flush: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, total = Splitter(), {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "c"])

    for batch in batches:
        _, index, vocab = split.parts(batch.column("text"))
        each, words = split.words(vocab)
        for w, c in zip(words, np.repeat(np.bincount(index, minlength=len(vocab)), each).tolist()):
            if c:
                total[w] = total.get(w, 0) + c
        if len(total) > flush:
            yield rows()
            total.clear()
    if total:
        yield rows()


PREFIX = 20


def _ranges(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of strings, and where each begins and ends."""
    words = whole(words.cast(pa.large_string()))
    cut = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8, int(cut[-1])) if cut[-1] else np.zeros(0, np.uint8)
    return data, cut[:-1], cut[1:]


class Head:
    """Ids of the frequent words by a 64-bit hash of the word, without the words: what is sent to the workers."""

    def __init__(self, coded: pa.Table):
        coded = coded.combine_chunks()
        words = coded["word"].chunk(0) if len(coded) else pa.array([], pa.string())
        ids = coded["ids"].chunk(0) if len(coded) else pa.array([], pa.list_(pa.int32()))
        h = hashes(*_ranges(words))
        order = np.argsort(h, kind="stable")
        at = ids.offsets.to_numpy().astype(np.int64) if len(ids) else np.zeros(1, np.int64)
        size = np.diff(at)[order]
        start = np.cumsum(size) - size
        gather = np.repeat(at[:-1][order] - start, size) + np.arange(int(size.sum()))
        self.hash, self.size, self.start = h[order], size.astype(np.uint8), start.astype(np.int32)  # a word has at most LONG_BYTES ids
        self.ids = ids.values.to_numpy().astype(np.int32)[gather] if len(ids) else np.zeros(0, np.int32)
        self.first = np.searchsorted(self.hash >> np.uint64(64 - PREFIX), np.arange((1 << PREFIX) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word, or -1."""
        h = hashes(*_ranges(words))
        prefix = (h >> np.uint64(64 - PREFIX)).astype(np.int64)
        at, stop, out = self.first[prefix].astype(np.int64), self.first[prefix + 1], np.full(len(h), -1, np.int64)
        left = np.flatnonzero(at < stop)
        while len(left):
            same = self.hash[at[left]] == h[left]
            out[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out


def _lookup(head, path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each text as int32, with -1 - k for the k-th of its words that the head lacks."""
    import pyarrow.compute as pc

    split, ranks, head = Splitter(), read_ranks(path), head.value
    head_flat = head.ids
    for batch in batches:
        bounds, index, vocab = split.parts(batch.column("text"))
        part_words, flat_words = split.words(vocab)
        coded = pa.array(flat_words, pa.string()).dictionary_encode()
        del flat_words
        word_of, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        at = head.find(words)
        rare = at < 0
        at = np.maximum(at, 0)
        size = np.where(rare, 1, head.size[at] if len(head.size) else 1).astype(np.int64)
        start = np.where(rare, len(head_flat), head.start[at] if len(head.size) else 0)
        long_ids, n = [np.array([-1], np.int32)], len(head_flat) + 1
        for k in np.flatnonzero(rare & (pc.binary_length(words).to_numpy() > LONG_BYTES)).tolist():
            ids = np.array(merge_long(words[k].as_py().encode(), ranks), np.int32)
            rare[k], start[k], size[k] = False, n, len(ids)
            long_ids.append(ids)
            n += len(ids)
        extra = np.concatenate(long_ids)
        # a text's parts, their words, their ids
        first = np.cumsum(part_words) - part_words
        each = part_words[index]
        ends = np.cumsum(each)
        text_words = word_of[np.repeat(first[index] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)]
        word_bounds = np.concatenate([[0], ends])[bounds]
        each = size[text_words]
        ends = np.cumsum(each)
        place = np.repeat(start[text_words] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)
        own = place >= len(head_flat)
        ids = head_flat[np.where(own, 0, place)] if len(head_flat) else np.empty(len(place), np.int32)
        ids[own] = extra[place[own] - len(head_flat)]
        id_bounds = np.concatenate([[0], ends])[word_bounds]
        here = np.flatnonzero(rare[text_words])
        doc = np.searchsorted(word_bounds, here, side="right") - 1
        pair, number = np.unique(doc * max(len(words), 1) + text_words[here], return_inverse=True)
        doc_first = np.searchsorted(pair, np.arange(len(bounds)) * max(len(words), 1))
        ids[np.flatnonzero(ids == -1)] = -1 - (number - doc_first[doc])
        rare_words = pa.ListArray.from_arrays(pa.array(doc_first.astype(np.int32)), words.take(pa.array(pair % max(len(words), 1))))
        data, ids = memoryview(ids.astype("<i4").tobytes()), id_bounds.tolist()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([bytes(data[4 * a : 4 * b]) for a, b in zip(ids, ids[1:])], pa.binary()), rare_words], names=["doc_id", "coded", "rare"])


def _filled(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Ids of each text, with those of its rare words in their places."""
    for coded, rare in zip(batch.column("coded"), batch.column("rare_ids")):
        ids = np.frombuffer(coded.as_py(), "<i4")
        rare = rare.values if rare.is_valid else None
        if rare is not None and len(rare):
            words = [np.array(x.as_py(), "<i4") for x in rare]
            hole = np.flatnonzero(ids < 0)
            grown, last = [], 0
            for h, k in zip(hole.tolist(), (-1 - ids[hole]).tolist()):
                grown += [ids[last:h], words[k]]
                last = h + 1
            ids = np.concatenate([*grown, ids[last:]])
        yield ids.astype("<u4")


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in _filled(batch)], pa.binary())], names=["doc_id", "ids"])


def _digests(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = _pieces(path)
    for batch in batches:
        rows = [(len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256(decode_ids(x.astype(np.int64), *pieces).tobytes()).hexdigest()) for x in _filled(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _coded(docs: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, coded (ids with holes for rare words) and the ids of these words."""
    spark = docs.sparkSession
    prepare(spark)
    ranks = read_ranks(rank_file)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = rows.select("text").mapInArrow(lambda b: tidied(_count(200_000, b)), "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    usual, path = stored(counts.filter((F.octet_length("word") <= LONG_BYTES) & (F.col("c") > 1)), "words")
    coded = most_frequent(usual, HEAD_WORDS).select("word", encode_words("array(word)", ranks)[0].alias("ids")).toArrow()
    drop(spark, path)
    table = spark.sparkContext.broadcast(Head(coded))
    del coded
    found = rows.mapInArrow(lambda b: tidied(_lookup(table, rank_file, b)), "doc_id long, coded binary, rare array<string>")
    return found.select("doc_id", "coded", encode_words("rare", ranks).alias("rare_ids"))


def encode(docs: DataFrame, rank_file: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of each whole text, as the ranks' library encodes it.

    Null and empty texts: no ids. Repeated rows stay. Further columns are ignored. No special tokens.
    """
    return _coded(docs, rank_file).mapInArrow(_fill, "doc_id long, ids binary")


def decode_ids(ids: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of ids, joined; data holds all pieces, start and size say where."""
    each = size[ids]
    ends = np.cumsum(each)
    return data[np.repeat(start[ids] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)]


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ranks = read_ranks(path)
    by_id = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        by_id[rank] = piece
    size = np.array([len(p) for p in by_id], np.int64)
    return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum(size) - size, size


def _decode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = _pieces(path)
    for batch in batches:
        data = [decode_ids(np.frombuffer(x, "<u4").astype(np.int64), *pieces).tobytes() for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(data, pa.binary())], names=["doc_id", "ids", "decoded"])


def decode(coded: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, ids and the bytes that they stand for (decoded)."""
    prepare(coded.sparkSession)
    return coded.select("doc_id", "ids").mapInArrow(lambda b: _decode(rank_file, b), "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text."""
    return _coded(docs, rank_file).mapInArrow(lambda b: tidied(_digests(rank_file, b)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
