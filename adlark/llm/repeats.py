"""Removal of long repeated passages by prefix-free parsing and suffix arrays (operator 2).

A byte is removed if it is covered by a string of MIN bytes that also starts somewhere else, in this or another
document. Two steps find all starts of such strings.

Parsing, over all documents. A rolling hash of eight bytes picks a trigger for each start: the position of least hash among the
span(MIN) starts from there on, the last of several. It depends only on bytes within the string, so equal strings have
their triggers at equal places. Starts of one trigger are neighbours; they form a phrase, known by the hash of the bytes
that all their strings have behind the trigger (the seed) and that of all bytes of their strings (the long hash).
Phrases whose seed occurs once repeat nowhere. Phrases whose long hash occurs again repeat as a whole. What is left are the
edges of repeats: phrases that share a seed with different ones.

Suffix sorting, for the edges. Their bytes meet in blocks of seeds. A block is parsed again into a dictionary of
prefix-free phrases that end at triggers, and a parse. The suffix array of the dictionary and that of the parse give the order
of all suffixes of the block: by the dictionary suffix up to the next trigger, then by the rank of the parse from there
on. A string repeats exactly if a neighbour in that order shares its MIN bytes. A seed with more than HOT different phrases
would make a block too large; each of its phrases is cut by the distance of its starts from the trigger, and a piece's seed is
what all strings of its distances have in common, which is more. Pieces that occur again, or alone, are settled; seeds that are still
too large are cut anew, to a quarter, down to strings of one start, whose seed and long hash are a name of 128 bits.

Passages of a number of words, whatever their bytes, are found in the same way and by the same jobs: a text becomes a string of
words, each known by a hash of 64 bits, and a symbol of a string is a word where it is a byte above. `item` is the bytes of a
symbol, 1 or WORD; lengths and places count symbols. A search is an item and a length; seeds of different searches differ.

Equality of phrases and their pieces as wholes is that of polynomial hashes modulo 2**64; strings made to defeat these
(Thue-Morse words of thousands of symbols) are out of scope.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import drop, frugal, prepare, stored, tasks

MIN = 400
GRAM = 8
WORD = 8
#: Words of the shortest passage that counts by its words.
PASSAGE = 51
HOT = 2048
BLOCK_ROWS = 1_000
#: Rows whose numbers differ in their last NEAR bits only give their runs together.
NEAR = 8
BUFFER = 1 << 20
_POS = np.uint64((1 << 24) - 1)
_MAP = np.random.default_rng(3).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
#: Bytes between words, and what each byte counts as in a word: A to Z as a to z.
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of a text, and the byte behind it."""
    edge = np.flatnonzero(np.diff(_WHITE[buf], prepend=True, append=True))
    return edge[::2], edge[1::2]


def coded(text: bytes) -> bytes:
    """A text as a string of WORD bytes for each of its words, a hash of it."""
    buf = np.frombuffer(text, np.uint8)
    start, end = word_spans(buf)
    if not len(start):
        return b""
    h = Hashes(_LOWER[buf]).of(start, end) ^ (end - start).astype(np.uint64) * np.uint64(_BASE[1])
    return h.astype("<u8").tobytes()


def symbols(data: bytes, item: int) -> np.ndarray:
    """Bytes, or hashes of words, of a string."""
    return np.frombuffer(data, np.uint8 if item == 1 else "<u8")


def span(length: int) -> int:
    """Starts among which a trigger is chosen for strings of `length` symbols; the rest of a string is its seed.

    A wide span makes fewer phrases; short strings, those of words, have telling seeds even so.
    """
    return length // 2 if length >= 100 else 2 * length // 3


class Hashes:
    """Polynomial hashes modulo 2**64 of any range of a buffer, from prefix sums; bytes count as random numbers, hashes of words as they are."""

    def __init__(self, buf: np.ndarray, which: int = 0):
        base = _BASE[which]
        n = len(buf)
        power = np.ones(n + 1, np.uint64)
        done = 1
        while done < n + 1:  # powers by doubling
            k = min(done, n + 1 - done)
            power[done : done + k] = power[:k] * np.uint64(pow(base, done, 1 << 64))
            done += k
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_MAP[which][buf] if buf.dtype == np.uint8 else buf * _MAP[which][0]) * power[:n], out=self.sums[1:])
        self.inverse = self._powers(n + 1, pow(base, -1, 1 << 64))

    @staticmethod
    def _powers(n: int, base: int) -> np.ndarray:
        power, done = np.ones(n, np.uint64), 1
        while done < n:
            k = min(done, n - done)
            power[done : done + k] = power[:k] * np.uint64(pow(base, done, 1 << 64))
            done += k
        return power

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def grams(buf: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position of a buffer on (the last ones are read as if zeros followed), or of the word there."""
    n = len(buf)
    if buf.dtype != np.uint8:
        out = buf * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out
    wide = np.concatenate([buf, np.zeros(16 + -n % 8, np.uint8)])
    out = np.empty(n + -n % 8, np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(wide[k:].tobytes()[: len(out)], "<u8")
    out = out[:n] * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def phrases(buf: np.ndarray, size: np.ndarray, length: int = MIN) -> tuple[np.ndarray, ...]:
    """Phrases of texts that lie one after another in a buffer: text, first and last start, trigger (places in the buffer)."""
    starts = np.maximum(size - length + 1, 0)
    if not starts.sum() or len(buf) > int(_POS):
        if len(buf) > int(_POS):
            raise ValueError("a buffer has 2**24 symbols at most")
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    base = np.cumsum(size) - size
    key = (grams(buf) & ~_POS) | (_POS - np.arange(len(buf), dtype=np.uint64))
    width = 1
    while width < span(length):  # least key of windows twice as wide, up to the span
        step = min(width, span(length) - width)
        key = np.minimum(key[:-step], key[step:])
        width += step
    text = np.repeat(np.arange(len(size)), starts)
    at = np.arange(int(starts.sum())) + np.repeat(base - (np.cumsum(starts) - starts), starts)
    trigger = (_POS - (key[at] & _POS)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[new[1:], len(at)] - 1
    return text[new], at[new], at[last], trigger[new]


def _batches(texts: list[np.ndarray], length: int, item: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts have BUFFER bytes together, or one longer text in overlapping parts: first row, offset in it, symbols, sizes."""
    a, held, most = 0, 0, BUFFER // item
    for i, t in enumerate([*texts, None]):
        if t is None or held + len(t) > most:
            if i > a:
                yield a, 0, np.concatenate(texts[a:i]), np.array([len(x) for x in texts[a:i]], np.int64)
            a, held = i, 0
        if t is not None and len(t) > most:
            for k in range(0, len(t), most - length):  # neighbours share length - 1 symbols, so each start is in one part
                part = t[k : k + most - 1]
                yield i, k, part, np.array([len(part)], np.int64)
                if k + most - 1 >= len(t):
                    break
            a, held = i + 1, 0
        elif t is not None:
            held += len(t)


def _salt(item: int, length: int) -> np.uint64:
    return np.uint64((item * 0x9E3779B97F4A7C15 + length * 0xD1342543DE82EF95) & (1 << 64) - 1)


def _coded_all(raw: list[bytes]) -> list[np.ndarray]:
    """Words of texts, hashed over all texts at once, but for long ones."""
    out: list[np.ndarray | None] = [symbols(coded(t), WORD) if len(t) > BUFFER else None for t in raw]
    a, held = 0, 0
    for i, t in enumerate([*raw, None]):
        if t is None or len(t) > BUFFER or held + len(t) > BUFFER:
            part = [k for k in range(a, i) if out[k] is None]
            if part:  # texts joined by a blank, which ends their last words
                size = np.array([len(raw[k]) for k in part], np.int64)
                buf = np.frombuffer(b" ".join(raw[k] for k in part), np.uint8)
                start, _ = word_spans(buf)
                flat = symbols(coded(buf.tobytes()), WORD)
                cut = np.searchsorted(start, np.cumsum(size + 1) - (size + 1))
                for k, x in zip(part, np.split(flat, cut[1:])):
                    out[k] = x
            a, held = i, 0
        held += len(t or b"")
    return out


def _parse(searches: tuple[tuple[int, int], ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        raw = [b or b"" for b in batch.column("text").cast(pa.large_binary()).to_pylist()]
        uids = batch.column("uid").to_numpy()
        for item, length in searches:
            texts = _coded_all(raw) if item == WORD else [symbols(b, 1) for b in raw]
            for row, skip, buf, size in _batches(texts, length, item):
                text, lo, hi, trigger = phrases(buf, size, length)
                if not len(text):
                    continue
                h = Hashes(buf)
                seed = h.of(trigger, trigger + length - span(length) + 1) ^ _salt(item, length)
                base = (np.cumsum(size) - size)[text]
                long = h.of(lo, hi + length)
                # occurrences of a phrase in these texts travel as one row
                order = np.lexsort((long, seed))
                kind = np.flatnonzero(np.r_[True, (np.diff(seed[order]) != 0) | (np.diff(long[order]) != 0)])
                inside = np.arange(len(order)) - np.repeat(kind, np.diff(np.append(kind, len(order))))
                new = np.flatnonzero(inside % 16 == 0)  # 16 of them at most
                cut, first = pa.array(np.append(new, len(order)).astype(np.int32)), order[new]
                occurs = pa.StructArray.from_arrays([pa.array(uids[row + text[order]]), pa.array((lo - base + skip)[order]), pa.array((hi - lo + 1)[order].astype(np.int32))], names=["uid", "lo", "n"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(seed[first].view(np.int64)), pa.array(long[first].view(np.int64)), pa.array(np.diff(np.append(new, len(order)))),
                    pa.array(np.full(len(new), item, np.int8)), pa.ListArray.from_arrays(cut, occurs),
                ], names=["seed", "long", "m", "item", "at"])


# ---------------------------------------------------------------- suffix arrays of a block


def _first_like(key: np.ndarray) -> np.ndarray:
    """For each of some sorted keys, the place of the first of its kind."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return np.repeat(first, np.diff(np.append(first, len(key))))


def ranks(symbols: np.ndarray, left: np.ndarray, limit: int) -> np.ndarray:
    """Rank of the suffix from each position on among all, by prefix doubling; left: symbols to the end of its string, itself included.

    The rank is the number of lesser ones. As many symbols as fit in 63 bits come first; later rounds sort only suffixes that are still tied.
    """
    n = len(symbols)
    bits = (int(symbols.max(initial=0)) + 1).bit_length()
    width, key = min(max(1, 63 // bits), max(1, limit)), np.zeros(n, np.int64)
    for k in range(width):
        go = slice(0, n - k) if k < n else slice(0, 0)
        key <<= bits
        key[go] |= np.where(left[go] > k, symbols[k:] + 1, 0)
    tied, rank = np.argsort(key), np.empty(n, np.int64)  # tied: in the order of ranks
    rank[tied] = _first_like(key[tied])
    while width < limit:
        now = rank[tied]
        same = now[1:] == now[:-1]
        many = np.r_[False, same] | np.r_[same, False] if len(now) else np.zeros(0, bool)
        tied, now = tied[many], now[many]
        if not len(tied):
            break
        after = np.where(left[tied] > width, rank[np.minimum(tied + width, n - 1)] + 1, 0)
        key = now * (n + 2) + after
        order = np.argsort(key)
        tied, key, now = tied[order], key[order], now[order]
        rank[tied] = now + _first_like(key) - _first_like(now)  # behind the lesser ones of the same rank
        width *= 2
    return rank


def kinds(*names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of things with several names, one of each kind, and the kind of each. The first name tells nearly all kinds apart."""
    order = np.argsort(names[0], kind="stable")
    same = [x[order[1:]] == x[order[:-1]] for x in names]
    if (same[0] & ~np.logical_and.reduce(same)).any():
        order = np.lexsort(names[::-1])
        same = [x[order[1:]] == x[order[:-1]] for x in names]
    new = np.r_[True, ~np.logical_and.reduce(same)][: len(order)]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def corpus_order(texts: list[bytes], places: np.ndarray, rate: int = 4, item: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places (positions in the joined texts) in the order of their suffixes, by prefix-free parsing, and the joined symbols.

    Texts end with a symbol below all others. A trigger is a gram (GRAM bytes or a word) whose hash has `rate` zero bits at
    the end. Words are ordered by their hashes.
    """
    size = np.array([len(t) // item for t in texts], np.int64)
    buf, gram = symbols(b"".join(texts), item), GRAM if item == 1 else 1
    number = buf if item == 1 else np.unique(buf, return_inverse=True)[1]
    end = np.cumsum(size)
    text_end = np.repeat(end, size)
    pos = np.arange(len(buf))
    trigger = ((grams(buf) >> np.uint64(40)) & np.uint64((1 << rate) - 1) == 0) & (pos + gram <= text_end)
    first = np.zeros(len(buf), bool)
    first[(end - size)[size > 0]] = True
    begin = np.flatnonzero(trigger | first)
    after = np.r_[begin[1:], len(buf)]
    stop = np.minimum(after + gram, text_end[begin])  # a phrase ends with the next trigger's gram
    closing = after >= text_end[begin]
    stop = np.where(closing, text_end[begin], stop)
    # dictionary: distinct phrases, by two hashes and length; the last of a text has the end symbol too
    h = Hashes(buf)
    example, phrase = kinds(h.of(begin, stop), Hashes(buf, 1).of(begin, stop), 2 * (stop - begin) + closing)
    length = (stop - begin + closing)[example]
    start = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(start, length)
    symbol = number[np.minimum(np.repeat(begin[example], length) + inside, len(buf) - 1)].astype(np.int64) + 1
    symbol[(start + length - 1)[closing[example]]] = 0
    dictionary = ranks(symbol, np.repeat(length, length) - inside, int(length.max(initial=1)))
    # parse: ranks of phrases; suffixes of the parse end with their text
    whole = dictionary[start][phrase]
    per_text = np.add.reduceat(np.ones(len(begin), np.int64), np.flatnonzero(first[begin])) if len(begin) else np.zeros(0, np.int64)
    left = np.concatenate([np.arange(n, 0, -1) for n in per_text]) if len(per_text) else np.zeros(0, np.int64)
    parse = ranks(whole, left, int(left.max(initial=1)))
    p = np.searchsorted(begin, places, side="right") - 1
    alpha = dictionary[start[phrase[p]] + places - begin[p]]
    rest = np.where(closing[p], -1, parse[np.minimum(p + 1, len(parse) - 1)])
    return np.lexsort((rest, alpha)), buf


def repeated(texts: list[bytes], starts: list[int], weight: list[int], length: int = MIN, item: int = 1) -> list[np.ndarray]:
    """Which of the first starts[k] starts of text k begin a string of `length` symbols that occurs elsewhere as well.

    A text of weight 2 or more occurs so often itself. Each start has `length` symbols of its text.
    """
    count = np.array(starts, np.int64)
    size = np.array([len(t) // item for t in texts], np.int64)
    base = np.cumsum(size) - size
    places = np.arange(int(count.sum())) + np.repeat(base - (np.cumsum(count) - count), count)
    out = np.repeat(np.array(weight) > 1, count)
    if len(places):
        order, buf = corpus_order(texts, places, item=item)
        i = np.arange(1, len(order))
        a, b = places[order[i - 1]], places[order[i]]
        h = Hashes(buf)
        like = h.of(a, a + length) == h.of(b, b + length)
        i, a, b = i[like], a[like], b[like]
        view = np.lib.stride_tricks.sliding_window_view(buf, length)
        exact = np.concatenate([(view[a[k : k + 20000]] == view[b[k : k + 20000]]).all(axis=1) for k in range(0, len(a), 20000)]) if len(a) else np.zeros(0, bool)
        out[order[i[exact]]] = out[order[i[exact] - 1]] = True
    return np.split(out, np.cumsum(count)[:-1]) if len(count) else []


def _sort_block(lengths: dict[int, int], block: pd.DataFrame) -> pd.DataFrame:
    frugal()
    block, item = block.sort_values(["seed", "long"]), int(block["item"].iloc[0])
    n, once = block["n"].to_numpy(), block["m"].to_numpy() == 1
    found = repeated(block["bytes"].tolist(), n.tolist(), block["m"].tolist(), lengths[item], item)
    row = np.repeat(np.arange(len(n)), n)
    flag = np.concatenate(found) & once[row]
    step = np.r_[True, row[1:] != row[:-1]]  # runs end with their row
    first = np.flatnonzero(flag & (step | ~np.r_[False, flag[:-1]]))
    last = np.flatnonzero(flag & np.r_[step[1:] | ~flag[1:], True])
    at = block["lo"].to_numpy() - (np.cumsum(n) - n)
    of = row[first]
    return pd.DataFrame({"uid": block["uid"].to_numpy()[of], "first": first + at[of], "last": last + at[of], "item": np.full(len(of), item, np.int8)})


def _cut(lengths: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The symbols of each listed phrase of a text."""
    frugal()
    kinds = {"n": pa.int32(), "bytes": pa.binary(), "hot": pa.bool_(), "item": pa.int8()}
    for batch in batches:
        for text, rows in zip(batch.column("text").cast(pa.large_binary()), batch.column("rows").to_pylist()):
            if rows:
                data = {1: text.as_py()}
                if any(r["item"] == WORD for r in rows):
                    data[WORD] = coded(data[1])
                cols = {k: [r[k] for r in rows] for k in rows[0]}
                cols["bytes"] = [data[r["item"]][r["lo"] * r["item"] : (r["lo"] + r["n"] + lengths[r["item"]] - 1) * r["item"]] for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(cols[k], kinds.get(k, pa.int64())) for k in cols], names=list(cols))


def _finer(lengths: dict[int, int], widths: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases cut by the distance of their starts from the trigger, at multiples of a width; equal strings get into equal cuts."""
    frugal()
    for whole in batches:
        for (item, length), width in zip(lengths.items(), widths.values()):
            batch = whole.filter(pa.array(whole.column("item").to_numpy() == item))
            texts = batch.column("bytes").to_pylist()
            for k in range(0, len(texts), 2000):
                part = texts[k : k + 2000]
                data = b"".join(part)
                buf = symbols(data, item)
                text, lo, hi, trigger = phrases(buf, np.array([len(t) // item for t in part], np.int64), length)
                low = (trigger - hi) // width
                count = (trigger - lo) // width - low + 1
                row = np.repeat(np.arange(len(text)), count)
                near = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]) * width  # least distance of a cut
                first, last = np.maximum(trigger[row] - near - width + 1, lo[row]), np.minimum(trigger[row] - near, hi[row])
                common = trigger[row] - near
                seed = Hashes(buf).of(common, common - width + 1 + length) ^ _salt(item, length) ^ (near + 1).astype(np.uint64) * np.uint64(_BASE[1])
                col = lambda c: batch.column(c).to_numpy()[k : k + 2000][text[row]]
                cuts = [data[x * item : (y + length) * item] for x, y in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(seed.view(np.int64)), pa.array(Hashes(buf, 1).of(first, last + length).view(np.int64)), pa.array(col("m")), pa.array(col("uid")), pa.array(col("lo") + first - lo[row]),
                    pa.array((last - first + 1).astype(np.int32)), pa.array(np.full(len(row), item, np.int8)), pa.array(cuts, pa.binary()),
                ], names=["seed", "long", "m", "uid", "lo", "n", "item", "bytes"])


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the occurrences of phrases; neighbours in a text become one."""
    frugal()
    for batch in batches:
        at = batch.column("at")
        uid, lo, n = (x.to_numpy() for x in at.flatten().flatten())
        if not len(uid):
            continue
        item = np.repeat(batch.column("item").to_numpy(), at.value_lengths().to_numpy())
        order = np.lexsort((lo, uid, item))
        item, uid, lo, last = item[order], uid[order], lo[order], (lo + n - 1)[order]
        new = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (uid[1:] != uid[:-1]) | (lo[1:] != last[:-1] + 1)])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (uid[new], lo[new], last[np.r_[new[1:], len(uid)] - 1], item[new])], names=["uid", "first", "last", "item"])


# ---------------------------------------------------------------- operator


def repeat_starts(rows: DataFrame, length: int | None = MIN, words: int | None = None) -> DataFrame:
    """Runs item, uid, first, last of starts of strings that start elsewhere too; rows: uid, text, a stored table.

    Item 1: strings of `length` bytes, places in bytes. Item WORD: passages of so many words, places in words.
    """
    spark = rows.sparkSession
    prepare(spark)
    searches = (*([(1, length)] if length else []), *([(WORD, words)] if words else []))
    lengths = dict(searches)
    schema = "seed long, long long, m long, item byte, at array<struct<uid: bigint, lo: bigint, n: int>>"
    every, every_path = stored(rows.mapInArrow(lambda b: _parse(searches, b), schema), "phrases")
    # tables of their own, so that joins deal both sides anew and a seed with very many phrases can be split
    twice, twice_path = stored(every.groupBy("seed").agg(F.sum("m").alias("c")).filter("c > 1").select("seed"), "twice")
    groups, groups_path = stored(every.join(twice, "seed"), "groups")
    one = F.struct(F.col("at")[0]["uid"].alias("uid"), F.col("at")[0]["lo"].alias("lo"), F.col("at")[0]["n"].alias("n"), "item")
    kinds, kinds_path = stored(groups.groupBy("seed", "long").agg(F.sum("m").alias("m"), F.min(one).alias("one")), "kinds")
    # occurrences of neighbouring texts meet, so that runs leave and not phrases: copies of a long passage have many of these
    often = groups.join(kinds.filter("m > 1").select("seed", "long"), ["seed", "long"]).select("item", "at", F.shiftright(F.col("at")[0]["uid"], NEAR).alias("near"))
    whole = often.repartition(tasks(spark), "near").sortWithinPartitions("near").select("item", "at").mapInArrow(_runs_of, "uid long, first long, last long, item byte")
    mixed, mixed_path = stored(kinds.groupBy("seed").agg(F.count("*").alias("k"), F.min("m").alias("least")).filter("k > 1 and least = 1").select("seed", (F.col("k") > HOT).alias("hot")), "mixed")
    edges = kinds.join(mixed, "seed").select("seed", "long", "m", "one.uid", "one.lo", "one.n", "one.item", "hot")
    by_text = edges.groupBy("uid").agg(F.collect_list(F.struct("seed", "long", "m", "uid", "lo", "n", "item", "hot")).alias("rows"))  # phrases of one text
    cut = rows.join(by_text, "uid").select("text", "rows").mapInArrow(lambda b: _cut(lengths, b), "seed long, long long, m long, uid long, lo long, n int, item byte, hot boolean, bytes binary")
    pieces, pieces_path = stored(cut, "edges")
    found, ready, paths, level = whole, [pieces], [pieces_path], 0
    size = lambda df: df.agg(F.count("*"), F.coalesce(F.sum(F.col("hot").cast("long")), F.lit(0))).first()
    n, hot = size(pieces)
    total = n - hot
    while hot:
        level += 1
        widths = {item: -(-span(length) // 4**level) for item, length in lengths.items()}
        last = max(widths.values()) == 1
        finer, finer_path = stored(ready[-1].filter("hot").mapInArrow(lambda b, w=widths: _finer(lengths, w, b), "seed long, long long, m long, uid long, lo long, n int, item byte, bytes binary"), "finer")
        kinds_, kinds_path_ = stored(finer.groupBy("seed", "long").agg(F.sum("m").alias("m"), F.first(F.struct("uid", "lo", "n", "item", "bytes")).alias("one")), "finer-kinds")
        again = finer.filter("m = 1").join(kinds_.filter("m > 1").select("seed", "long"), ["seed", "long"])  # phrases of more occurrences have gone already
        found = found.unionByName(again.select("uid", F.col("lo").alias("first"), (F.col("lo") + F.col("n") - 1).alias("last"), "item"))
        mixed_ = kinds_.groupBy("seed").agg(F.count("*").alias("k"), F.min("m").alias("least")).filter("k > 1 and least = 1").select("seed", ((F.col("k") > HOT) & F.lit(not last)).alias("hot"))
        rest, rest_path = stored(kinds_.join(mixed_, "seed").select("seed", "long", "m", "one.*", "hot"), "finer-edges")
        n, hot = size(rest)
        total += n - hot
        ready.append(rest)
        paths += [finer_path, kinds_path_, rest_path]
    blocks = max(1, -(-total // BLOCK_ROWS))
    columns = ("seed", "long", "m", "uid", "lo", "n", "item", "bytes")
    edges_ = functools.reduce(DataFrame.unionByName, (df.filter("not hot").select(*columns) for df in ready))
    sorted_ = edges_.withColumn("block", F.pmod(F.xxhash64("seed"), F.lit(blocks))).repartition(min(2 * blocks, tasks(spark)), "item", "block").groupBy("item", "block").applyInPandas(lambda b: _sort_block(lengths, b), "uid long, first long, last long, item byte")
    out, _ = stored(found.unionByName(sorted_), "starts")
    drop(spark, every_path, twice_path, groups_path, kinds_path, mixed_path, *paths)
    return out


def _passages(text: bytes, runs: list[tuple[int, int]], words: int) -> list[tuple[int, int]]:
    """Ranges of bytes of the passages at these runs of words, from the first word's first byte to the last one's last."""
    start, end = word_spans(np.frombuffer(text, np.uint8))
    return [(int(start[a]), int(end[b + words - 1])) for a, b in runs]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def spans_of(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges of bytes that strings of MIN bytes at these runs of starts cover."""
    return _merged([(a, b + MIN) for a, b in runs])


INNER = ("_text", "_runs", "_words")
NUMBERS = ("_n_bytes", "_n_removed", "_n_spans", "_n_passages")


def _remove(digest: bool, words: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their repeats, or digests of them; passages of words go too, but with digests they are counted only."""
    frugal()
    for batch in batches:
        texts, runs = batch.column("_text").cast(pa.large_binary()).to_pylist(), batch.column("_runs").to_pylist()
        more = batch.column("_words").to_pylist() if words else [None] * len(texts)
        out, sizes, gone, spans, passages = [], [], [], [], []
        for t, r, w in zip(texts, runs, more):
            cut = spans_of([(x["first"], x["last"]) for x in r]) if r else []
            long = _merged(_passages(t, [(x["first"], x["last"]) for x in w], words)) if w else []
            if long and not digest:
                cut = _merged([*cut, *long])
            kept, at = [], 0
            for a, b in cut:
                kept.append(t[at:a])
                at = b
            kept = b"".join([*kept, t[at:]]) if cut else t
            out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "ignore"))
            sizes.append(len(t))
            gone.append(len(t) - len(kept))
            spans.append(len(cut))
            passages.append(len(long))
        names = [c for c in batch.schema.names if c not in INNER]
        rest = [batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.string()), *(pa.array(x, pa.int64()) for x in (sizes, gone, spans, passages))], names=[*names, "_out", *NUMBERS])


def _joined(docs: DataFrame, words: int | None = None) -> DataFrame:
    """All columns of docs but text under numbered names, with _text, _runs and, given a number of words, _words.

    The rows are numbered in a stored table, so that every later read sees the same numbers.
    """
    rest = [docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(docs.columns) if c != "text"]
    numbered, _ = stored(docs.select(*rest, F.coalesce(docs["text"].cast("string"), F.lit("")).alias("_text"), F.monotonically_increasing_id().alias("uid")), "numbered", "snappy")
    rows = numbered.select("uid", F.col("_text").alias("text"))
    run = F.struct("first", "last")
    of = lambda item: F.collect_list(F.when(F.col("item") == item, run))
    by_text = repeat_starts(rows, MIN, words).groupBy("uid").agg(of(1).alias("_runs"), *([of(WORD).alias("_words")] if words else []))
    return numbered.join(by_text, "uid", "left").drop("uid")


def _schema(joined: DataFrame) -> str:
    rest = "".join(f"{n} {t}, " for n, t in joined.dtypes if n not in INNER)
    return f"{rest}_out string, " + ", ".join(f"{n} long" for n in NUMBERS)


def removed(docs: DataFrame, words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row; rows keep their order of ids nowhere.

    Null and empty texts and those of fewer than MIN bytes lose nothing. Equal rows lose all that repeats, both alike.
    Given a number of words, n_passages counts a text's maximal passages, of so many words or more, made of such that start
    elsewhere too, whatever their bytes; they are named, not removed, unless strings of MIN bytes cover them.
    """
    joined = _joined(docs.select("doc_id", "text"), words)
    out = joined.mapInArrow(lambda b: _remove(True, words, b), _schema(joined))
    more = [F.col("_n_passages").alias("n_passages")] if words else []
    return out.select(F.col("c0").alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_out").alias("kept_sha256"), *more)


def without_repeats(docs: DataFrame, words: int | None = None) -> DataFrame:
    """All rows and columns of docs; texts lose their repeats. A character that is cut through goes whole. n_chars follows.

    Every occurrence of a repeat goes, so none of it is left. Given a number of words, passages of so many words or more that
    repeat go too, whatever their bytes; words are those between ASCII white space, and A to Z count as a to z.
    """
    joined = _joined(docs, words)
    out = joined.mapInArrow(lambda b: _remove(False, words, b), _schema(joined))
    cols = []
    for k, c in enumerate(docs.columns):
        if c == "text":
            cols.append(F.col("_out").alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.col("_n_removed") > 0, F.length("_out").cast("long")).otherwise(F.col(f"c{k}").cast("long")).alias(c))
        else:
            cols.append(F.col(f"c{k}").alias(c))
    return out.select(*cols)
