"""FLAC in numpy: a decoder of whole streams, a fast path over many frames at once, and an encoder (operator 7).

`decode` reads any stream of the format: constant, verbatim, fixed and linear-prediction subframes, Rice partitions with
four- or five-bit parameters and escapes, wasted bits and the three ways of joining channels. It verifies CRC-8 of each
header, CRC-16 of each frame and the stream's MD5. `decode_frames` does the same for mono frames with one Rice partition, as
the encoder here writes them, all frames of a batch side by side: sample i of every frame is decoded in one numpy step.

The encoder takes for each frame the best of the fixed predictors up to order 2 and a linear predictor of order 3, whose coefficients
come from the frame's autocorrelation. Decoded samples leave as PCM blocks that begin at known sample offsets.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import documents, prepare, tidied

BLOCK = 576
RATE = 8000
MAX_ORDER = 2
#: Linear predictors: coefficients, bits of each, and the shift of their sums. Their header (4 + 5 + 3 * 13 bits) fills whole bytes.
LPC, PRECISION, SHIFT = 3, 13, 10
LPC_BYTES = (9 + LPC * PRECISION) // 8
LPC_KIND = 32 + LPC - 1 << 1
PCM_BLOCK = 4096
#: Frames of a seek point, and the name of the metadata block that has the length of each frame in two bytes.
SEEK_FRAMES = 16
SIZES = b"adlk"
FIXED = ([], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1])


@lru_cache(maxsize=2)
def crc_table(bits: int) -> np.ndarray:
    """CRC-8 of polynomial 0x07 or CRC-16 of polynomial 0x8005, for each byte."""
    poly, top, mask = {8: 0x07, 16: 0x8005}[bits], 1 << bits - 1, (1 << bits) - 1
    out = np.zeros(256, np.uint16)
    for n in range(256):
        c = n << bits - 8
        for _ in range(8):
            c = (c << 1 ^ poly if c & top else c << 1) & mask
        out[n] = c
    return out


def crc(data: bytes, bits: int) -> int:
    t, c = crc_table(bits).tolist(), 0
    for b in data:
        c = t[c ^ b] if bits == 8 else (c << 8 & 0xFFFF) ^ t[c >> 8 ^ b]
    return c


def crc_many(buf: np.ndarray, start: np.ndarray, size: np.ndarray, bits: int) -> np.ndarray:
    """CRC of many ranges of a buffer, byte i of all ranges at a time."""
    t = crc_table(bits)
    order = np.argsort(-size, kind="stable")
    at, n = start[order], size[order]
    c = np.zeros(len(at), np.uint16)
    live = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")
    for i, k in enumerate(live):  # k ranges have a byte i
        b = buf[at[:k] + i]
        c[:k] = t[c[:k] ^ b] if bits == 8 else (c[:k] << 8) ^ t[(c[:k] >> 8) ^ b]
    out = np.empty_like(c)
    out[order] = c
    return out


def coded_number(n: int) -> bytes:
    """A frame number in the extended UTF-8 of frame headers."""
    if n < 0x80:
        return bytes([n])
    tail = []
    while n >= 1 << 6 - len(tail):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    return bytes([0xFF << 7 - len(tail) & 0xFF | n, *reversed(tail)]) if len(tail) < 6 else bytes([0xFE, *reversed(tail)])


# ---------------------------------------------------------------- encoder


def predictors(x: np.ndarray) -> np.ndarray:
    """Quantised linear predictors (frames x LPC) by the Levinson recursion on autocorrelations; every step is elementwise, so a
    frame's coefficients don't depend on its neighbours."""
    wide = x.astype(np.int32)
    r = [np.einsum("ij,ij->i", wide[:, : BLOCK - k], wide[:, k:], dtype=np.int64).astype(np.float64) for k in range(LPC + 1)]
    error, a = r[0] * (1 + 1e-9) + 1e-9, [np.zeros(len(x)) for _ in range(LPC)]
    for i in range(LPC):
        k = (r[i + 1] - sum((a[j] * r[i - j] for j in range(i)), np.zeros(len(x)))) / error
        a = [*(a[j] - k * a[i - 1 - j] for j in range(i)), k, *a[i + 1 :]]
        error = error * (1 - k * k) + 1e-9
    most = (1 << PRECISION - 1) - 1
    return np.stack([np.clip(np.rint(c * (1 << SHIFT)), -most, most) for c in a], axis=1).astype(np.int64)


def encode_frames(x: np.ndarray, number: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Mono 8-bit frames of 576 samples each (rows of x), and the byte offset of each in the result.

    Each takes the fixed or linear predictor of least absolute residual and the best Rice parameter near the residual's mean;
    a frame that this would not shorten is verbatim, an even one constant.
    """
    n = len(x)
    x = x.astype(np.int16)
    order, best, res = np.zeros(n, np.int64), None, x
    chosen = np.zeros((n, BLOCK), np.int32)
    for p in range(MAX_ORDER + 1):
        if p:
            res = np.diff(res, axis=1)
        total = np.abs(res[:, LPC - p :]).sum(axis=1, dtype=np.int64)
        take = np.ones(n, bool) if best is None else total < best
        best = total if best is None else np.minimum(best, total)
        order[take] = p
        chosen[take, p:] = res[take]
    coef, wide = predictors(x), x.astype(np.int32)
    guess = sum(coef[:, j, None].astype(np.int32) * wide[:, LPC - 1 - j : BLOCK - 1 - j] for j in range(LPC)) >> SHIFT
    res = wide[:, LPC:] - guess
    linear = np.abs(res).sum(axis=1, dtype=np.int64) + 2 * LPC_BYTES < best  # about what its header costs
    order[linear] = LPC
    chosen[linear, LPC:] = res[linear]
    u = (chosen << 1) ^ (chosen >> 31)
    skip = np.arange(BLOCK)[None, :] < order[:, None]
    u[skip] = 0
    used = BLOCK - order
    guess = np.floor(np.log2(np.maximum(u.sum(axis=1) / used, 1))).astype(np.int64)
    k, bits = None, None
    for near in (-1, 0, 1):
        this = np.clip(guess + near, 0, 14)
        size = (u >> this[:, None].astype(np.int32)).sum(axis=1) + used * (1 + this)
        better = np.ones(n, bool) if bits is None else size < bits
        k, bits = np.where(better, this, 0 if k is None else k), np.where(better, size, 0 if bits is None else bits)
    constant = (x == x[:, :1]).all(axis=1)
    extra = np.where(order == LPC, LPC_BYTES, 0)
    verbatim = ~constant & (8 * (order + extra) + 10 + bits >= 8 * BLOCK)
    rice = ~constant & ~verbatim
    order[~rice] = extra[~rice] = 0
    heads = [h + bytes([crc(h, 8)]) for h in (b"\xff\xf8\x24\x02" + coded_number(i) for i in number.tolist())]
    head = np.array([len(h) for h in heads], np.int64)
    body = np.where(constant, 16, np.where(verbatim, 8 + 8 * BLOCK, 18 + 8 * (order + extra) + bits))
    length = head + (body + 7) // 8 + 2
    start = np.cumsum(length) - length
    words = np.zeros((int(length.sum()) + 7) // 8 + 1, np.uint64)
    r = np.flatnonzero(rice)
    if len(r):
        kk, keep = k[r, None], ~skip[r]
        low = u[r].astype(np.int64)
        q = low >> kk
        size = np.where(keep, q + 1 + kk, 0)
        end = (np.cumsum(size, axis=1) + (8 * (start + head + 1 + order + extra) + 10)[r, None])[keep] - 1
        value = ((low & (1 << kk) - 1) | 1 << kk)[keep].astype(np.uint64)
        word, shift = end >> 6, (63 - (end & 63)).astype(np.uint64)
        edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words[word[edge]] = np.add.reduceat(value << shift, edge)
        over = np.flatnonzero(shift > 48)
        spill = value[over] >> (np.uint64(64) - shift[over])
        np.add.at(words, word[over] - 1, spill)
    out = np.frombuffer(words.byteswap().tobytes(), np.uint8)[: int(length.sum())].copy()
    place = np.repeat(start - (np.cumsum(head) - head), head) + np.arange(int(head.sum()))
    out[place] = np.frombuffer(b"".join(heads), np.uint8)
    sub = start + head
    out[sub] = np.where(constant, 0, np.where(verbatim, 2, np.where(order == LPC, LPC_KIND, 16 | order << 1)))
    raw = (x & 0xFF).astype(np.uint8)
    out[sub[constant] + 1] = raw[constant, 0]
    if verbatim.any():
        out[sub[verbatim][:, None] + 1 + np.arange(BLOCK)] = raw[verbatim]
    for j in range(LPC):
        warm = rice & (order > j)
        out[sub[warm] + 1 + j] = raw[warm, j]
    linear = np.flatnonzero(rice & (order == LPC))
    packed = np.full(len(linear), PRECISION - 1 << 5 | SHIFT, np.int64)
    for j in range(LPC):
        packed = packed << PRECISION | coef[linear, j] & (1 << PRECISION) - 1
    for j in range(LPC_BYTES):
        out[sub[linear] + 1 + LPC + j] = packed >> 8 * (LPC_BYTES - 1 - j) & 0xFF
    at = (sub + 1 + order + extra)[rice]
    out[at] = k[rice] >> 2
    out[at + 1] |= ((k[rice] & 3) << 6).astype(np.uint8)
    check = crc_many(out, start, length - 2, 16)
    out[start + length - 2], out[start + length - 1] = check >> 8, check & 0xFF
    return out.tobytes(), np.append(start, int(length.sum()))


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """A mono stream of 8-bit samples for each payload (byte - 128; a multiple of 576 bytes), with seek points and frames' lengths."""
    count = np.array([len(p) // BLOCK for p in payloads], np.int64)
    if not len(count):
        return []
    x = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, BLOCK).astype(np.int16) - 128
    first = np.cumsum(count) - count
    number = np.arange(len(x)) - np.repeat(first, count)
    data, at = encode_frames(x, number)
    out, signed = [], x.astype(np.int8)
    for a, c in zip(first.tolist(), count.tolist()):
        size = np.diff(at[a : a + c + 1])
        md5 = hashlib.md5(signed[a : a + c].tobytes()).digest()
        info = struct.pack(">HH", BLOCK, BLOCK) + int(size.min()).to_bytes(3, "big") + int(size.max()).to_bytes(3, "big") + (RATE << 44 | 7 << 36 | c * BLOCK).to_bytes(8, "big") + md5
        points = np.zeros(-(-c // SEEK_FRAMES), [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
        points["sample"], points["offset"], points["n"] = np.arange(0, c, SEEK_FRAMES) * BLOCK, (at[a : a + c] - at[a])[::SEEK_FRAMES], BLOCK
        blocks = [(0, info)]
        for k in range(0, c, 8_000_000):  # a metadata block has 24 bits for its length
            blocks.append((2, SIZES + size[k : k + 8_000_000].astype("<u2").tobytes()))
        for k in range(0, len(points), 900_000):
            blocks.append((3, points[k : k + 900_000].tobytes()))
        meta = b"".join(bytes([kind | 0x80 * (j == len(blocks) - 1)]) + len(b).to_bytes(3, "big") + b for j, (kind, b) in enumerate(blocks))
        out.append(b"fLaC" + meta + data[at[a] : at[a + c]])
    return out


# ---------------------------------------------------------------- decoder


class Bits:
    """Reads bits, most significant first."""

    def __init__(self, data: bytes, byte: int = 0):
        self.data, self.at = data, 8 * byte

    def take(self, n: int) -> int:
        if n == 0:
            return 0
        a, b = self.at >> 3, self.at + n + 7 >> 3
        if b > len(self.data):
            raise ValueError("a frame ends too early")
        v = int.from_bytes(self.data[a:b], "big") >> 8 * b - self.at - n & (1 << n) - 1
        self.at += n
        return v

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v - (v >> n - 1 << n) if n else 0

    def unary(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


def metadata(data: bytes) -> dict:
    """STREAMINFO, the seek points that aren't placeholders, frames' lengths if they are there, and the byte where frames begin."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, out = 4, False, {"seek": [], "sizes": []}
    while not last:
        if at + 4 > len(data) or at + 4 + int.from_bytes(data[at + 1 : at + 4], "big") > len(data):
            raise ValueError("the metadata ends too early")
        last, kind, n = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        b = data[at + 4 : at + 4 + n]
        if kind == 0:
            if n != 34:
                raise ValueError("STREAMINFO has another length")
            v = int.from_bytes(b[10:18], "big")
            out |= {"rate": v >> 44, "channels": (v >> 41 & 7) + 1, "bits": (v >> 36 & 31) + 1, "samples": v & (1 << 36) - 1, "md5": b[18:34], "block": struct.unpack(">HH", b[:4])}
        elif kind == 2 and b[:4] == SIZES and n % 2 == 0:
            out["sizes"].append(np.frombuffer(b[4:], "<u2").astype(np.int64))
        elif kind == 3:
            if n % 18:
                raise ValueError("a seek table has another length")
            p = np.frombuffer(b, [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
            out["seek"].append(p[p["sample"] != 0xFFFFFFFFFFFFFFFF])
        at += 4 + n
    if "samples" not in out:
        raise ValueError("STREAMINFO is missing")
    out["seek"] = np.concatenate(out["seek"]) if out["seek"] else np.zeros(0, [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
    out["sizes"] = np.concatenate(out["sizes"]) if out["sizes"] else np.zeros(0, np.int64)
    return out | {"body": at}


def _subframe(r: Bits, n: int, bits: int) -> np.ndarray:
    if r.take(1):
        raise ValueError("a subframe begins with 1")
    kind, wasted = r.take(6), 0
    if r.take(1):
        wasted = r.unary() + 1
    bits -= wasted
    if kind == 0:
        return np.full(n, r.signed(bits), np.int64) << wasted
    if kind == 1:
        return np.array([r.signed(bits) for _ in range(n)], np.int64) << wasted
    if 8 <= kind <= 12:
        order, shift = kind - 8, 0
        x = [r.signed(bits) for _ in range(order)]
        coef = FIXED[order]
    elif kind >= 32:
        order = kind - 31
        x = [r.signed(bits) for _ in range(order)]
        precision = r.take(4) + 1
        shift = r.signed(5)
        if precision == 16 or shift < 0:
            raise ValueError("a predictor is invalid")
        coef = [r.signed(precision) for _ in range(order)]
    else:
        raise ValueError("a subframe has a reserved type")
    wide = {0: 4, 1: 5}[r.take(2)]
    parts = 1 << r.take(4)
    for p in range(parts):
        count, k = n // parts - (order if p == 0 else 0), r.take(wide)
        escape = r.take(5) if k == (1 << wide) - 1 else None
        for _ in range(count):
            if escape is None:
                u = r.unary() << k | r.take(k)
                e = u >> 1 ^ -(u & 1)
            else:
                e = r.signed(escape)
            x.append(e + (sum(c * x[-1 - j] for j, c in enumerate(coef)) >> shift))
    return np.array(x, np.int64) << wasted


def decode_frame(data: bytes, at: int, info: dict) -> tuple[np.ndarray, int]:
    """Samples (channels x block) of the frame that begins at a byte, and the byte behind it."""
    r = Bits(data, at)
    if r.take(15) != 0x7FFC:
        raise ValueError("no frame begins here")
    r.take(1)
    size, rate, joint, depth = r.take(4), r.take(4), r.take(4), r.take(3)
    r.take(1)
    lead = r.take(8)
    more = 0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length() - 1
    r.take(8 * more)
    n = r.take(8 if size == 6 else 16) + 1 if size in (6, 7) else 192 if size == 1 else 576 << size - 2 if size < 6 else 256 << size - 8
    r.take({12: 8, 13: 16, 14: 16}.get(rate, 0))
    if crc(data[at : r.at >> 3], 8) != r.take(8):
        raise ValueError("a frame header's checksum is wrong")
    bits = {0: info["bits"], 1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}[depth]
    count = joint + 1 if joint < 8 else 2
    side = {8: 1, 9: 0, 10: 1}.get(joint)
    ch = [_subframe(r, n, bits + (c == side)) for c in range(count)]
    if joint == 8:
        ch[1] = ch[0] - ch[1]
    elif joint == 9:
        ch[0] = ch[0] + ch[1]
    elif joint == 10:
        mid = ch[0] << 1 | ch[1] & 1
        ch = [mid + ch[1] >> 1, mid - ch[1] >> 1]
    end = r.at + 7 >> 3
    if crc(data[at:end], 16) != int.from_bytes(data[end : end + 2], "big"):
        raise ValueError("a frame's checksum is wrong")
    return np.stack(ch), end + 2


def pcm(samples: np.ndarray, bits: int) -> bytes:
    """Interleaved little-endian PCM of whole bytes a sample."""
    width = bits + 7 >> 3
    flat = np.ascontiguousarray(samples.T).astype("<i8").view(np.uint8).reshape(-1, 8)
    return flat[:, :width].tobytes()


def decode(data: bytes) -> tuple[np.ndarray, dict]:
    """All samples (channels x samples) of a stream and its metadata; the MD5 is verified if it is given."""
    info = metadata(data)
    at, out = info["body"], []
    while at < len(data):
        x, at = decode_frame(data, at, info)
        out.append(x)
    samples = np.concatenate(out, axis=1) if out else np.zeros((info["channels"], 0), np.int64)
    if any(info["md5"]) and hashlib.md5(pcm(samples, info["bits"])).digest() != info["md5"]:
        raise ValueError("the stream's MD5 is wrong")
    return samples, info


def read_samples(data: bytes, first: int, count: int) -> np.ndarray:
    """Samples first to first + count - 1, from the nearest seek point on."""
    info = metadata(data)
    before = info["seek"][info["seek"]["sample"] <= first]
    at, now = (info["body"] + int(before[-1]["offset"]), int(before[-1]["sample"])) if len(before) else (info["body"], 0)
    skip, out = first - now, []
    while at < len(data) and now < first + count:
        x, at = decode_frame(data, at, info)
        now += x.shape[1]
        out.append(x)
    return np.concatenate(out, axis=1)[:, skip : skip + count] if out else np.zeros((info["channels"], 0), np.int64)


def decode_frames(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray | None:
    """Samples (frames x 576) of frames as `encode_frames` writes them; None if one is of another kind.

    Headers' CRC-8 and frames' CRC-16 are verified.
    """
    n = len(start)
    buf = np.concatenate([buf, np.zeros(16, np.uint8)])
    fixed = buf[start[:, None] + np.arange(4)]
    if (fixed != np.frombuffer(b"\xff\xf8\x24\x02", np.uint8)).any():
        return None
    lead = buf[start + 4].astype(np.int64)
    more = np.where(lead < 0x80, 0, 7 - np.floor(np.log2(np.maximum(lead ^ 0xFF, 1))).astype(np.int64) - 1)
    head = 6 + more
    if (crc_many(buf, start, head - 1, 8) != buf[start + head - 1]).any():
        raise ValueError("a frame header's checksum is wrong")
    check = buf[start + length - 2].astype(np.uint16) << 8 | buf[start + length - 1]
    if (crc_many(buf, start, length - 2, 16) != check).any():
        raise ValueError("a frame's checksum is wrong")
    sub = start + head
    kind = buf[sub]
    linear = kind == LPC_KIND
    order = np.where((kind >= 16) & (kind <= 16 + 2 * MAX_ORDER), kind.astype(np.int64) - 16 >> 1, np.where(linear, LPC, 0))
    rice = (kind >= 16) & (kind <= 16 + 2 * MAX_ORDER) & (kind & 1 == 0) | linear
    at = sub + 1 + order + np.where(linear, LPC_BYTES, 0)
    packed = np.zeros(n, np.int64)
    for j in range(LPC_BYTES):
        packed = packed << 8 | buf[sub + 1 + LPC + j]
    if (packed[linear] >> LPC * PRECISION != (PRECISION - 1 << 5 | SHIFT)).any():
        return None  # a predictor of other widths
    if not (rice | (kind == 0) | (kind == 2)).all() or (buf[at[rice]] >> 2).any():
        return None  # another subframe, another Rice method or several partitions
    out = np.zeros((n, BLOCK), np.int32)
    signed = buf.view(np.int8)
    c, v = kind == 0, kind == 2
    out[c] = signed[sub[c] + 1][:, None]
    if v.any():
        out[v] = signed[sub[v][:, None] + 1 + np.arange(BLOCK)]
    r = np.flatnonzero(rice)
    if not len(r):
        return out
    r = r[np.argsort(order[r], kind="stable")]
    k = (buf[at[r]].astype(np.int64) & 3) << 2 | buf[at[r] + 1] >> 6
    if (k == 15).any():
        return None
    window = (buf[:-3].astype(np.uint32) << 24) | (buf[1:-2].astype(np.uint32) << 16) | (buf[2:-1].astype(np.uint32) << 8) | buf[3:]
    pos, o = 8 * at[r] + 10, order[r]
    res = np.zeros((BLOCK, len(r)), np.int32)
    k32, back = k.astype(np.uint32), (32 - k).astype(np.uint32)
    for i in range(BLOCK):
        m = int(np.searchsorted(o, i, side="right")) if i < LPC else len(r)  # frames whose first residual has come
        p = pos[:m]
        w = window[p >> 3] << (p & 7).astype(np.uint32)
        q = 32 - np.frexp(w.astype(np.float64))[1].astype(np.int64)
        far = np.flatnonzero(w < 1 << 8)  # a run of zeros that may leave the window
        for f in far:
            q[f] = 0
            while not buf[(p[f] + q[f]) >> 3] >> (7 - ((p[f] + q[f]) & 7)) & 1:
                q[f] += 1
        p = p + q + 1
        low = (window[p >> 3] << (p & 7).astype(np.uint32)).astype(np.uint64) >> back[:m]
        u = (q << k[:m]) | low.astype(np.int64)
        res[i, :m] = (u >> 1) ^ -(u & 1)
        pos[:m] = p + k[:m]
    for p in range(1, int(o.max()) + 1):
        f = np.flatnonzero(o == p)
        if not len(f):
            continue
        y = res[:, f]
        y[:p] = signed[sub[r[f]][None, :] + 1 + np.arange(p)[:, None]]
        if p == LPC:
            coef = [packed[r[f]] >> PRECISION * (LPC - 1 - j) & (1 << PRECISION) - 1 for j in range(LPC)]
            coef = [(c - (c >> PRECISION - 1 << PRECISION)).astype(np.int32) for c in coef]
            for i in range(p, BLOCK):
                y[i] += sum(c * y[i - 1 - j] for j, c in enumerate(coef)) >> SHIFT
        else:
            for i in range(p, BLOCK):
                for j, c in enumerate(FIXED[p]):
                    y[i] += c * y[i - 1 - j]
        res[:, f] = y
    out[r] = res.T
    return out


def decoded(streams: list[bytes]) -> list[np.ndarray | ValueError]:
    """Samples of streams, or what is wrong with one; those that give the lengths of their frames, all of the plain kind, are decoded side by side."""
    infos = [_tried(metadata, s) for s in streams]
    plain = [i for i, m in enumerate(infos) if not isinstance(m, ValueError) and m["channels"] == 1 and m["bits"] == 8 and m["block"] == (BLOCK, BLOCK) and len(m["sizes"]) * BLOCK == m["samples"] > 0 and m["sizes"].min() >= 10 and m["body"] + m["sizes"].sum() == len(streams[i])]
    done: dict[int, np.ndarray | ValueError] = {i: m for i, m in enumerate(infos) if isinstance(m, ValueError)}
    if plain:
        base = np.cumsum([0, *(len(streams[i]) for i in plain)])
        start = np.concatenate([base[k] + infos[i]["body"] + np.cumsum(infos[i]["sizes"]) - infos[i]["sizes"] for k, i in enumerate(plain)])
        count = np.array([len(infos[i]["sizes"]) for i in plain])
        last = np.cumsum(count) - 1
        ends = np.append(start[1:], 0)
        ends[last] = base[1:]
        x = _tried(decode_frames, np.frombuffer(b"".join(streams[i] for i in plain), np.uint8), start, ends - start)
        if x is not None and not isinstance(x, ValueError):
            for i, a, b in zip(plain, last + 1 - count, last + 1):
                y = x[a:b].reshape(1, -1)
                if hashlib.md5(y.astype(np.int8).tobytes()).digest() == infos[i]["md5"]:
                    done[i] = y
    return [done[i] if i in done else _tried(lambda d: decode(d)[0], s) for i, s in enumerate(streams)]


def decode_many(streams: list[bytes]) -> list[np.ndarray]:
    """Samples of streams; a damaged one raises what is wrong with it."""
    out = decoded(streams)
    for x in out:
        if isinstance(x, ValueError):
            raise x
    return out


def _tried(f, *args):
    """What f returns, or what is wrong with its input."""
    try:
        return f(*args)
    except ValueError as e:
        return e
    except (IndexError, KeyError, struct.error) as e:  # a reader that ran over the end of damaged bytes
        return ValueError(f"damaged: {e!r}")


# ---------------------------------------------------------------- operators


def payload(text: bytes) -> bytes:
    """A text's bytes, filled with 255 to a positive multiple of 576."""
    return text + b"\xff" * (BLOCK - len(text) % BLOCK if len(text) % BLOCK or not text else 0)


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [b or b"" for b in batch.column(name).cast(pa.large_binary()).to_pylist()]


def _chunks(values: list[bytes], most: int = 6 << 20) -> Iterator[tuple[int, int]]:
    a, held = 0, 0
    for i, v in enumerate(values):
        held += len(v)
        if held >= most:
            yield a, i + 1
            a, held = i + 1, 0
    if a < len(values):
        yield a, len(values)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _texts(batch, "text")
        for a, b in _chunks(texts):
            media = encode_many([payload(t) for t in texts[a:b]])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the FLAC stream (media) of each whole text's payload. Null text: empty, one block of padding.

    Repeated rows stay; equal texts give equal streams; further columns are ignored.
    """
    prepare(docs.sparkSession)
    return documents(docs).mapInArrow(lambda b: tidied(_encode(b)), "doc_id long, n_bytes long, media binary")


def cut_pcm(x: np.ndarray, bits: int, block: int = PCM_BLOCK) -> list[tuple[int, int, bytes]]:
    """First sample, number of samples and PCM of each block of decoded samples."""
    return [(a, min(block, x.shape[1] - a), pcm(x[:, a : a + block], bits)) for a in range(0, x.shape[1], block)]


def _blocks(key: str, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, data in zip(batch.column(key).to_pylist(), batch.column("media").to_pylist()):
            if data is None:
                continue
            x = decoded([data])[0]
            bad = isinstance(x, ValueError)
            info = {"bits": None, "rate": None} if bad else metadata(data)
            rows = [(None, None, None)] if bad else cut_pcm(x, info["bits"], block)
            n = len(rows)
            yield pa.RecordBatch.from_pydict({
                key: pa.array([doc] * n, pa.int64()), "block": pa.array(range(n), pa.int64()), "first_sample": pa.array([r[0] for r in rows], pa.int64()), "n_samples": pa.array([r[1] for r in rows], pa.int64()),
                "channels": pa.array([None if bad else x.shape[0]] * n, pa.int32()), "bits": pa.array([info["bits"]] * n, pa.int32()), "rate": pa.array([info["rate"]] * n, pa.int32()),
                "pcm": pa.array([r[2] for r in rows], pa.binary()), "error": pa.array([str(x) if bad else None] * n, pa.string()),
            })


def pcm_blocks(media: DataFrame, key: str = "doc_id", block: int = PCM_BLOCK) -> DataFrame:
    """PCM blocks of streams in column media: key, block, first_sample (seek to it), n_samples, channels, bits, rate, pcm, error.

    A null stream gives no block; a damaged one a single row whose error says what is wrong, and no samples.
    """
    prepare(media.sparkSession)
    return media.select(key, "media").mapInArrow(lambda b: _blocks(key, block, b), f"{key} long, block long, first_sample long, n_samples long, channels int, bits int, rate int, pcm binary, error string")


DIGEST = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "n_pcm_blocks": pa.int64(), "error": pa.string()}


def _digest_of(media: bytes, x: np.ndarray | ValueError) -> tuple:
    stored_ = len(media), hashlib.sha256(media).hexdigest()
    if isinstance(x, ValueError):
        return None, None, None, *stored_, None, None, str(x)
    blocks = cut_pcm(x, 8)
    signed = np.frombuffer(b"".join(b for _, _, b in blocks), np.int8)
    data, wide, below = (signed.view(np.uint8) ^ 0x80).tobytes(), signed.astype(np.int16), signed < 0
    feature = f"mean_abs={int(np.abs(wide).sum(dtype=np.int64)) / len(wide):.4f};crossings={int((below[1:] != below[:-1]).sum())};peak={int(np.abs(wide).max())};seconds={len(wide) / RATE:.3f}"
    return len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), *stored_, feature, len(blocks), None


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = batch.column("media").to_pylist()
        rows = [_digest_of(m, x) for a, b in _chunks(media) for m, x in zip(media[a:b], decoded(media[a:b]))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(DIGEST.values()))], names=["doc_id", "n_bytes", *DIGEST])


def digests(media: DataFrame) -> DataFrame:
    """Decode each stream of `store` to PCM blocks: payload length, SHA-256 and CRC-32 of its last 32 bytes, those of the stream,
    features, number of blocks, and error: what is wrong with a damaged stream, whose payload columns are null."""
    prepare(media.sparkSession)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(lambda b: tidied(_digest(b)), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pcm_blocks long, error string")
