"""Whole-text encoding with a tokenizers vocabulary, one distinct piece at a time.

A text is cut at spaces that a character other than white space follows. Both kinds of vocabulary (byte-level BPE that
keeps the space with the next word; word BPE that drops white space) cut there anyway, so the ids of the parts are the ids
of the text. Words repeat, so each distinct part of a batch is looked up once and the ids are gathered in numpy; a part
that a worker has not met goes through the library's own model.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .words import whole

BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that both patterns take as one match where they follow a word.
MARKS = ",.;:!?"
#: A space that no word follows: there a text can't be cut at each space.
LOOSE = " (?:[\\pZ\\x09-\\x0d\\x1c-\\x1f\\x85]|$)"
SPLIT = regex.compile(r" (?=\S)")
#: Below this character all Unicode versions agree on classes, case and composition.
STABLE = "ɐ"


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class PieceEncoder:
    """Encodes texts by a tokenizers JSON file. limit: distinct pieces kept, which bounds a worker's memory."""

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = max([*spec["model"]["vocab"].values(), *(a["id"] for a in spec["added_tokens"])]) + 1
        self.by_word = spec["model"].get("end_of_word_suffix") == "</w>"
        self.model, self.limit, self.cache = self.t.model, limit, {}
        self.find = regex.compile(WORD_PATTERN if self.by_word else BYTE_PATTERN).findall
        self.letters = [v for _, v in sorted(byte_alphabet().items())]
        self.latin = str.maketrans(dict(enumerate(self.letters)))

    def _piece(self, p: str) -> bytes:
        """Ids of one match of the vocabulary's pattern."""
        got = self.cache.get(p)
        if got is None:
            mapped = p if p.isalpha() and p.isascii() else p.encode("utf-8").decode("latin-1").translate(self.latin)
            got = self.cache[p] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])
        return got

    def part(self, w: str) -> bytes:
        """Ids of one part of a text, as little-endian unsigned 32-bit integers."""
        got = self.cache.get(w)
        if got is not None:
            return got
        if not w:
            return b""
        if not w.isascii() and max(w) >= STABLE:
            return np.array(self.t.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        if self.by_word:
            w = w.lower()
        word = w.rstrip(MARKS)
        if (word if self.by_word or word[:1] != " " else word[1:]).isalpha():  # letters, then marks or none: no need for the pattern
            got = self.cache.get(word) or self._piece(word)
            return got if len(word) == len(w) else got + self._piece(w[len(word) :])
        found = self.find(w)
        return self._piece(found[0]) if len(found) == 1 else b"".join(map(self._piece, found))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) into the ids of all texts, and those ids."""
        texts = whole(texts.cast(pa.large_string()).fill_null(""))
        if len(texts) == 0:
            return np.zeros(1, np.int64), np.zeros(0, np.uint32)
        if len(self.cache) > self.limit:
            self.cache.clear()
        loose = np.zeros(len(texts), bool) if self.by_word else pc.match_substring_regex(texts, LOOSE).to_numpy(zero_copy_only=False)
        if loose.any():
            cut = [(SPLIT.split(t) if odd else t.split(" ")) for t, odd in zip(texts.to_pylist(), loose)]
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
            words = pa.array([w for c in cut for w in c], pa.large_string())
        else:
            cut = pc.split_pattern(texts, " ")
            bounds, words = cut.offsets.to_numpy().astype(np.int64), cut.values
            words, bounds = words.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        vocab, part, get = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.part, self.cache.get
        if self.by_word:
            ids = [get(w) or part(w) for w in vocab]
        else:
            ids = [get(w) or part(w) for w in [" " + w for w in vocab]]
            first = bounds[:-1]
            ids += [part(vocab[k]) for k in index[first]]  # nothing stands before a text's first part
            index[first] = len(vocab) + np.arange(len(first))
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.array([len(x) for x in ids], np.int64) >> 2
        start = np.cumsum(size) - size
        each = size[index]
        ends = np.cumsum(each)
        at = np.repeat(start[index] - (ends - each), each)
        at += np.arange(len(at))
        return np.concatenate([[0], ends])[bounds], flat[at]


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for a vocabulary file."""
    return PieceEncoder(path)
