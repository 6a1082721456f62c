"""Log-bilinear language model trained by noise-contrastive estimation in numpy (operator 10).

Tokens are a text's words and one end. Every word that occurs COUNT times or more is a unit with vectors of its own, as context
and as prediction, so the model grows with the corpus up to VOCABULARY words, the most frequent ones; all others share
units, by a hash of their last two bytes, and count by themselves within them. The softmax has three levels: the most
frequent words and the hashes of all others are classes, a class has groups, a group has units, about as many of them as there
are groups:

    p(w | b, a) = p(class | classes of b, a) p(group | class, h) p(w | group, h),    h = T1 * r_a + T2 * r_b

with diagonal T1, T2, each a softmax of the context's vector with those of what is predicted, and biases; a rarer word has its
smoothed share of its unit, (count + 1) / (tokens + words + 1). Scores are exact.

Both parts are trained by noise-contrastive estimation. The classes' model is fitted on the driver to counted class triples, of
which there are at most CLASSES + 1 squared times CLASSES; matrix products give its probabilities after all contexts once.
Its vectors are the first ones of the units. Then a pass reads all training tokens: every task steps through its own, with noise
from the same parent at each level, and the tables of the tasks are averaged, each row by how often a task used it, in whole
numbers, so the order of tasks has no effect.

Words with vectors, and these, go to each worker; the counts of all others meet the documents in a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import drop, prepare, stored, tidied
from .words import Spans, count_words, frequent, hashes

TOP_WORDS, SHAPES = 96, 32
CLASSES = TOP_WORDS + SHAPES
COUNT = 5
#: Most words with vectors of their own, which bounds what is sent to each worker (about 25 MB).
VOCABULARY = 100_000
PASSES = 1
#: Bits of hashes by which units are found.
PREFIX = 18
#: Tokens of a step of the pass.
STEP = 8192
END = b""  # no word is empty


def shape(word: bytes) -> int:
    """Class of a word that has none of its own."""
    return TOP_WORDS + zlib.crc32(word[-2:]) % SHAPES


#: shape() by a word's last two bytes (the last one alone: 65536 and on).
_SHAPE_OF = np.array([shape(bytes([k >> 8, k & 255])) for k in range(1 << 16)] + [shape(bytes([k])) for k in range(256)], np.int64)


@dataclass
class LogBilinear:
    """r, q: vectors of context and predicted classes; t: position weights; bias. Class CLASSES stands before a text."""

    r: np.ndarray
    q: np.ndarray
    t: np.ndarray
    bias: np.ndarray
    _table: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def scores(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Unnormalised scores of all classes for contexts."""
        return (self.t[0] * self.r[last] + self.t[1] * self.r[before]) @ self.q.T + self.bias

    def table(self) -> np.ndarray:
        """log10 probability of each class after each of the (CLASSES + 1) squared contexts."""
        if self._table is None:
            n, out = len(self.r), []
            for k in range(n):  # a matrix product for each second-last class
                s = self.scores(np.full(n, k), np.arange(n))
                s -= s.max(axis=1, keepdims=True)
                out.append((s - np.log(np.exp(s).sum(axis=1, keepdims=True))) / np.log(10))
            self._table = np.concatenate(out).astype(np.float32)
        return self._table


def train(cells: np.ndarray, counts: np.ndarray, dim: int = 16, noise: int = 12, batch: int = 2048, steps: int = 1500, seed: int = 7) -> LogBilinear:
    """Fit to counted class triples, coded ((before * n) + last) * CLASSES + class with n = CLASSES + 1, by NCE with Adam.

    Noise is the distribution of classes. Equal input gives equal models. Without counts the model is uniform.
    """
    rng, n = np.random.default_rng(seed), CLASSES + 1
    p = {"r": rng.normal(0, 0.3, (n, dim)), "q": rng.normal(0, 0.3, (CLASSES, dim)), "t": np.ones((2, dim)) * 0.5, "bias": np.zeros(CLASSES)}
    if not len(cells):
        return LogBilinear(p["r"] * 0, p["q"] * 0, p["t"], p["bias"])
    order = np.argsort(cells)
    cells, weight = cells[order], counts[order].astype(np.float64)
    target, last, before = cells % CLASSES, cells // CLASSES % n, cells // CLASSES // n
    unigram = np.bincount(target, weight, CLASSES) + 0.5
    unigram /= unigram.sum()
    p["bias"] = np.log(unigram)
    cum, cum_noise = np.cumsum(weight) / weight.sum(), np.cumsum(unigram)
    log_kn, rows = np.log(noise * unigram), np.arange(batch)
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    for step in range(1, steps + 1):
        pick = np.minimum(np.searchsorted(cum, rng.random(batch)), len(cells) - 1)
        a, b = last[pick], before[pick]
        c = np.concatenate([target[pick][:, None], np.minimum(np.searchsorted(cum_noise, rng.random((batch, noise))), CLASSES - 1)], axis=1)
        ra, rb = p["r"][a], p["r"][b]
        h = p["t"][0] * ra + p["t"][1] * rb
        qc = p["q"][c]
        delta = np.einsum("nd,nkd->nk", h, qc) + p["bias"][c] - log_kn[c]
        g = 1 / (1 + np.exp(-np.clip(delta, -30, 30)))
        g[:, 0] -= 1  # the first of each row is data, the others are noise
        g /= batch
        dh = np.einsum("nk,nkd->nd", g, qc)
        one = np.bincount((c * batch + rows[:, None]).ravel(), g.ravel(), CLASSES * batch).reshape(CLASSES, batch)
        dr = np.zeros_like(p["r"])
        for at, x in ((a, dh * p["t"][0]), (b, dh * p["t"][1])):
            hot = np.zeros((n, batch))
            hot[at, rows] = 1
            dr += hot @ x
        grad = {"r": dr, "q": one @ h, "t": np.stack([(dh * ra).sum(0), (dh * rb).sum(0)]), "bias": one.sum(1)}
        rate = 0.02 * (1 - 0.95 * step / steps)
        for k, x in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.999 * v[k] + 0.001 * x * x
            p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return LogBilinear(**p)


class Lexicon:
    """Units and their tree: words with vectors, ordered by class and count, and a unit of each shape's rarer words."""

    def __init__(self, words: list[bytes], count: np.ndarray, rare: np.ndarray, tokens: int, distinct: int):
        """words: those of COUNT or more, most frequent first; rare: tokens + words + 1 of the rarer ones of each class."""
        self.tokens, self.distinct, self.rare = tokens, distinct, rare
        kind = np.array([k if k < TOP_WORDS else shape(w) for k, w in enumerate(words)], np.int64)
        kind = np.concatenate([kind, np.arange(TOP_WORDS, CLASSES)])
        seen = np.concatenate([count, rare[TOP_WORDS:]]).astype(np.float64)
        order = np.lexsort((-seen, kind))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.word = dict(zip(words, place.tolist()))
        self._index([w for w in words if w != END], place[[k for k, w in enumerate(words) if w != END]])
        self.backed = np.concatenate([np.zeros(TOP_WORDS, np.int64), place[len(words) :]])
        self.seen = seen[order]
        self.known = np.where(order < len(words), self.seen, -1).astype(np.int64)
        self.kind = kind[order]
        members = np.bincount(self.kind, minlength=CLASSES)
        first = np.cumsum(members) - members
        inside = np.arange(len(order)) - first[self.kind]
        wide = np.maximum(1, np.ceil(np.sqrt(members)).astype(np.int64))
        groups = -(-members // wide)
        self.group = (np.cumsum(groups) - groups)[self.kind] + inside // wide[self.kind]
        self.group_kind = np.repeat(np.arange(CLASSES), groups)

    def _index(self, words: list[bytes], place: np.ndarray) -> None:
        """Units by hash: hashes in order, and where those with the same first PREFIX bits begin."""
        size = np.array([len(w) for w in words], np.int64)
        end = np.cumsum(size)
        h = hashes(np.frombuffer(b"".join(words), np.uint8), end - size, end)
        order = np.argsort(h)
        self.hash, self.hash_unit = np.append(h[order], np.uint64(0)), np.append(place[order], -1)
        self.first = np.searchsorted(h[order] >> np.uint64(64 - PREFIX), np.arange((1 << PREFIX) + 1, dtype=np.uint64))

    def units_of(self, spans: Spans) -> np.ndarray:
        """Units of words by their hashes; what has no vectors is in the unit of its shape."""
        prefix = (spans.hash >> np.uint64(64 - PREFIX)).astype(np.int64)
        at, stop = self.first[prefix], self.first[prefix + 1]
        unit = np.full(len(at), -1, np.int64)
        left = np.flatnonzero(at < stop)
        while len(left):
            same = self.hash[at[left]] == spans.hash[left]
            unit[left[same]] = self.hash_unit[at[left[same]]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        rare = np.flatnonzero(unit < 0)
        last = spans.buf[spans.end[rare] - 1].astype(np.int64)
        two = spans.end[rare] - spans.start[rare] > 1
        pair = np.where(two, spans.buf[np.maximum(spans.end[rare] - 2, 0)].astype(np.int64) << 8 | last, (1 << 16) + last)
        unit[rare] = self.backed[_SHAPE_OF[pair]]
        return unit

    def units(self, vocab: list[bytes]) -> np.ndarray:
        return np.array([self.word[w] if w in self.word else self.backed[shape(w)] for w in vocab], np.int64)

    def classes(self, vocab: list[bytes]) -> np.ndarray:
        return self.kind[self.units(vocab)]

    def families(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of classes, groups and units: the parent of each, and of each parent the number of children and the first one."""
        out = []
        for parent, _ in self.levels():
            size = np.bincount(parent)
            out.append((parent, size, np.cumsum(size) - size))
        return out

    def levels(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of classes, groups and units: the parent of each, in order, and how often each occurs."""
        by = lambda x, n: np.bincount(x, self.seen, n)
        return [(np.zeros(CLASSES, np.int64), by(self.kind, CLASSES) + 0.5), (self.group_kind, by(self.group, len(self.group_kind))), (self.group, self.seen)]


class Tables:
    """Vectors of a model in one matrix: contexts (units and the start), position weights, then classes, groups and units with a bias last."""

    def __init__(self, lex: Lexicon, rows: np.ndarray):
        self.rows, n = rows, len(lex.kind)
        self.cut = np.cumsum([0, n + 1, 2, CLASSES, len(lex.group_kind), n])

    @property
    def r(self) -> np.ndarray:
        return self.rows[: self.cut[1], :-1]

    @property
    def t(self) -> np.ndarray:
        return self.rows[self.cut[1] : self.cut[2], :-1]

    def q(self, level: int) -> np.ndarray:
        return self.rows[self.cut[level + 2] : self.cut[level + 3]]

    @classmethod
    def first(cls, lex: Lexicon, start: LogBilinear) -> Tables:
        """Those of the class model for all units of a class; groups and units have their share of the parent."""
        n, dim = len(lex.kind), start.r.shape[1]
        rows = np.zeros((n + 1 + 2 + CLASSES + len(lex.group_kind) + n, dim + 1), np.float32)
        out = cls(lex, rows)
        out.r[:] = start.r[np.append(lex.kind, CLASSES)]
        out.t[:] = start.t
        out.q(0)[:] = np.column_stack([start.q, start.bias])
        for k, (parent, seen) in enumerate(lex.levels()[1:], 1):
            out.q(k)[:, -1] = np.log(seen / np.bincount(parent, seen)[parent])
        return out

    def hidden(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        h = self.t[0] * self.r[last] + self.t[1] * self.r[before]
        return np.column_stack([h, np.ones(len(h), np.float32)])

    def log10(self, lex: Lexicon, before: np.ndarray, last: np.ndarray, unit: np.ndarray, classes: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of units after contexts; classes: the table of a classes' model, in place of a softmax of the first level.

        Units are numbered by class and group, so tokens in the order of their units are slices of a class and of a group.
        """
        out = np.zeros(len(unit))
        if classes is not None:
            kind = np.append(lex.kind, CLASSES)
            out = classes[kind[before] * (CLASSES + 1) + kind[last], lex.kind[unit]] * np.log(10)
        order = np.argsort(unit)
        at = [lex.kind[unit[order]], lex.group[unit[order]], unit[order]]
        for level, (parent, size, start) in enumerate(lex.families()):
            if level == 0 and classes is not None:
                continue
            up = parent[at[level]]
            some = np.flatnonzero(size[up] > 1)  # an only child is certain
            if not len(some):
                continue
            h = self.hidden(before[order[some]], last[order[some]])
            q, edge, child = self.q(level), np.flatnonzero(np.diff(up[some], prepend=-1, append=-1)), at[level][some]
            gain = np.empty(len(some))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                p = up[some[a]]
                part = q[start[p] : start[p] + size[p]].T
                step = max(256, 1_000_000 // int(size[p]))
                for k in range(a, b, step):
                    to = min(k + step, b)
                    x = h[k:to] @ part
                    x -= x.max(axis=1, keepdims=True)
                    own = x[np.arange(to - k), child[k:to] - start[p]]
                    gain[k:to] = own - np.log(np.exp(x, out=x).sum(axis=1))
            out[order[some]] += gain
        return out / np.log(10)


class Trainer:
    """Steps of noise-contrastive estimation over tokens, in tables of its own, with a rate that falls as a row is used."""

    def __init__(self, lex: Lexicon, rows: np.ndarray, seed: int, noise: int = 1, rate: float = 0.1):
        self.lex, self.t, self.noise, self.rate = lex, Tables(lex, rows.copy()), noise, rate
        self.rng = np.random.default_rng(seed)
        self.square, self.used = np.ones(len(rows), np.float32), np.zeros(len(rows), np.int64)
        self.open = np.bincount(lex.kind)[lex.kind] > 1
        self.levels = []
        for parent, seen in lex.levels():
            cum, size = np.cumsum(seen), np.bincount(parent)
            end = np.cumsum(size)
            top = cum[end - 1]
            low = np.concatenate([[0], top[:-1]])
            self.levels.append((parent, size, cum, low, top, end - size, end - 1, np.log(noise * seen / (top - low)[parent]).astype(np.float32)))

    def _move(self, row: np.ndarray, total: np.ndarray) -> None:
        """Steps of different rows along their gradients."""
        square = self.square[row] + np.einsum("ij,ij->i", total, total) / total.shape[1]
        moved = self.t.rows.take(row, axis=0)
        moved[:, : total.shape[1]] -= (self.rate / np.sqrt(square))[:, None] * total
        self.square[row], self.t.rows[row] = square, moved

    def step(self, before: np.ndarray, last: np.ndarray, unit: np.ndarray) -> None:
        """Groups and units against noise of their own parent. Units alone in their class teach nothing here."""
        learn = np.flatnonzero(self.open[unit])
        before, last, unit = before[learn], last[learn], unit[learn]
        if not len(unit):
            return
        t, dim = self.t, self.t.r.shape[1]
        ra, rb = (t.rows.take(x, axis=0)[:, :dim] for x in (last, before))
        h = np.ones((len(unit), dim + 1), np.float32)
        h[:, :dim] = t.t[0] * ra + t.t[1] * rb
        dh, moves = np.zeros((len(unit), dim), np.float32), []
        for level, at in ((1, self.lex.group[unit]), (2, unit)):
            parent, size, cum, low, top, first, final, log_kn = self.levels[level]
            i = np.flatnonzero(size[parent[at]] > 1)
            if not len(i):
                continue
            p = parent[at[i]]
            drawn = np.searchsorted(cum, low[p][:, None] + self.rng.random((len(i), self.noise)) * (top - low)[p][:, None], side="right")
            c, hi = np.column_stack([at[i], np.clip(drawn, first[p][:, None], final[p][:, None])]), h.take(i, axis=0)
            row = (t.cut[level + 2] + c).ravel()
            q = t.rows.take(row, axis=0).reshape(*c.shape, dim + 1)
            g = 1 / (1 + np.exp(-np.clip(np.einsum("nkd,nd->nk", q, hi) - log_kn[c], -30, 30)))
            g[:, 0] -= 1  # the first of each row is data, the others are noise
            dh[i] += np.einsum("nk,nkd->nd", g, q)[:, :dim]
            order = np.argsort(row)
            edge = np.flatnonzero(np.diff(row[order], prepend=-1))
            own = row[order[edge]]
            self.used[own] += np.diff(edge, append=len(row))
            moves.append((own, np.add.reduceat(g.ravel()[order][:, None] * hi.take(order // c.shape[1], axis=0), edge, axis=0)))
        row, grad = np.concatenate([last, before]), np.concatenate([dh * t.t[0], dh * t.t[1]])
        order = np.argsort(row)
        edge = np.flatnonzero(np.diff(row[order], prepend=-1))
        moves.append((row[order[edge]], np.add.reduceat(grad.take(order, axis=0), edge, axis=0)))
        moves.append((t.cut[1] + np.arange(2), np.stack([(dh * ra).mean(0), (dh * rb).mean(0)])))
        for row, total in moves:
            self._move(row, total)


POINT = 1 << 12
ROWS = 4096


def _pass(lex, rows, seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What one task's tokens changed in the tables: in blocks of ROWS, the rows it used, their use and steps of 1 / POINT."""
    lex, made = lex.value, None
    for batch in batches:
        bounds, unit, _ = _sequences(lex, batch.column("text"))
        made = made or Trainer(lex, rows.value, seed)
        before, last = _before(bounds, unit, len(lex.kind))
        made.used[: len(lex.kind) + 1] += np.bincount(np.concatenate([before, last]), minlength=len(lex.kind) + 1)
        order = made.rng.permutation(len(unit))
        for k in range(0, len(order), STEP):
            i = order[k : k + STEP]
            made.step(before[i], last[i], unit[i])
    if made:
        used = np.flatnonzero(made.used)
        edge = np.flatnonzero(np.diff(used // ROWS, prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:]):
            i = used[a:b]
            steps = np.clip(np.rint((made.t.rows[i] - rows.value[i]) * POINT), -32767, 32767).astype(np.int16)
            yield pa.RecordBatch.from_arrays([pa.array([i[0] // ROWS]), *(pa.array([x.tobytes()], pa.binary()) for x in (i, made.used[i], steps))], names=["block", "id", "n", "steps"])


def _mean(width: int, block: pa.Table) -> pa.Table:
    """Rows of a block and their mean steps, weighted by use."""
    first = block["block"][0].as_py()
    use, total = np.zeros(ROWS, np.int64), np.zeros((ROWS, width), np.int64)
    for i, n, steps in zip(*(block[c].to_pylist() for c in ("id", "n", "steps"))):
        i, n = np.frombuffer(i, np.int64) - first * ROWS, np.frombuffer(n, np.int64)
        use[i] += n
        total[i] += n[:, None] * np.frombuffer(steps, np.int16).reshape(-1, width)
    i = np.flatnonzero(use)
    mean = (total[i] / use[i][:, None] / POINT).astype(np.float32)
    return pa.table({"id": pa.array([(i + first * ROWS).tobytes()], pa.binary()), "mean": pa.array([mean.tobytes()], pa.binary())})


def fit(texts: DataFrame, lex, start: LogBilinear, passes: int = PASSES) -> np.ndarray:
    """Rows of the tables after passes over all tokens of column text; lex: a broadcast Lexicon."""
    sc, rows = texts.sparkSession.sparkContext, Tables.first(lex.value, start).rows
    width = rows.shape[1]
    for seed in range(passes):
        held = sc.broadcast(rows)
        part = texts.mapInArrow(lambda b, held=held, seed=seed: tidied(_pass(lex, held, seed, b)), "block long, id binary, n binary, steps binary")
        rows = rows.copy()
        for r in part.groupBy("block").applyInArrow(lambda t: _mean(width, t), "id binary, mean binary").collect():
            i = np.frombuffer(r["id"], np.int64)
            rows[i] += np.frombuffer(r["mean"], np.float32).reshape(len(i), -1)
        held.destroy()
    return rows


def _sequences(lex: Lexicon, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Spans]:
    """bounds, unit of each token, and the words; each text's last token is its end."""
    spans = Spans(texts)
    unit = np.insert(lex.units_of(spans), spans.bounds[1:], lex.word.get(END, -1))
    return spans.bounds + np.arange(len(spans.bounds)), unit, spans


def _before(bounds: np.ndarray, x: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """What stands two and one places before each token; `start` stands before a text."""
    last, before = np.empty_like(x), np.empty_like(x)
    last[1:], before[2:] = x[:-1], x[:-2]
    first = bounds[:-1]
    before[first] = last[first] = start  # a text has one token at least: its end
    second = first[np.diff(bounds) > 1] + 1
    before[second] = start
    return before, last


def _triples(lex, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lex = lex.value
    total = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int64)
    for batch in batches:
        bounds, unit, _ = _sequences(lex, batch.column("text"))
        if len(unit):
            cls = lex.kind[unit]
            before, last = _before(bounds, cls, CLASSES)
            total += np.bincount((before * (CLASSES + 1) + last) * CLASSES + cls, minlength=len(total))
    cell = np.flatnonzero(total)
    for k in range(0, len(cell), 500_000):
        part = cell[k : k + 500_000]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"])


def _score(lex, model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lex = lex.value
    rows, classes = model.value
    tables = Tables(lex, rows)
    floor = lex.tokens + lex.distinct + 1
    names = ["uid", "doc_id", "salt", "word", "class", "times", "n_tokens", "n_known", "base_score", "score"]
    for batch in batches:
        bounds, unit, spans = _sequences(lex, batch.column("text"))
        n, uid = len(bounds) - 1, batch.column("uid").to_numpy()
        if not n:
            continue
        count = lex.known[unit]
        known = count >= 0
        base = np.where(known, np.log10((np.maximum(count, 0) + 1) / floor), 0.0)
        by_doc = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has a token
        model_part = tables.log10(lex, *_before(bounds, unit, len(lex.kind)), unit, classes)
        none = pa.nulls(n, pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array(uid), batch.column("doc_id"), pa.array((uid % 997 + 1).astype(np.int32)), none, pa.nulls(n, pa.int32()), pa.array(np.zeros(n, np.int64)),
            pa.array(np.diff(bounds)), pa.array(by_doc(known.astype(np.int64))), pa.array(by_doc(base)), pa.array(by_doc(model_part)),
        ], names=names)
        words = np.delete(known, bounds[1:] - 1)
        rare = np.flatnonzero(~words)
        if len(rare):
            doc = np.searchsorted(spans.bounds, rare, side="right") - 1
            order = np.lexsort((spans.hash[rare], doc))
            rare, doc = rare[order], doc[order]
            new = np.flatnonzero(np.r_[True, (np.diff(doc) != 0) | (spans.hash[rare[1:]] != spans.hash[rare[:-1]])])
            times, rare, doc = np.diff(new, append=len(rare)), rare[new], doc[new]
            kind = lex.kind[np.delete(unit, bounds[1:] - 1)[rare]]
            z, zf = pa.nulls(len(rare), pa.int64()), pa.nulls(len(rare), pa.float64())
            yield pa.RecordBatch.from_arrays([
                pa.array(uid[doc]), z, pa.array(np.zeros(len(rare), np.int32)), pa.array(spans.bytes(rare), pa.binary()), pa.array(kind.astype(np.int32)), pa.array(times.astype(np.int64)),
                z, z, zf, zf,
            ], names=names)


def held_out(doc_id) -> F.Column:
    """Documents that nothing is learnt from; a null doc_id is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score(docs: DataFrame) -> DataFrame:
    """Train on the documents that aren't held out and score all.

    Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; logarithms to base 10. Null and empty
    texts are one token, the end. Repeated doc_ids are documents of their own. Without training documents the model knows no
    token and its score is the base score, 0. Further columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    learnt = rows.filter("not held_out")
    counts, counts_path = stored(count_words(learnt, END), "counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    usual = counts.filter(F.col("c") >= COUNT)
    common = ((F.col("c") >= COUNT) & frequent(usual, VOCABULARY)) | (F.col("word") == F.lit(END))
    kind = (F.crc32(F.expr("substring(word, -2)")) % SHAPES + TOP_WORDS).cast("int")
    rare = np.ones(CLASSES)
    for r in counts.filter(~common).groupBy(kind.alias("class")).agg((F.sum("c") + F.count("*")).alias("n")).collect():
        rare[r["class"]] += r["n"]
    head = counts.filter(common).toArrow()
    words, often = [bytes(w) for w in head["word"].to_pylist()], head["c"].to_numpy()
    order = sorted(range(len(words)), key=lambda k: (-often[k], words[k]))
    shared = sc.broadcast(Lexicon([words[k] for k in order], often[order], rare, int(tokens), int(distinct)))
    cells = learnt.select("text").mapInArrow(lambda b: tidied(_triples(shared, b)), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    start = train(cells["cell"].to_numpy().astype(np.int64), cells["n"].to_numpy())
    if not distinct:
        words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        return rows.select("doc_id", "held_out", (words + 1).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    model = sc.broadcast((fit(learnt.select("text"), shared, start), start.table()))
    schema = "uid long, doc_id long, salt int, word binary, class int, times long, n_tokens long, n_known long, base_score double, score double"
    part = rows.select("uid", "doc_id", "text").mapInArrow(lambda b: tidied(_score(shared, model, b)), schema)
    least = counts.select("word", F.lit(0).alias("salt"), "c")
    totals = F.lit(rare.tolist())[F.col("class")]
    more = F.coalesce("c", F.lit(0)) + 1
    joined = part.join(least, ["word", "salt"], "left").select(
        "uid", "doc_id", "n_tokens",
        F.when(F.col("word").isNull(), F.col("n_known")).otherwise(F.col("times") * F.col("c").isNotNull().cast("long")).alias("n_known"),
        F.when(F.col("word").isNull(), F.col("base_score")).otherwise(F.col("times") * F.log10(more / F.lit(float(tokens + distinct + 1)))).alias("base_score"),
        F.when(F.col("word").isNull(), F.col("score")).otherwise(F.col("times") * F.log10(more / totals)).alias("score"),
    )
    by_doc = joined.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return by_doc.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", F.coalesce("n_known", F.lit(0)).cast("long").alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score")
