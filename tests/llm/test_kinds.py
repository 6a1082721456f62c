"""Phrases of a block are told apart by sorting one hash, not rows of three."""

import numpy as np

from adlark.llm import repeats


def test_kinds():
    rng = np.random.default_rng(1)
    for first in (1 << 60, 50):  # a name that tells all apart, and one that doesn't
        some = [rng.integers(0, k, 300) for k in (first, 1 << 60, 9)]
        names = [x[rng.permutation(300).repeat(3) % 300] for x in some] if first == 50 else [x.repeat(3)[::-1] for x in some]
        example, kind = repeats.kinds(*names)
        rows = np.stack(names, axis=1)
        assert (rows[example][kind] == rows).all() and len(example) == len(np.unique(rows, axis=0))
    assert [len(x) for x in repeats.kinds(*[np.zeros(0, np.int64)] * 3)] == [0, 0]


def test_order_of_suffixes(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (900, 700, 900)] + [b"abc" * 300]
    real = np.unique
    monkeypatch.setattr(repeats.np, "unique", lambda *a, axis=None, **k: real(*a, **k) if axis is None else 1 / 0)
    size = np.array([len(t) for t in texts])
    places, ends = np.arange(size.sum()), np.repeat(np.cumsum(size), size)
    order, buf = repeats.corpus_order(texts, places)
    suffixes = [buf[p : ends[p]].tobytes() for p in order]
    assert suffixes == sorted(suffixes)
