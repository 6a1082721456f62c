"""A step of the language model's pass: whole rows are gathered, and no tiny matrix products are made for each token."""

import numpy as np

from adlark.llm import lm


def test_step(monkeypatch):
    words = [b"w%d" % k for k in range(2000)]
    count = np.arange(2000, 0, -1) + 4
    lex = lm.Lexicon(words, count, np.ones(lm.CLASSES), int(count.sum()), 2000)
    cells = np.arange(50) * lm.CLASSES
    rows = lm.Tables.first(lex, lm.train(cells, np.ones(50, np.int64), steps=20)).rows
    rng = np.random.default_rng(3)
    before, last = rng.integers(0, len(lex.kind), (2, 4096))
    unit = (last * 7 + 1) % len(lex.kind)  # what follows hangs on the last word
    made = lm.Trainer(lex, rows, 0)
    gain = lambda t: t.log10(lex, before, last, unit).mean()
    was = gain(made.t)
    with monkeypatch.context() as m:
        m.setattr(lm.np, "matmul", None)
        for _ in range(30):
            made.step(before, last, unit)
    assert gain(made.t) > was + 0.1 and np.isfinite(made.t.rows).all()
    assert (rows == lm.Tables.first(lex, lm.train(cells, np.ones(50, np.int64), steps=20)).rows).all()
