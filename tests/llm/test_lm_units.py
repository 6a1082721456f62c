"""The vocabulary of operator 10 grows with the corpus, and its passes read all tokens."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlark.llm import lm


class Held:
    def __init__(self, value):
        self.value = value


def lexicon(n):
    words = [lm.END, *(f"w{k}ing".encode() for k in range(n))]
    return lm.Lexicon(words, np.arange(n + 1, 0, -1) + lm.COUNT, np.ones(lm.CLASSES), 10 * n, n + 1)


@pytest.mark.parametrize("n", [3, 300, 3000])
def test_all_frequent_words_have_vectors_and_sum_to_one(n):
    lex = lexicon(n)
    assert len(set(lex.units([f"w{k}ing".encode() for k in range(n)]))) == n  # equal endings, units of their own
    assert set(lex.units([b"rareing", b"othering"])) == {lex.backed[lm.shape(b"ing")]}
    t = lm.Tables.first(lex, lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    t.rows[:] += np.random.default_rng(1).normal(0, 0.5, t.rows.shape)
    units = np.arange(len(lex.kind))
    empty = np.setdiff1d(np.arange(lm.CLASSES), lex.kind)  # classes of no word, with fewer words than classes
    for a, b in ((0, 1), (len(units), len(units))):
        p = 10 ** t.log10(lex, np.full(len(units), a), np.full(len(units), b), units)
        x = t.hidden(np.array([a]), np.array([b]))[0] @ t.q(0).T
        assert p.sum() + (np.exp(x) / np.exp(x).sum())[empty].sum() == pytest.approx(1, abs=1e-4)


def test_a_pass_reads_every_token():
    lex = lexicon(300)
    rows = lm.Tables.first(lex, lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64))).rows
    texts = [" ".join(f"w{(k * j) % 300}ing" for k in range(700)) for j in range(1, 8)]
    out = pa.Table.from_batches(lm._pass(Held(lex), Held(rows), 0, iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
    ids, n = (np.frombuffer(b"".join(out[c].to_pylist()), np.int64) for c in ("id", "n"))
    contexts = n[ids <= len(lex.kind)].sum()
    assert contexts == 2 * 7 * 701  # each token has two


def test_words_with_equal_endings_are_told_apart(spark):
    pairs = [f"a{k}xyz b{k}xyz" for k in range(150)]
    rng = np.random.default_rng(2)
    texts = [" ".join(pairs[k] for k in rng.integers(0, 150, 300)) for _ in range(160)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    r = lm.score(docs).filter("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert r[0] > r[1] + 0.3
