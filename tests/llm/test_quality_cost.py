"""Importance resampling weighs each text once, and hashes words without a step of Python for each distinct one."""

import types
import zlib

import numpy as np
import pyarrow as pa
from test_quality_brute import pairs_of_buckets

from adlark.llm import quality

SF = "/root/testdata/sf0.001"
LONG_WORDS = ["x" * (quality.LONG + 1), "-" * 300 + "É1a" * 100 + "!", "." * 5000]
ODD = [None, "", " \t\n ", "Word, WORD!! word", "--- ... !a! a", "été ÉTÉ 日本, x1y2 \x1c\x7f", "A" * quality.LONG, "  ".join(LONG_WORDS), "last-one"]


def test_features_of_odd_words():
    for texts in (ODD, [None, ""], []):
        for array in (pa.array(texts, pa.string()), pa.array(["before", *texts], pa.large_string()).slice(1)):
            bounds, word, pair = quality.features(array)
            got = [list(zip(word[a:z].tolist(), (pair[a:z] + quality.BUCKETS).tolist())) for a, z in zip(bounds, bounds[1:])]
            assert got == [pairs_of_buckets(t) for t in texts]


def test_crcs():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 4000).astype(np.uint8)
    start = rng.integers(0, 3000, 500)
    end = start + rng.integers(0, 2 * quality.LONG, 500)
    assert quality.crcs(buf, start, end).tolist() == [zlib.crc32(buf[a:z].tobytes()) for a, z in zip(start, end)]
    assert not len(quality.crcs(buf, start[:0], end[:0]))


def test_no_step_of_python_for_each_word(monkeypatch):
    calls = []
    monkeypatch.setattr(quality, "zlib", types.SimpleNamespace(crc32=lambda b: calls.append(1) or zlib.crc32(b)))
    quality.features(pa.array([" ".join(f"Word{i}," for i in range(5000)), "y" * (quality.LONG + 1)]))
    assert len(calls) == 1  # the long word; its shape is short


def test_score_weighs_texts_once(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.score(docs, labels)
    assert "MapInArrow" not in got._jdf.queryExecution().toString()
    assert got.count() == docs.count()
