"""Repeated passages of over 50 words in the pipeline, however few bytes they have."""

import collections
import re

import corpus_pipeline

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long"


def words(start, n, size=2):
    return [f"{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{k:0{size - 1}d}" for k in range(start, start + n)]


def test_short_passages_of_over_50_words(spark, tmp_path):
    long, short, upper = " ".join(words(0, 51, 4)), " ".join(words(1000, 50, 4)), " ".join(words(2000, 51, 4))
    assert len(long) < 400
    texts = [f"one {long} two", f"three\n{long}  four", f"five {short} six", f"seven {short} eight", upper, f"nine {upper.upper()} ten", "é " + " ".join(words(3000, 90, 4))]
    spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], ODD).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["repeats"](spark, spark.read.parquet(str(tmp_path / "d")), SF).collect()}
    assert [got[k].text for k in range(7)] == ["one  two", "three\n  four", texts[2], texts[3], "", "nine  ten", texts[6]]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_passages_of_a_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    raw = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    at = {i: [(m.group().lower(), *m.span()) for m in re.finditer(rb"[^\x09-\x0d ]+", t)] for i, t in raw.items()}
    key = lambda w, k: tuple(x[0] for x in w[k : k + 51])
    seen = collections.Counter(key(w, k) for w in at.values() for k in range(len(w) - 50))
    size = collections.Counter(t[k : k + 400] for t in raw.values() for k in range(len(t) - 399))
    want = {}
    for i, t in raw.items():
        gone = bytearray(len(t))
        spans = [(at[i][k][1], at[i][k + 50][2]) for k in range(len(at[i]) - 50) if seen[key(at[i], k)] > 1]
        for a, b in spans + [(k, k + 400) for k in range(len(t) - 399) if size[t[k : k + 400]] > 1]:
            gone[a:b] = b"\1" * (b - a)
        want[i] = bytes(c for c, g in zip(t, gone) if not g).decode("utf-8", "ignore")
    assert {r.doc_id: r.text or "" for r in dict(corpus_pipeline.STAGES)["repeats"](spark, docs, SF).collect()} == want
