"""Stages of the corpus pipeline against brute force, each on its own input, and odd rows and columns through all of them."""

import collections
import re
import zlib

import numpy as np
import public_tokenizers as public
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adlark.llm import quality

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").encode().lower().split()
    return set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


def least_of_groups(texts):
    """The ids that stay: the least of each group linked at a similarity of 0.75."""
    s, parent, at = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}, collections.defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in s.items():
        for g in x:
            at[g].append(i)
    for a, b in {(a, b) for ids in at.values() for a in ids for b in ids if a < b}:
        if 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i for i in texts if root(i) == i}


def without_repeats(texts):
    """What strings of 400 bytes and passages of over 50 words that start twice leave of each text."""
    raw = {i: (t or "").encode() for i, t in texts.items()}
    seen = collections.Counter(b[k : k + 400] for b in raw.values() for k in range(len(b) - 399))
    at = {i: [(m.group().lower(), *m.span()) for m in re.finditer(rb"[^\x09-\x0d ]+", b)] for i, b in raw.items()}
    key = lambda w, k: tuple(x[0] for x in w[k : k + 51])
    often = collections.Counter(key(w, k) for w in at.values() for k in range(len(w) - 50))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = True
        for k in range(len(at[i]) - 50):
            if often[key(at[i], k)] > 1:
                gone[at[i][k][1] : at[i][k + 50][2]] = True
        out[i] = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    return out


def texts_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, made = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        made[name] = docs, spark.read.parquet(path)
        docs = made[name][1]
        assert name == "packing" or docs.columns == columns
    before, after = made["quality"]
    kept = {r.doc_id for r in quality.score(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.kept}
    assert set(texts_of(after)) == kept
    clean = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 and toxic = 0").select("doc_id")
    assert after.join(clean, "doc_id").count() >= 0.95 * clean.count()
    before, after = made["near_duplicates"]
    all_ = texts_of(before)
    stay = least_of_groups(all_)
    assert texts_of(after) == {i: t for i, t in all_.items() if i in stay}
    before, after = made["repeats"]
    assert {i: t or "" for i, t in texts_of(after).items()} == without_repeats(texts_of(before))
    before, after = made["personal_data"]
    old, new = texts_of(before), texts_of(after)
    assert set(old) == set(new)
    assert all(old[i] == new[i] for i in old if not any(c.isdigit() or c == "@" for c in old[i] or ""))
    before, after = made["packing"]
    t = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x in texts_of(before).items()}
    held = collections.Counter()
    for r in sorted(after.collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == held[r.doc_id] and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        held[r.doc_id] += r.length
    assert held == {i: len(x) for i, x in ids.items()}


CLASHES = ["_text", "_weight", "_key", "_gone", "_runs", "uid", "seed", "rep", "band", "comp", "n_replaced", "bin", "ids", "kept", "c0", "c1"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_columns(spark, tmp_path, name):
    """Nulls in every column, repeated rows, and further columns that bear names used inside."""
    passage = " ".join(f"word{k}" for k in range(120))
    rows = [(1, passage, "en", "s", 9), (1, passage, "en", "s", 9), (2, None, None, None, None), (None, passage + " tail", "en", None, 1), (None, None, None, None, None), (3, "", "", "", 0), (4, "x" * 300_000, "en", "s", 300_000), (5, "tél 10.0.0.1", "fr", "s", 12)]
    docs = spark.createDataFrame(rows, ODD)
    for k, c in enumerate(CLASHES):
        docs = docs.withColumn(c, F.lit(None).cast("string") if k % 2 else F.lit("own"))
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    got = out.collect()
    if name == "packing":
        assert sum(r.length for r in got if r.start == 0) and sum(1 for r in got if r.start == 0) == len(rows)
        return
    assert out.columns == docs.columns
    assert all(r["_text"] == "own" and r["_weight"] is None for r in got)
    if name == "near_duplicates":
        assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    if name in ("repeats", "personal_data"):
        assert len(got) == len(rows)
    if name == "repeats":
        assert [r.text for r in got if r.doc_id == 1] == ["", ""] and [r.text for r in got if r.doc_id == 5] == ["tél 10.0.0.1"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_no_documents(spark, tmp_path, name):
    spark.createDataFrame([], ODD).write.parquet(str(tmp_path / "d"))
    assert dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(str(tmp_path / "d")), SF).count() == 0
