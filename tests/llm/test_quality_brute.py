"""Weights, keys and the kept rows of importance resampling against plain Python."""

import collections
import itertools
import math
import zlib

import pytest
from pyspark.sql import functions as F

from adlark.llm import quality

SF = "/root/testdata/sf0.001"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def kind(word):
    out = ["a" if "a" <= chr(b) <= "z" or b > 127 else "A" if "A" <= chr(b) <= "Z" else "0" if "0" <= chr(b) <= "9" else chr(b) for b in word.encode()]
    return "".join(c for c, _ in itertools.groupby(out))


def lowered(word):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in word.encode()).strip(MARKS.encode())


def pairs_of_buckets(text):
    """Word bucket and shape-pair bucket of each word."""
    out, before = [], quality.SHAPES
    for word in [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]:
        shape = zlib.crc32(kind(word).encode()) % quality.SHAPES
        out.append((zlib.crc32(lowered(word)) % quality.BUCKETS, quality.BUCKETS + (before * 31 + shape) % quality.BUCKETS))
        before = shape
    return out


def model_counts(docs):
    seen, texts = collections.Counter(), collections.Counter()
    for buckets in docs:
        flat = [b for pair in buckets for b in pair]
        seen.update(flat)
        texts.update(set(flat))
    return seen, texts


def ratio(target, raw, prior):
    size = lambda c, high: sum(n for b, n in c.items() if (b >= quality.BUCKETS) == high)
    t, r = [size(target, h) for h in (False, True)], [size(raw, h) for h in (False, True)]
    return {b: math.log((target[b] + prior) / (raw[b] / r[b >= quality.BUCKETS] * t[b >= quality.BUCKETS] + prior)) for b in raw}


@pytest.mark.parametrize("k", [None, 50])
def test_against_brute_force(spark, k):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(17), "doc_id", F.coalesce("text", F.lit(""))), 11) + 0.5) / 2**53
    rows = {r.doc_id: (r.text, r.unit, r.learn) for r in docs.select("doc_id", "text", unit.alias("unit"), (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(2)) == 0).alias("learn")).collect()}
    marks = {r.doc_id: r.quality == 1 and not r.toxic for r in labels.collect() if r.doc_id in rows}
    features = {i: pairs_of_buckets(t) for i, (t, _, _) in rows.items()}
    target = model_counts(features[i] for i, good in marks.items() if good and rows[i][2])
    raw = model_counts(features.values())
    by_feature, by_text = ratio(target[0], raw[0], quality.PRIOR), ratio(target[1], raw[1], quality.TEXT_PRIOR)
    whole = {i: sum(by_feature[b] for pair in x for b in pair) for i, x in features.items()}
    weakest = {}
    for i, x in features.items():
        each = [by_text[a] + by_text[b] for a, b in x]
        n = quality.PASSAGE
        weakest[i] = min((sum(each[p : p + n]) for p in range(len(each) - n + 1)), default=sum(each))
    held = [(i, g) for i, g in marks.items() if not rows[i][2]]

    def best_cuts(w):
        values = sorted({w[i] for i, _ in held})
        cuts = [values[0] - 1, *((a + b) / 2 for a, b in zip(values, values[1:])), values[-1] + 1]
        n = {g: sum(x == g for _, x in held) for g in (True, False)}
        errors = [10 * sum(w[i] < c for i, g in held if g) / n[True] + sum(w[i] >= c for i, g in held if not g) / n[False] for c in cuts]
        best = [c for c, e in zip(cuts, errors) if e <= min(errors) + 1e-9]
        return best[len(best) // 2]

    cut = best_cuts(whole)
    shift = cut - best_cuts(weakest)
    got = {r.doc_id: r for r in quality.score(docs, labels, k).collect()}
    weight = {i: min(whole[i], weakest[i] + shift) for i in rows}
    key = {i: weight[i] - math.log(-math.log(rows[i][1])) for i in rows}
    for i, r in got.items():
        assert r.log_weight == pytest.approx(weight[i], abs=2e-3) and r.gumbel_key == pytest.approx(key[i], abs=2e-3)
    n = k or sum(w >= cut for w in weight.values())
    assert {i for i, r in got.items() if r.kept} == set(sorted(key, key=lambda i: -got[i].gumbel_key)[:n])
