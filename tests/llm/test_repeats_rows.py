"""How many rows the search for repeats makes where groups of copies are large, and its results there against brute force."""

import collections
import hashlib

import pytest

from adlark.llm import repeats


def near_copies(n):
    base = [hashlib.md5(str(k).encode()).hexdigest()[: 3 + k % 7] for k in range(420)]
    for k in range(n):
        words = list(base)
        words[k * len(base) // n] = f"w{k}"
        yield " ".join(words)


def brute(texts):
    raw = [t.encode() for t in texts]
    seen = collections.Counter(b[k : k + 400] for b in raw for k in range(len(b) - 399))
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        yield hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()


@pytest.fixture
def counted(monkeypatch):
    rows, whole = collections.defaultdict(int), repeats.stored

    def stored(df, name, *more):
        out = whole(df, name, *more)
        rows[name] += out[0].count()
        return out

    monkeypatch.setattr(repeats, "stored", stored)
    return rows


def table(spark, path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_runs_leave_not_phrases(spark, tmp_path, counted):
    shared = " ".join(hashlib.md5(str(k).encode()).hexdigest() for k in range(200))
    texts = [f"{hashlib.sha256(str(k).encode()).hexdigest()} {shared} {k}" for k in range(60)]
    got = {r.doc_id: r.kept_sha256 for r in repeats.removed(table(spark, tmp_path / "d", texts), 51).collect()}
    assert [got[k] for k in range(len(texts))] == list(brute(texts))
    assert counted["phrases"] and counted["starts"] <= 6 * len(texts)  # bytes and words, whole phrases and edges


@pytest.mark.parametrize("hot", [1, 8, 10_000])
def test_hot_seeds_make_few_rows(spark, tmp_path, counted, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = [*near_copies(80), "x" * 900, "ab" * 500]
    got = {r.doc_id: (r.kept_sha256, r.n_passages) for r in repeats.removed(table(spark, tmp_path / "d", texts), 51).collect()}
    assert [got[k][0] for k in range(len(texts))] == list(brute(texts))
    if hot == 8:
        assert counted["finer"] and max(counted["finer"], counted["names"]) < 5 * counted["edges"]


def test_hot_seeds_give_the_same_passages(spark, tmp_path, monkeypatch):
    docs = table(spark, tmp_path / "d", [*near_copies(80), "x" * 900])
    want = sorted(map(tuple, repeats.removed(docs, 51).collect()))
    for hot in (1, 8):
        monkeypatch.setattr(repeats, "HOT", hot)
        assert sorted(map(tuple, repeats.removed(docs, 51).collect())) == want
