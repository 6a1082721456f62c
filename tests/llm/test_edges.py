"""Nulls in every column, repeated rows, ties, empty tables and further columns with names used inside, for each operator's query."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlark.llm import ann, bitpack, bpe, flac, lm, neardup, packing, pii, repeats

PASSAGE = " ".join(f"word{k}" for k in range(120))
ROWS = [(1, PASSAGE), (1, PASSAGE), (2, None), (None, PASSAGE + " tail"), (None, None), (3, ""), (4, "x" * 70_000), (5, "\ta \n"), (6, "tél 10.0.0.1")]
CLASHES = ["uid", "_text", "bin", "ids", "media", "word", "c", "seed", "comp", "rep", "bands", "salt", "score", "n_bytes", "part", "code", "asked", "key"]


def public(name):
    import public_tokenizers

    return public_tokenizers.path(name)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    for k, c in enumerate(CLASHES):
        docs = docs.withColumn(c, F.lit("own") if k % 2 else F.lit(None).cast("string"))
    path = str(tmp_path_factory.mktemp("odd") / "d")
    docs.write.parquet(path)
    return spark.read.parquet(path)


def ids_of(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


WANT = sorted((i for i, _ in ROWS), key=str)


def test_repeats(odd):
    got = repeats.removed(odd, repeats.PASSAGE)
    assert ids_of(got) == WANT
    for r in got.collect():
        whole = r.doc_id == 1
        assert (r.n_passages > 0) == (whole or (r.doc_id is None and r.n_bytes > 0))
        if whole:
            assert r.n_removed == r.n_bytes == len(PASSAGE) and r.kept_sha256 == hashlib.sha256(b"").hexdigest() and r.n_spans == 1
    assert repeats.removed(odd.limit(0), repeats.PASSAGE).count() == 0


def test_near_duplicates(odd):
    got = neardup.near_duplicates(odd)
    assert ids_of(got) == WANT and all(r.component_id == r.doc_id for r in got.collect() if r.doc_id is not None)


def test_packing(odd):
    got = packing.pack(odd, public("word_bpe_49k.json"))
    assert sorted((r.doc_id for r in got.filter("start = 0").collect()), key=str) == WANT


def test_bit_packed_files(odd, tmp_path):
    shards = bitpack.write_shards(odd, public("byte_bpe_50k.json"), folder=str(tmp_path / "s"))
    files = shards.collect()
    assert sum(f.n_docs for f in files) == len(ROWS)
    got = bitpack.read_index(shards).collect()
    assert sorted((r.doc_id for r in got), key=str) == WANT
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, _ in ROWS), key=lambda i: -1 if i is None else i)
    for f in files:  # each file alone holds what its tables say
        data = open(f.path, "rb").read()
        assert len(data) == f.n_bytes and len(bitpack.unpack(data)) == f.n_ids
        with bitpack.Shard(f.path) as s:
            assert (s.ids(1, 5000) == bitpack.unpack(data)[1:5000]).all()


@pytest.mark.parametrize("bits", [7, 13, 16])
def test_ranges_of_a_file(tmp_path, bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 5000).astype(np.uint32)
    path = str(tmp_path / "one.abp")
    bitpack.write_file(path, bitpack.pack([4, None], np.array([0, 10, 5000]), ids, bits, 100))
    with bitpack.Shard(path) as s:
        for a, b in ((0, 5000), (95, 305), (4990, 9000), (7, 7), (4999, 5000)):
            assert (s.ids(a, b) == ids[a:b]).all()


def test_media(odd):
    media = flac.store(odd)
    got = flac.digests(media).collect()
    assert sorted((r.doc_id for r in got), key=str) == WANT
    for r in got:
        text = next((t or "").encode() for i, t in ROWS if i == r.doc_id and len((t or "").encode()) == r.n_bytes)
        data = flac.payload(text)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-32:]), None)
        x = np.frombuffer(data, np.uint8).astype(int) - 128
        assert r.feature == f"mean_abs={np.abs(x).sum() / len(x):.4f};crossings={((x[1:] < 0) != (x[:-1] < 0)).sum()};peak={np.abs(x).max()};seconds={len(x) / flac.RATE:.3f}"
        assert r.n_pcm_blocks == -(-len(data) // flac.PCM_BLOCK)
    for r in media.collect():
        assert r.media == flac.encode_many([flac.payload(next((t or "").encode() for i, t in ROWS if i == r.doc_id and len((t or "").encode()) == r.n_bytes))])[0]


def test_damaged_media(spark):
    good = flac.encode_many([flac.payload(PASSAGE.encode())])[0]
    rows = [(1, 1, good), (2, 1, good[:60]), (3, 1, b"other"), (4, 1, good[:-3] + b"abc"), (5, 1, good[:20]), (6, 1, good)]
    media = spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")
    got = {r.doc_id: r for r in flac.digests(media).collect()}
    assert [got[k].error is None for k in range(1, 7)] == [True, False, False, False, False, True]
    assert got[2].payload_sha256 is None and got[1].payload_sha256 == got[6].payload_sha256
    blocks = flac.pcm_blocks(media).collect()
    assert {r.doc_id for r in blocks if r.error} == {2, 3, 4, 5}
    own = sorted((r for r in blocks if r.doc_id == 1), key=lambda r: r.block)
    joined = np.frombuffer(b"".join(r.pcm for r in own), np.int8).astype(np.int16) + 128
    assert joined.astype(np.uint8).tobytes() == flac.payload(PASSAGE.encode())
    assert [r.first_sample for r in own] == [k * flac.PCM_BLOCK for k in range(len(own))]


def test_linear_predictors():
    """The encoder uses linear predictors, and both decoders read them."""
    noise, x = np.random.default_rng(1).normal(0, 3, 576 * 20), np.zeros(576 * 20)
    for k in range(3, len(x)):
        x[k] = 1.1 * x[k - 1] - 0.9 * x[k - 2] + 0.4 * x[k - 3] + noise[k]
    data = np.clip(np.rint(x) + 128, 0, 255).astype(np.uint8).tobytes()
    media = flac.encode_many([data])[0]
    info = flac.metadata(media)
    kinds = {media[info["body"] + int(at) + 6] for at in info["seek"]["offset"]}
    assert flac.LPC_KIND in kinds and len(media) < 0.7 * len(data)
    for x in (flac.decode(media)[0], flac.decode_many([media])[0]):
        assert (x[0] + 128).astype(np.uint8).tobytes() == data
    assert (flac.read_samples(media, 1000, 900)[0] + 128).astype(np.uint8).tobytes() == data[1000:1900]


def test_byte_pairs(odd):
    got = bpe.round_trip(odd, public("byte_bpe_multi_50k.tiktoken"))
    assert ids_of(got) == WANT
    for r in got.collect():
        texts = {hashlib.sha256((t or "").encode()).hexdigest() for i, t in ROWS if i == r.doc_id}
        assert r.decoded_sha256 in texts


def test_pseudonyms(odd, spark):
    got = pii.pseudonymise(odd, "a key")
    assert ids_of(got) == WANT
    assert pii.pseudonymise(odd.limit(0), "a key").count() == 0


def test_language_model(odd, spark):
    got = lm.score(odd)
    assert ids_of(got) == WANT
    n = {5: 2, 3: 1, 2: 1, 1: 121}
    assert all(r.n_tokens == n.get(r.doc_id, r.n_tokens) for r in got.collect())
    out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    held = lm.score(spark.createDataFrame([(out[0], "\ta"), (out[1], "a b\n"), (out[2], None)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in held} == {out[0]: (True, 2, 0, 0, 0.0), out[1]: (True, 3, 0, 0, 0.0), out[2]: (True, 1, 0, 0, 0.0)}


def test_plain_forward_pass():
    """Scores of the model against a softmax over whole levels, one token at a time."""
    words = [lm.END, *(f"w{k}ing".encode() for k in range(400))]
    lex = lm.Lexicon(words, np.arange(401, 0, -1) + lm.COUNT, np.ones(lm.CLASSES), 4000, 401)
    t = lm.Tables.first(lex, lm.train(np.zeros(0, np.int64), np.zeros(0, np.int64)))
    rng = np.random.default_rng(1)
    t.rows[:] += rng.normal(0, 0.5, t.rows.shape)
    n = len(lex.kind)
    before, last, unit = (rng.integers(0, n, 200) for _ in range(3))
    got = t.log10(lex, before, last, unit)
    for k in range(200):
        h = np.append(t.t[0] * t.r[last[k]] + t.t[1] * t.r[before[k]], 1.0).astype(np.float64)
        total = 0.0
        for level, at in enumerate((lex.kind[unit[k]], lex.group[unit[k]], unit[k])):
            parent = lex.levels()[level][0]
            siblings = np.flatnonzero(parent == parent[at])
            s = t.q(level)[siblings].astype(np.float64) @ h
            total += t.q(level)[at].astype(np.float64) @ h - np.log(np.exp(s).sum())
        assert got[k] == pytest.approx(total / np.log(10), abs=1e-3)


def brute(vectors, k):
    out = {}
    for i, v in vectors:
        if i % 20 == 0:
            near = sorted((-float(np.dot(v, w)), j) for j, w in vectors if j != i)[:k]
            out[i] = [j for _, j in near]
    return out


def test_vectors_over_several_blocks(spark, monkeypatch):
    """Recall against brute force with many small blocks, and every score exact."""
    monkeypatch.setattr(ann, "ROWS", 150)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    x = centre[rng.integers(0, 12, 900)] + 0.5 * rng.normal(size=(900, 16))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    want = brute(list(enumerate(x)), 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    assert all(s == pytest.approx(float(x[q] @ x[j]), rel=1e-12) for q, v in got.items() for j, s in v.items())


@pytest.mark.parametrize("rows", ["clusters", "close", "heavy", "ties"])
def test_vectors_that_codes_do_not_tell_apart(spark, rows, monkeypatch):
    """More near rows than a shortlist holds: the lists are those of brute force all the same, for each query."""
    monkeypatch.setattr(ann, "PARALLEL_ROWS", 700)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(4, 32))
    x = centre[rng.integers(0, 4, 1600)] + (0.1 if rows == "clusters" else 1e-4) * rng.normal(size=(1600, 32))
    if rows == "heavy":
        x = rng.normal(size=(1600, 32)) * rng.pareto(1.0, size=(1600, 1)) * np.geomspace(1, 1e-3, 32)
    if rows == "ties":
        x = np.eye(32)[rng.integers(0, 3, 1600)] + np.eye(32)[rng.integers(0, 32, 1600)]
    x = x.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    scores = {q: np.cumsum(x * x[q], axis=1)[:, -1] for q in range(0, 1600, 20)}
    assert got == {q: [int(j) for j in np.lexsort((np.arange(1600), -s)) if j != q][:20] for q, s in scores.items()}


def test_odd_vectors(spark):
    one, two, nan, inf = [1.0, 0.0, 2.0, 1e300], [0.5, 0.5, 0.5, 0.5], [float("nan"), 1.0, 1.0, 1.0], [float("inf"), 1.0, 1.0, 1.0]
    rows = [(0, one), (0, one), (None, one), (20, two), (3, two), (4, two), (5, [0.0] * 4), (6, nan), (7, inf), (8, None), (9, [None, 1.0, 1.0, 1.0]), (10, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k, c in enumerate(CLASHES):
        df = df.withColumn(c, F.lit("own") if k % 2 else F.lit(None).cast("string"))
    got = {(r.query_id, r.rank): r.vec_id for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1): 3, (0, 2): 4, (0, 3): 20, (20, 1): 0, (20, 2): 3, (20, 3): 4}
    assert ann.nearest(df.filter("vec_id in (5, 6)"), F.col("vec_id") % 20 == 0).count() == 0


def test_words_of_a_slice():
    from adlark.llm.pieces import encoder
    from adlark.llm.words import words_of

    texts = [f"Word{k} two\tthree  {k}\n" * (k % 7) for k in range(300)]
    long = pa.array(texts)
    for part in (long.slice(100, 50), pa.record_batch([long], names=["t"]).slice(100, 50).column("t").cast(pa.large_string())):
        bounds, index, vocab = words_of(part)
        got = [[vocab[i].as_py().decode() for i in index[a:b]] for a, b in zip(bounds, bounds[1:])]
        assert got == [t.lower().split() for t in texts[100:150]]
        e = encoder(public("byte_bpe_50k.json"))
        a, b = e.encode(part), e.encode(pa.array(texts[100:150]))
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_words_by_their_bytes():
    """The words of the passage search are those of the contract."""
    texts = ["", " ", "a", " A b\tc\x0b\x0cd\r\ne ", "é É x" * 3, "x" * 50, "\x1c one\x85two"]
    for t in texts:
        start, end = repeats.word_spans(np.frombuffer(t.encode(), np.uint8))
        words = [t.encode()[a:b] for a, b in zip(start, end)]
        import re

        assert words == re.findall(rb"[^\x20\x09-\x0D]+", t.encode())
        assert len(repeats.coded(t.encode())) == 8 * len(words)
    raw = [t.encode() for t in texts]
    assert [x.tobytes() for x in repeats._coded_all(raw)] == [repeats.coded(t) for t in raw]
    assert repeats.coded(b"One two ONE") == repeats.coded(b"one  Two\none")


def test_packing_takes_the_cheapest_sequence_with_room():
    """The plan against a walk that looks at every sequence each time."""
    rng = np.random.default_rng(8)
    for trial in range(40):
        sizes = rng.integers(0, 40 if trial % 2 else 12, rng.integers(0, 60))
        capacity, cost = 16, lambda n: n + n * n / 16
        rest = [(int(n) % capacity, d) for d, n in enumerate(sizes) if n % capacity]
        total = sum(n for n, _ in rest)
        room = [capacity] * (total // capacity) + [b for b in (16, 8, 4, 2, 1) if total % capacity & b]
        used, spent, want, left = [0] * len(room), [0.0] * len(room), {}, []
        for n, d in sorted(rest, key=lambda x: (-x[0], x[1])):
            fits = [s for s in range(len(room)) if room[s] - used[s] >= n]
            if fits:
                s = min(fits, key=lambda s: (spent[s], s))
                want[d], used[s], spent[s] = (s, used[s]), used[s] + n, spent[s] + cost(n)
            else:
                left.append(d)
        got = packing.plan(sizes, capacity)
        full = sum(int(n) // capacity for n in sizes)
        ends = {d: (s - full, at) for d, start, n, s, at in got if s >= full and start == sizes[d] // capacity * capacity and n == sizes[d] % capacity}
        assert all(ends[d] == x for d, x in want.items())
        held = np.zeros((full + len(room), capacity), int)
        for d, start, n, s, at in got:
            held[s, at : at + n] += 1
        assert held.max(initial=0) <= 1 and held.sum() == sizes.sum()
        assert all(held[full + s, : room[s]].all() and not held[full + s, room[s] :].any() for s in range(len(room)))
        assert {d for d, *_ in got if d in left} == set(left)
