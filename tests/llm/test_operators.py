"""Each operator against brute force, on texts with copies, near copies, shared passages, nulls and odd characters."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adlark.llm import ann, bitpack, bpe, components, flac, lm, neardup, packing, pii, pieces, quality, repeats

RNG = random.Random(8)
WORDS = ["".join(RNG.choice("abcdefghiklmnoprstuvwé") for _ in range(RNG.randint(2, 9))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def corpus():
    base = [prose(RNG.randint(120, 300)) for _ in range(12)]
    shared = prose(90)
    docs = [*base, base[0], base[0], base[1].replace(" ", "  ", 3), " ".join([*base[2].split()[:-2], "new", "end"]), base[3] + " " + shared, prose(40) + " " + shared + " " + prose(30), "x" * 1500, "ab" * 700]
    docs += [None, "", "  \n\t ", "one two", "a b c d e", "日本語 テスト　x  don't <|endoftext|> É́", "tail ", "card 4111 1111 1111 1111, 4111111111111112; +1 (212) 555-0100 10.0.0.1 300.1.1.1 jo.Doe9@mail.example.com 2024-02-29 2023-02-29 123-45-6789 DE89370400440532013000", "y" * 900 + prose(5)]
    return [(i * 3, t, "en", "s", len(t or "")) for i, t in enumerate(docs)]


ROWS = corpus()
TEXTS = {i: t or "" for i, t, *_ in ROWS}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "d")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    return spark.read.parquet(path)


def words(t):
    return t.encode().lower().split()


def test_repeats(docs, empty):
    raw = {i: t.encode() for i, t in TEXTS.items()}
    seen = collections.Counter(b[k : k + 400] for b in raw.values() for k in range(len(b) - 399))
    for r in repeats.removed(docs).collect():
        b, cut = raw[r.doc_id], bytearray(len(raw[r.doc_id]))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                cut[k : k + 400] = b"\1" * 400
        kept = bytes(x for x, y in zip(b, cut) if not y)
        spans = sum(1 for k, y in enumerate(cut) if y and not (k and cut[k - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    assert repeats.removed(empty).count() == 0
    assert repeats.without_repeats(docs).columns == docs.columns


def test_hot_repeats_are_named(docs, monkeypatch):
    want = {tuple(r) for r in repeats.removed(docs).collect()}
    monkeypatch.setattr(repeats, "HOT", 1)
    assert {tuple(r) for r in repeats.removed(docs).collect()} == want


def test_corpus_order():
    texts = [b"abracadabra" * 6, b"banana bandana" * 5, b"abracadabra" * 3]
    places = np.array([0, 3, 20, 66, 70, 100, 137, 140])
    joined = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    order, _ = repeats.corpus_order(texts, places)
    suffix = [joined[p : ends[np.searchsorted(ends, p, side="right")]] for p in places]
    assert [suffix[k] for k in order] == sorted(suffix)


def sets():
    out = {}
    for i, t in TEXTS.items():
        w = words(t)
        out[i] = set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def test_neardup(docs, empty, spark):
    s, parent = sets(), {i: i for i in TEXTS}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in s:
        for b in s:
            both = len(s[a] & s[b])
            if a < b and both and 100 * both >= 75 * len(s[a] | s[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = neardup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(s[i]), root(i), root(i) == i) for i in TEXTS}
    assert neardup.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, neardup.near_duplicates(odd).select("doc_id", "component_id", "kept").collect()), key=str) == [(1, 1, True), (1, 1, True), (None, None, True)]


def test_estimates():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(both[:2500]), np.unique(both[500:])
    regs = neardup.registers([a, b])
    j, error = neardup.estimates(regs[:1], regs[1:], neardup.octaves([len(a)]), neardup.octaves([len(b)]))
    assert abs(j[0] - 2000 / 3000) < 4 * error[0]


def test_block_links_hub():
    """Members that only a hub joins are found although most of their pairs fail."""
    import pandas as pd

    hub = WORDS[:200]
    texts = [" ".join(hub)] + [" ".join([*hub[: 10 * k], *[f"n{k}{m}" for m in range(12)], *hub[10 * k + 12 :]]) for k in range(1, 12)]
    s = neardup.shingle_sets(pa.array(texts))
    block = pd.DataFrame({"doc_id": range(len(texts)), "comp": range(len(texts)), "text": texts, "regs": [r.tobytes() for r in neardup.registers(s)], "n_shingles": [len(x) for x in s], "i": 0, "j": 0, "side": 0})
    assert len(neardup._link_block(block)) == len(texts) - 1


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.comp for r in components.components(links)[0].collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


@pytest.fixture(scope="module")
def word_ids():
    t = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return {i: np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4") for i, x in TEXTS.items()}


def test_packing(docs, empty, word_ids):
    rows = packing.pack(docs, public.path("word_bpe_49k.json"), group_docs=8).collect()
    at, place, total = collections.Counter(), collections.Counter(), collections.Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = word_ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in word_ids.items()}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == place[r.sequence_id]
        place[r.sequence_id] += r.length
        total[r.sequence_id] += r.length
    assert all(n <= 4096 and n & (n - 1) == 0 for n in total.values())
    assert packing.pack(empty, public.path("word_bpe_49k.json")).count() == 0


def test_plan_balances():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 3000, 300)
    got = packing.plan(sizes)
    room = collections.Counter()
    for _, _, n, s, _ in got:
        room[s] += n
    assert sum(room.values()) == sizes.sum() and all(n & (n - 1) == 0 for n in room.values())
    cost = collections.Counter()
    for _, _, n, s, _ in got:
        cost[s] += packing.cost(n)
    full = [cost[s] for s, n in room.items() if n == 4096]
    assert max(full) < 1.6 * np.mean(full)


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 32])
def test_bits(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 5000, dtype=np.uint32)
    data = bitpack.pack([4, None], np.array([0, 10, 5000]), ids, bits, 100)
    assert (bitpack.unpack(data) == ids).all() and (bitpack.read_range(data, 95, 305) == ids[95:305]).all()


def test_bitpack(docs, empty):
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got, start = {r.doc_id: r for r in bitpack.read_index(bitpack.write_shards(docs, public.path("byte_bpe_50k.json"))).collect()}, 0
    for i, x in sorted(TEXTS.items()):
        ids = np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes())), x
        start += len(ids)
    assert bitpack.read_index(bitpack.write_shards(empty, public.path("byte_bpe_50k.json"))).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces(name):
    e = pieces.PieceEncoder(public.path(name), limit=50)
    texts = list(TEXTS.values()) + ["a\u0085 b\x1c c  ", "ΑΣ ΣΑΣ İx", "123's  we'll"]
    at, ids = e.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [x.ids for x in e.t.encode_batch(texts, add_special_tokens=False)]


def test_bpe(docs, empty):
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.round_trip(docs, path).collect():
        ids = np.array(e.encode_ordinary(TEXTS[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(TEXTS[r.doc_id].encode()).hexdigest()), TEXTS[r.doc_id][:50]
    assert bpe.round_trip(empty, path).count() == 0
    both = bpe.decode(bpe.encode(docs, path), path).collect()
    assert all(bytes(r.decoded) == TEXTS[r.doc_id].encode() for r in both)
    for w in (b"a" * 700, "grüße".encode() * 60, b"ab" * 300):
        assert bpe.merge_long(w, ranks) == e.encode_ordinary(w.decode())


def test_flac_round_trip(docs, empty):
    rows = flac.digests(flac.store(docs)).collect()
    for r in rows:
        p = flac.payload(TEXTS[r.doc_id].encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(TEXTS[r.doc_id].encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert len(rows) == len(ROWS) and flac.digests(flac.store(empty)).count() == 0
    blocks = flac.pcm_blocks(flac.store(docs), block=1000).orderBy("doc_id", "first_sample").collect()
    pcm = collections.defaultdict(bytes)
    for b in blocks:
        pcm[b.doc_id] += bytes(b.pcm)
    assert all(bytes((np.frombuffer(pcm[i], np.int8).astype(int) + 128).astype(np.uint8)) == flac.payload(t.encode()) for i, t in TEXTS.items())


def test_flac_checksums_and_seek():
    p = flac.payload(bytes(RNG.randrange(97, 123) for _ in range(5000)))
    m = flac.encode_many([p])[0]
    x, info = flac.decode(m)
    assert info["samples"] == len(p) and (flac.read_samples(m, 1000, 2000) == x[:, 1000:3000]).all()
    bad = bytearray(m)
    bad[-300] ^= 4
    with pytest.raises(ValueError):
        flac.decode(bytes(bad))
    with pytest.raises(ValueError):
        flac.decode_many([bytes(bad)])
    assert flac.coded_number(0x20AC).decode() == "€"


def test_flac_linear_predictor():
    """A stereo frame by hand: the left channel predicted by a[n-1] * 2 - a[n-2] as LPC, the side channel constant."""
    left = [3, 5, 7, 10, 12, 13, 13, 14, 16, 18, 20, 21, 22, 25, 26, 27]
    bits = "1111111111111000" + "0110" + "0100" + "1000" + "100" + "0" + "00000000" + f"{15:08b}"
    head = int(bits, 2).to_bytes(len(bits) // 8, "big")
    sub = "0" + "100001" + "0" + f"{left[0]:016b}{left[1]:016b}" + f"{3:04b}" + "00000" + "0010" + "1111"
    sub += "00" + "0000" + f"{1:04b}"
    for n in range(2, 16):
        e = left[n] - (2 * left[n - 1] - left[n - 2])
        u = 2 * e if e >= 0 else -2 * e - 1
        sub += "0" * (u >> 1) + "1" + str(u & 1)
    sub += "0" + "000000" + "0" + f"{(1 << 17) - 2:017b}"
    sub += "0" * (-len(sub) % 8)
    frame = head + bytes([flac.crc(head, 8)]) + int(sub, 2).to_bytes(len(sub) // 8, "big")
    frame += flac.crc(frame, 16).to_bytes(2, "big")
    x, end = flac.decode_frame(frame, 0, {"bits": 16})
    assert end == len(frame) and x[0].tolist() == left and x[1].tolist() == [v + 2 for v in left]


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def test_pii(docs, spark):
    import re

    out = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    i, t = next((i, t) for i, t in TEXTS.items() if t.startswith("card"))
    new = out[i].text
    assert out[i].n_replaced == 7 and "4111111111111112" in new and "300.1.1.1" in new and "2023-02-29" in new
    m = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}), \d{16}; \+1 \(([2-9]\d\d)\) ([2-9]\d\d)-\d{4} (\S+) 300.1.1.1 [a-z]{2}\.[A-Z][a-z]{2}\d@mail.example.com (\d{4}-\d\d-\d\d) 2023-02-29 \d{3}-\d\d-\d{4} (DE\d{20})", new)
    assert m and luhn(m[1].replace(" ", "")) and all(int(o) < 256 for o in m[4].split(".")) and int("".join(str(int(c, 36)) for c in m[6][4:] + m[6][:4])) % 97 == 1
    assert all(out[k].text == (None if x is None else x) for k, x, *_ in ROWS if k != i)
    same = pii.pseudonymise(spark.createDataFrame([(1, "a 10.0.0.1 b"), (2, "10.0.0.1"), (3, "10.0.0.2")], "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert same[0].text == f"a {same[1].text} b" and same[1].text != same[2].text != "10.0.0.2"


def test_pii_is_a_permutation(spark):
    c = pii.Cipher("k")
    got = spark.range(63 * 11).select(F.expr(c.number("id", 63, 11, "t"))).collect()
    assert sorted(r[0] for r in got) == list(range(63 * 11))
    got = spark.range(1000).select(F.expr(c.text("lpad(cast(id as string), 3, '0')", "t"))).collect()
    assert len({r[0] for r in got}) == 1000


def test_quality(spark, tmp_path):
    rows = [(i, prose(60) if i % 4 else " | ".join(f"z{RNG.randrange(99)}!!" for _ in range(40)), 1) for i in range(240)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(0, 240) if i % 3]
    spark.createDataFrame(rows, "doc_id long, text string, extra int").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.score(docs, lab).collect()}
    hidden = [i for i in range(240) if i % 3 == 0]
    assert np.mean([got[i] == (i % 4 != 0) for i in hidden]) > 0.9
    assert {r.doc_id for r in quality.resample(docs, lab).collect()} == {i for i, k in got.items() if k}
    assert quality.score(docs, lab.limit(0)).filter("not kept").count() == 0


def test_top_k(spark):
    keys = spark.createDataFrame([(float(x),) for x in np.random.default_rng(2).normal(size=500)], "_key double")
    for k in (1, 7, 250, 499):
        assert keys.filter(F.col("_key") >= quality.top_k(keys, k)).count() == k


def test_lm(docs, empty):
    train = collections.Counter()
    seq = {i: [*words(t), b""] for i, t in TEXTS.items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in TEXTS}
    for i, s in seq.items():
        if not out[i]:
            train.update(s)
    n, v = sum(train.values()), len(train)
    rows = lm.score(docs).collect()
    for r in rows:
        s = seq[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(s), sum(w in train for w in s), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in s)) and r.score <= 0
    assert len(rows) == len(ROWS) and lm.score(empty).count() == 0


def test_lm_is_normalised():
    cells = np.random.default_rng(0).integers(0, (lm.CLASSES + 1) ** 2 * lm.CLASSES, 500)
    model = lm.train(np.unique(cells), np.ones(len(np.unique(cells)), np.int64), steps=20)
    assert np.allclose((10.0 ** model.table().astype(float)).sum(axis=1), 1, atol=1e-4)


def test_ann(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[700:740] = x[5]
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)] + [(3000, None), (3001, [0.0] * 24), (3002, [float("nan")] * 24), (3003, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits, d = 0, x.astype(np.float64)
    for q in range(0, 1500, 20):
        s = d @ d[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        assert all(abs(score - s[v]) < 1e-9 for v, score in got[q])
        hits += len({v for v, _ in got[q]} & set(want.tolist()))
    assert len(got) == 75 and hits / (75 * 20) >= 0.9
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
