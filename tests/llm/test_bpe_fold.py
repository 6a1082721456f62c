"""The fold of operator 9 works on ids: its table of pairs, its state, and pieces that no merges reach."""

import public_tokenizers as public
from pyspark.sql import functions as F

from adlark.llm import bpe

WORDS = ["", "a", "\0", " \0b", "é", "ÿþ", " grüße", "日本語テキスト", "🙂🙃🙂", " " * 50, "\n\n\n", "ab" * 90, " qzxjkvbw", "'s", "x\ty", " internationalisation"]


def encoded(spark, words, ranks):
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, w string")
    return [list(r[0]) for r in rows.orderBy("k").select(bpe.encode_words("array(w)", ranks)[0]).collect()]


def test_table_of_pairs():
    ranks = bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    n, offsets, owned, apart = bpe.pair_table(ranks)
    pairs = {tuple(bpe.merge_long(w, ranks, False)): r for w, r in ranks.items() if len(w) > 1}
    assert not apart and len(pairs) == len(ranks) - 256 and all(len(p) == 2 for p in pairs)
    united = lambda a, b: int(owned[offsets[a] + b]) ^ ((a + bpe.PIECE) << bpe.SHIFT)
    assert all(united(a, b) == r for (a, b), r in pairs.items())
    others = [(a, b) for a in range(0, n + 1, 997) for b in range(n + 1) if (a, b) not in pairs]
    assert all(united(a, b) >= 1 << bpe.SHIFT for a, b in others)


def test_fold_looks_up_ids(spark):
    """A step joins no bytes and takes no CRC-32 of them, which took most of the operator's time."""
    ranks = bpe.read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    assert encoded(spark, WORDS, ranks) == [bpe.merge_long(w.encode(), ranks) for w in WORDS]
    seen = []
    real, F.expr = F.expr, lambda s: seen.append(s) or real(s)
    try:
        bpe.encode_words("array(w)", ranks)
    finally:
        F.expr = real
    assert "crc32(" not in seen[0] and "hex(" not in seen[0]


def test_pieces_apart(spark):
    """A word that is a piece is that piece, even if no merges lead there."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"wxyz": 259}
    assert encoded(spark, ["wxyz", "wxyzz", "abc", "abcbc", "é"], ranks) == [[259], [119, 120, 121, 122, 122], [258], [258, 257], [195, 169]]
