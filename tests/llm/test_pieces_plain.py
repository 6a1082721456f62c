"""Letters, and letters with marks behind them, are encoded without the vocabulary's pattern."""

import public_tokenizers as public
import pytest

from adlark.llm import pieces

PLAIN = ["word", "Word", "word,", "word.", "WORD!?", "façade", "Été;", "über:", "ª", "naïve..."]
ODD = ["don't", "'s", "a1", "12", "a\u0085b", "İx", "İ,", ",", "", "a\nb", "a.\nB", "x--", "(word)", "\x1cword", "ÿ,\tz", ",word", "ſ", "ǅ."]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_parts(name):
    e, searched = pieces.PieceEncoder(public.path(name)), []
    find = e.find
    e.find = lambda w: searched.append(w) or find(w)
    for w in PLAIN + ODD:
        for part in (w, " " + w):
            for _ in range(2):  # met for the first time, and again
                want = e.t.encode(part, add_special_tokens=False).ids
                assert [int.from_bytes(x, "little") for x in map(bytes, zip(*[iter(e.part(part))] * 4))] == want, part
            if e.by_word:
                break
    assert not {w.strip(" ").lower() for w in searched} & {w.lower() for w in PLAIN}
