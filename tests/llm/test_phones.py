"""Phone numbers get pseudonyms whatever their area and exchange."""

import re

from adlark.llm import pii


def test_phones_of_any_area_code(spark):
    old = ["+1 (017) 555-7713", "+1 (217) 055-7713", "+1 (117) 155-0000", "+1 (217) 555-7713", *(f"+1 ({k:03d}) {k * 7 % 1000:03d}-0001" for k in range(0, 1000, 9))]
    docs = spark.createDataFrame(list(enumerate(old)), "doc_id long, text string")
    new = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    assert all(new[k].n_replaced == 1 and new[k].text != x and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[k].text) for k, x in enumerate(old))
    assert len({r.text for r in new.values()}) == len(old)
    plain = re.compile(r"\+1 \([2-9]..\) [2-9]")
    assert all(bool(plain.match(x)) == bool(plain.match(new[k].text)) for k, x in enumerate(old))
