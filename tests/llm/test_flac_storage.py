"""Operator 7 reads streams back from a table it has written."""

import pyarrow.parquet as pq

from adlark.llm import flac, queries

SF = "/root/testdata/sf0.001"


def test_streams_are_written_and_read_again(spark):
    out = queries.op7_flac_round_trip(spark, SF)
    files = [f.removeprefix("file:") for f in out.inputFiles()]
    assert files and all("adlark-media-" in f for f in files)
    media = {r["doc_id"]: r["media"] for f in files for r in pq.read_table(f.replace("//", "/")).to_pylist()}
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(media) == set(docs) and all(m[:4] == b"fLaC" for m in media.values())
    assert all(r.payload_bytes == len(flac.payload(docs[r.doc_id])) for r in out.collect())
