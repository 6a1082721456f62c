"""Hand-computed cases, invariants, and a sample of queries against SQL on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from adlark.functions import exprs
from adlark.operators import candidates, evaluation, features, ranking
from adlark.sources import sinks, tables

DAY = dt.date(2024, 1, 20)
TABLES = "region nation customer supplier part orders lineitem events".split()


def one(spark, expr, value):
    return spark.range(1).select(expr(F.lit(value))).first()[0]


def test_weights(spark):
    kinds = ["view_phone", "contact_chat", "contact_zalo", "contact_sms", "other_interaction", "pageview", None]
    df = spark.createDataFrame([(k,) for k in kinds], "event_type string")
    assert df.agg(F.sum(exprs.event_weight(F.col("event_type")))).first()[0] == 13.0


def test_tiers_and_labels(spark):
    assert [one(spark, exprs.recency_tier, d) for d in (3, 4, 7, 8, 14, 15, 30, 31, 180, 181, None, -2)] == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 0]
    assert [one(spark, exprs.graded_label, x) for x in (0.0, 1.0, 2.9, 3.0, 5.9, 6.0)] == [0, 1, 1, 2, 2, 3]


def test_wilson(spark):
    low, high = spark.range(1).select(exprs.wilson(F.lit(5), F.lit(10), False), exprs.wilson(F.lit(5), F.lit(10), True)).first()
    assert round(low, 4) == 0.2366 and round(high, 4) == 0.7634
    assert spark.range(1).select(exprs.wilson(F.lit(0), F.lit(0), True)).first()[0] is None


def test_dwell(spark):
    got = [one(spark, exprs.dwell_valid, d) for d in (0.0, 29.9, 30.0, 3599.0, 3600.0, None)]
    assert got == [None, 29.9, 30.0, 3599.0, None, None]


@pytest.mark.parametrize("values, want", [([1, 1, 1, 1], 0.0), ([0, 0, 0, 1], 0.75), ([1, 2, 3], 2 / 9), ([0, 0], 0.0)])
def test_gini(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert evaluation.gini(df, "v").first()["gini"] == pytest.approx(want, abs=1e-6)


def test_reengagement_decay(spark):
    rows = [(1, 1, DAY - dt.timedelta(14), 4.0), (1, 2, DAY - dt.timedelta(28), 4.0), (1, 3, DAY, 9.0)]
    got = {r.item_id: r.source_score for r in candidates.reengagement(spark.createDataFrame(rows, "user_id long, item_id long, date date, weighted_score double")).collect()}
    assert got == {1: 2.0, 2: 1.0}


def test_covisit(spark):
    d = DAY - dt.timedelta(1)
    rows = [(1, 1, d, 3.0), (1, 2, d, 1.0), (2, 1, d, 1.0), (2, 2, d, 1.0), (2, 3, d, 3.0)]
    got = {(r.item_a, r.item_b): (r.edge_weight, r.n_co_users) for r in candidates.covisit_matrix(spark.createDataFrame(rows, "user_id long, item_id long, date date, weighted_score double")).collect()}
    assert got == {(1, 2): (4.0, 2), (2, 1): (4.0, 2)}


def test_merge_keeps_best(spark):
    schema = "user_id long, item_id long, source string, source_score double"
    a = spark.createDataFrame([(1, 1, "a", 5.0), (1, 2, "a", 10.0)], schema)
    b = spark.createDataFrame([(1, 1, "b", 1.0)], schema)
    got = {r.item_id: (r.source, r.candidate_score) for r in candidates.merge([a, b]).collect()}
    assert got[1] == ("b", 1.0)


def dim(spark, rows):
    return spark.createDataFrame(rows, "item_id long, seller_id long, seller_type string, posted_date date")


def test_soft_cap(spark):
    old = DAY - dt.timedelta(100)
    scored = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.9), (1, 3, 0.8), (1, 4, 0.5)], "user_id long, item_id long, pred_score double")
    got = ranking.rerank_health(scored, dim(spark, [(1, 1, "agent", old), (2, 1, "agent", old), (3, 1, "agent", old), (4, 2, "agent", old)])).orderBy("rank").collect()
    assert [r.item_id for r in got] == [1, 2, 4, 3] and got[-1].final_score == 0.4


def greedy(items, k, cap, pct, pool=30):
    """The walk that the windows stand for."""
    items = sorted(items, key=lambda x: (-x[1], x[0]))[:pool]
    taken, count = [], {}
    for x in items:
        if len(taken) < k and count.get(x[2], 0) < cap:
            taken.append(x)
            count[x[2]] = count.get(x[2], 0) + 1
    taken += [x for x in items if x not in taken][: k - len(taken)]
    need = math.ceil(k * pct / 100) - sum(x[3] for x in taken)
    spare = [x for x in items if x not in taken and x[3]]
    for best in spare[: max(need, 0)]:
        agents = [x for x in taken if not x[3]]
        if not agents:
            break
        taken.remove(min(agents, key=lambda x: (x[1], -x[0])))
        taken.append(best)
    return [x[0] for x in sorted(taken, key=lambda x: (-x[1], x[0]))]


def test_greedy_rerank(spark):
    import random

    rng, old = random.Random(4), DAY - dt.timedelta(100)
    items = {i: (rng.randrange(6), rng.random() < 0.2) for i in range(60)}
    info = dim(spark, [(i, s, "private" if p else "agent", old) for i, (s, p) in items.items()])
    users = {u: [(i, round(rng.random(), 3)) for i in rng.sample(range(60), rng.choice([4, 12, 40]))] for u in range(25)}
    scored = spark.createDataFrame([(u, i, s) for u, x in users.items() for i, s in x], "user_id long, item_id long, pred_score double")
    got = {}
    for r in ranking.greedy_rerank(scored, info, "2024-01-20").orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    for u, x in users.items():
        assert got[u] == greedy([(i, s, *items[i]) for i, s in x], 10, 3, 30)


def test_ndcg(spark):
    gt = spark.createDataFrame([(1, 1), (1, 2)], "user_id long, item_id long")
    pred = spark.createDataFrame([(1, 1, 1), (1, 9, 2), (1, 2, 3)], "user_id long, item_id long, rank int")
    r = evaluation.recall_ndcg(pred, gt, 10).first()
    assert r.recall == 1.0 and r.ndcg == pytest.approx(0.919721, abs=1e-6)


def test_latest_listing(spark):
    rows = [(1, 5, None), (1, 6, dt.date(2024, 1, 1)), (1, 7, dt.date(2024, 1, 2)), (2, 8, None)]
    got = tables.latest_listing(spark.createDataFrame(rows, "item_id long, seller_id long, posted_date date")).collect()
    assert {(r.item_id, r.seller_id) for r in got} == {(1, 7), (2, 8)}


def test_validate_columns():
    assert features.validate_columns([*features.NUMERIC, *features.CATEGORICAL]) == []
    assert features.validate_columns(features.NUMERIC) == features.CATEGORICAL
    assert not set(features.NUMERIC) & set(features.CATEGORICAL)


def test_even_sample():
    assert tables.even_sample([f"f{k}" for k in range(10)], 4) == ["f0", "f3", "f6", "f9"]
    assert tables.even_sample(["b", "a"], 5) == ["a", "b"]


def test_csv_and_reuse(spark, tmp_path):
    from adlark.config import Config
    from adlark.sources import sinks

    sub = spark.createDataFrame([(u, r, 100 * u + r) for u in (7, 3) for r in (1, 2)], "user_id long, rank int, item_id long")
    sinks.submission_csv(sub, str(tmp_path / "s"))
    got = sinks.read_csv(spark, str(tmp_path / "s"), "ID long, user_id long, rank int, item_id long").orderBy("ID").collect()
    assert [tuple(r) for r in got] == [(1, 3, 1, 301), (2, 3, 2, 302), (3, 7, 1, 701), (4, 7, 2, 702)]
    calls = []
    for _ in range(2):
        assert sinks.reuse(spark, lambda: calls.append(1) or sub, str(tmp_path), "sub", Config()).count() == 4
    assert len(calls) == 1
    sinks.reuse(spark, lambda: calls.append(1) or sub, str(tmp_path), "sub", Config(min_pair=3))
    assert len(calls) == 2


def test_streaming_rollup(spark, data, tmp_path):
    from adlark.operators import rollups
    from adlark.streaming.rollups import item_daily_stream

    src = str(tmp_path / "ev")
    ev = tables.events(spark, data).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    ev.write.parquet(src)
    q = item_daily_stream(spark.readStream.schema(ev.schema).parquet(src)).writeStream.format("memory").queryName("s").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = rollups.item_daily(tables.events(spark, data)).select("item_id", "date", "n_pageview", "n_pos_events", "weighted_score")
    end = dt.date(2024, 1, 28)
    assert {tuple(r) for r in spark.table("s").collect() if r.date <= end} == {tuple(r) for r in batch.collect()}


def norm(v):
    if isinstance(v, float):
        return None if v != v else round(v, 5) + 0.0
    return str(v) if isinstance(v, dt.date) else v


@pytest.mark.parametrize("name", ["user_daily", "covisit_matrix", "merge_candidates", "submission", "d30_funnel", "segment_gini", "baseline_top10", "segment_seller_crosstab", "verify_slices"])
def test_oracle(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, data)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    index = [want.columns.index(c) for c in cols]
    a = sorted([str([norm(v) for v in r]) for r in got.select(*cols).collect()])
    b = sorted([str([norm(r[k]) for k in index]) for r in want.fetchall()])
    assert a == b


def test_verify_slices_hold(spark, data):
    assert all(r.qualified_ok and r.positive_ok for r in entry.queries()["verify_slices"](spark, data).collect())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stage_keeps_rows_and_types(spark):
    df = spark.sql("select 1L as a, date '2024-01-02' as d, cast(null as double) as x union all select 1L, date '2024-01-02', null")
    back = sinks.stage(df, "test")
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())
    assert sinks.stage(df.limit(0), "none").count() == 0
