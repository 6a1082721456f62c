"""Hand-computed cases of the definitions that queries and their SQL share."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from adlark.config import DEFAULT, PREDICT, UNKNOWN
from adlark.functions import exprs
from adlark.operators import altranker, candidates, eda, evaluation, features, ranking, rollups, verify
from adlark.operators import storyline as st
from adlark.operators.lambdarank import LambdaRanker, ndcg, stepper
from adlark.plans import registry
from adlark.sources import sinks, tables

DAY = dt.date(2024, 1, 20)
END = dt.date(2024, 1, 28)
DIM = "item_id long, seller_id long, category int, seller_type string, ad_type string, city_name string, district_name string, images_count double, area_sqm double, bedrooms double, bathrooms double, price_bucket string, project_id string, direction string, posted_date date, expected_expired_date date"


def listing(item, seller=1, category=1010, kind="agent", city="A", district="D", images=3.0, project=None, posted=END - dt.timedelta(10), expired=END + dt.timedelta(30), direction=None):
    return (item, seller, category, kind, "sell", city, district, images, 50.0, 2.0, None, "p", project, direction, posted, expired)


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "item_id long, date date, views_24h long, contacts_24h long, listing_age_days int")


def test_a_view_does_not_refresh_a_contact(spark):
    rows = [(1, 1, DAY - dt.timedelta(14), 4.0), (1, 1, DAY - dt.timedelta(1), 0.0)]
    got = candidates.reengagement(spark.createDataFrame(rows, "user_id long, item_id long, date date, weighted_score double")).first()
    assert got.source_score == 2.0 and got.last_event_date == DAY - dt.timedelta(14)


def test_only_recently_contacted_items_have_a_popularity_rank(spark):
    d = spark.createDataFrame([listing(k) for k in (1, 2, 3, 4)], DIM)
    daily = spark.createDataFrame([(1, DAY - dt.timedelta(1), 1, 2.0, 1, 5.0), (2, DAY - dt.timedelta(1), 3, 0.0, 2, 5.0), (3, DAY - dt.timedelta(2), 1, 7.0, 1, 5.0)], "item_id long, date date, n_pageview long, weighted_score double, n_unique_users long, avg_dwell double")
    got = {r.item_id: r for r in features.item_features(daily, d).collect()}
    assert {k: r.i_pop_rank_global for k, r in got.items()} == {3: 1, 1: 2, 2: 999999, 4: 999999}
    assert got[1].i_bathrooms == 0.0 and got[1].i_district_name == "D"


def test_global_rank(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), int(v)) for i, v in enumerate(rng.integers(0, 20, 3000))]
    got = rollups.global_rank(spark.createDataFrame(rows, "i long, v long").repartition(7), [F.desc("v"), F.asc("i")], "r").collect()
    assert {r.i: r.r for r in got} == {i: k + 1 for k, (i, _) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0])))}


def test_item_metrics_keep_items_without_a_snapshot(spark):
    d = spark.createDataFrame([listing(1, project="x"), listing(2)], DIM)
    snap = snapshot(spark, [(1, END, 10, 3, -4), (1, END - dt.timedelta(1), None, 2, 6), (1, END + dt.timedelta(1), 99, 99, 99)])
    got = {r.item_id: r for r in st.item_metrics(snap, d).collect()}
    assert (got[1].views, got[1].contacts, got[1].avg_age, got[1].max_age, got[1].n_days, got[1].contact_rate, got[1].segment) == (10, 5, 3.0, 6, 2, 0.5, "B2B")
    assert (got[2].views, got[2].contacts, got[2].avg_age, got[2].max_age, got[2].n_days, got[2].contact_rate, got[2].segment) == (0, 0, 0.0, 0, 0, None, "C2C")


def test_bins(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(exprs.banded(F.lit(v), *exprs.AGE_BINS)) for v in (0.0, 3.0, 3.1, 30.0, 181.0)] == ["00_0-3", "00_0-3", "01_4-7", "03_15-30", "07_180+"]
    assert [one(exprs.banded(F.lit(v), *exprs.DWELL_BINS, inclusive=False)) for v in (0.0, 5.0, 29.9, 600.0)] == ["0-5s", "5-10s", "10-30s", "10m+"]
    assert [one(exprs.flag(F.lit(v))) for v in ("true", "1", "no", "2", None, "y")] == [1, 1, 0, 0, 0, 1]
    assert [one(exprs.flag(F.lit(v))) for v in (True, False, 1, 0)] == [1, 0, 1, 0]
    assert [one(eda.direction(F.lit(v))) for v in ("ĐB", "Đông - Nam", "tay nam", "bắc", "north", None)] == ["Đông Bắc", "Đông Nam", "Tây Nam", "Bắc", UNKNOWN, UNKNOWN]


def test_image_buckets_and_places(spark):
    d = spark.createDataFrame([listing(1, images=2.0), listing(2, images=15.0), listing(3, images=None, district=None), listing(4, images=16.0, district=UNKNOWN), listing(5, images=5.0)], DIM)
    snap = snapshot(spark, [(k, END, 10, k, 1) for k in (1, 2, 3, 4)] + [(5, END, 9, 1, 1)])
    items = st.item_metrics(snap, d)
    assert {r.item_id: r.image_bucket for r in st.image_sample(items).collect()} == {1: "00_0-2", 2: "03_11-15", 3: "unknown", 4: "04_16+"}
    place = st.geo_top(items).collect()
    assert [(r.city_name, r.district_name, r.n_items, r.contacts) for r in place] == [("A", "D", 3, 4)]


def test_popularity_window_includes_its_first_day(spark):
    d = spark.createDataFrame([listing(1), listing(2, expired=END - dt.timedelta(61), posted=END - dt.timedelta(99)), listing(3)], DIM)
    rows = [(1, 1, END - dt.timedelta(n)) for n in (7, 8, 28, 29)] + [(2, 1, END), (3, 1, END - dt.timedelta(29))]
    pos = spark.createDataFrame(rows, "item_id long, user_id long, date date")
    got = eda.item_popularity(pos, snapshot(spark, [(3, END, 0, 0, 1)]), d).collect()
    assert [(r.item_id, r.pos_28) for r in got] == [(1, 3)]  # 2 has expired, 3 was neither seen nor contacted in 28 days
    assert got[0].base_score == pytest.approx(3 * np.log10(2) + 2 * np.log10(4) + np.log10(2) + 0.2, abs=1e-6)


def test_top_shares(spark):
    values = [9, 9, 7, 5, 5, 5, 3, 2, 1, 1, 1, 1, 0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v long")
    r = evaluation.top_share(df, "v", ["g"]).first()
    assert (r.n, r.top10_share, r.top1pct_share, r.top10pct_share) == (13, round(47 / 49, 6), round(9 / 49, 6), round(9 / 49, 6))
    r = evaluation.top_tenth(df, "v", ["g"]).first()
    assert (r.n_sellers_with_positive, r.total_lead_pairs, r.top10_n_sellers, r.top10_share) == (13, 49, 2, round(18 / 49, 6))


def test_health(spark):
    d = spark.createDataFrame([listing(1, 1, kind="private", posted=END - dt.timedelta(7)), listing(2, 1, posted=END - dt.timedelta(8)), listing(3, None, kind=None)], DIM)
    sub = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 3, 2)], "user_id long, item_id long, rank int")
    daily = spark.createDataFrame([(1, END - dt.timedelta(30), 1.0), (2, END - dt.timedelta(31), 1.0), (3, END, 1.0), (4, END - dt.timedelta(1), 0.0)], "item_id long, date date, weighted_score double")
    r = evaluation.marketplace_health(sub, d, daily).first()
    assert (r.n_users, r.n_distinct_items, r.n_distinct_sellers, r.n_active_items, r.item_coverage_pct) == (2, 3, 1, 1, 300.0)
    assert (r.fresh_slot_pct, r.private_slot_pct, r.agent_slot_pct) == (50.0, round(200 / 3, 6), round(100 / 3, 6))
    assert (r.avg_unique_sellers_per_user, r.top1_item_concentration_pct, r.top1_seller_concentration_pct, r.gini_seller_exposure) == (1.0, 100.0, 100.0, 0.0)
    v = evaluation.variant_metrics(sub, d).first()
    assert (v.item_coverage_pct, v.seller_coverage_pct, v.private_slot_pct) == (100.0, 100.0, 50.0)


def test_user_segments(spark):
    ev = [(1, "pageview"), (2, "view_phone"), (3, "pageview"), (3, "contact_chat")]
    events = spark.createDataFrame([(u, t, END, "login") for u, t in ev], "user_id long, event_type string, date date, is_login string")
    users = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "user_id long")
    assert {r.user_segment: r.n_users for r in st.user_segments(users, events).collect()} == {"0_no_history": 1, "1_browser_only": 1, "2_positive_no_pageview": 1, "3_warm_with_positive": 1}


def test_dwell_audit(spark):
    rows = [("pageview", 0.0, 1), ("pageview", 9000.0, 1), ("pageview", None, 1), ("view_phone", -3.0, 1), ("other_interaction", 10.0, 2)]
    events = spark.createDataFrame([(t, d, s, END) for t, d, s in rows], "event_type string, dwell_time_sec double, session_id long, date date")
    got = {r.event_group: r for r in st.dwell_audit(events).collect()}
    assert (got["pageview"].n_events, got["pageview"].n_with_dwell, got["pageview"].zero_pct, got["pageview"].median) == (3, 2, 50.0, 1800.0)
    assert got["direct_contact"].zero_pct == 100.0 and got["other_interaction"].lt30_pct == 100.0
    assert {r.event_group: r.max_events for r in st.session_audit(events).collect()} == {"pageview": 3, "direct_contact": 1, "other_interaction": 1}


def test_bands(spark):
    def status(n2, n3, q, p):
        pairs = spark.createDataFrame([(1010, "sell", "agent", 1, 1 if k < p else 0) for k in range(q)], "category int, ad_type string, seller_type string, is_qualified int, is_qualified_pos int")
        funnel = spark.createDataFrame([(n2, n3, 100.0 * n3 / n2)], "n2_qualified long, n3_positive_inside long, contact_rate_pct double")
        return {r.check: r.status for r in verify.verify_d30(pairs, funnel).collect()}

    assert set(status(100, 10, 100, 10).values()) == {"OK"}
    warn = status(100, 10, 95, 10)
    assert warn["category_qualified_missing_pct"] == "WARN" and warn["category_weighted_mean_diff_pp"] == "FAIL" and warn["ad_seller_qualified_missing_pct"] == "OK"
    assert status(100, 10, 80, 10)["category_qualified_missing_pct"] == "FAIL"


def test_verdicts(spark):
    t = spark.createDataFrame
    surface = t([("other_interaction", 60.0), ("other_interaction", 40.0), ("pageview", 99.0)], "event_group string, pct double")
    dwell, session = t([("other_interaction", 10.0)], "event_group string, zero_pct double"), t([("other_interaction", 12.0), ("direct_contact", 2.0)], "event_group string, median_events double")
    direct, flags = t([(85.0,)], "drop_pct double"), t([("other_interaction", 5, 95)], "event_type string, flag_0 long, flag_1 long")
    got = {r.angle: (r.value, r.verdict) for r in verify.other_interaction_verdicts(surface, dwell, session, direct, flags).collect()}
    assert got == {"A1_surface": (60.0, "concentrated"), "B1_dwell": (10.0, "real_engagement"), "B2_session_freq": (6.0, "noise_signal"), "C_dc_only_cr": (85.0, "story_collapses"), "D_is_contact_flag": (95.0, "btc_treats_as_contact"), "final_call": (0.0, "change")}


def test_pair_view_takes_any_shape(spark):
    df = spark.createDataFrame([(1, "", "12", "31"), (2, None, "x", None)], "user_id long, seller_type string, n_pos string, max_dwell string")
    got = {r.user_id: r for r in st.pair_view(df).collect()}
    assert (got[1].seller_type, got[1].n_pos, got[1].q_pair, got[1].q_pos_pair, got[1].item_id) == ("unknown", 12.0, 1, 1, None)
    assert (got[2].ad_type, got[2].n_pos, got[2].max_dwell, got[2].q_pair, got[2].q_pos_pair) == ("unknown", 0.0, 0.0, 0, 0)


def test_rules_without_their_column_change_nothing(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 1, 3), (1, 2, 1.9, 1, 3), (1, 3, 1.8, 1, 99)], "user_id long, item_id long, pred_score double, seller_id long, i_age_days int")
    assert [r.pred_score for r in ranking.cap_sellers(df).orderBy("item_id").collect()] == [2.0, 1.9, 0.9]
    assert [round(r.pred_score, 6) for r in ranking.boost_fresh(df).orderBy("item_id").collect()] == [2.2, 2.09, 1.8]
    with pytest.warns(UserWarning):
        assert ranking.cap_sellers(df.drop("seller_id")).collect() == df.drop("seller_id").collect()
    with pytest.warns(UserWarning):
        assert ranking.boost_fresh(df.drop("i_age_days")).collect() == df.drop("i_age_days").collect()


def test_training_pairs(spark):
    pos = spark.createDataFrame([(1, 1, DAY), (1, 2, DAY), (2, 1, END)], "user_id long, item_id long, date date")
    cand = spark.createDataFrame([(1, k, "global") for k in range(2, 30)] + [(2, 5, "city")], "user_id long, item_id long, source string")
    got = altranker.training_pairs(pos, cand, "2024-01-21").collect()
    assert {(r.item_id, r.x_candidate_source) for r in got if r.label} == {(1, "positive_outside_pool"), (2, "global")}
    assert sum(1 for r in got if not r.label) == 10 and all(r.user_id == 1 and r.item_id > 2 for r in got if not r.label)


def test_lambda_gradients():
    g = pd.DataFrame({"user_id": 1, "item_id": [1, 2, 3], "label": [0, 2, 1], "score": [3.0, 2.0, 1.0]})
    out = stepper(10)(g).set_index("item_id")
    moves = out["target"] * out["weight"]
    assert moves.sum() == pytest.approx(0) and moves[2] > 0 > moves[1] and (out["weight"] > 0).all()
    swap = abs((2**2 - 1) * (1 / np.log2(3) - 1 / np.log2(2)) - 0) / ((2**2 - 1) + 1 / np.log2(3))
    alone = stepper(10)(g[g["item_id"] != 3])
    assert alone.set_index("item_id").loc[2, "weight"] > 0 and swap > 0
    assert (stepper(10)(g.assign(label=1))["weight"] == 0).all()


def test_lambdarank_learns_and_comes_back(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for u in range(60):
        for i in range(12):
            a, b = rng.normal(size=2)
            rows.append((u, i, int(a + 0.3 * rng.normal() > 0.8) + int(a > 1.5), int(u % 5 == 0), float(a), float(b)))
    df = spark.createDataFrame(rows, "user_id long, item_id long, label int, is_val int, a double, b double")
    m = LambdaRanker(["a", "b"], rounds=4, patience=2).fit(df)
    held = df.filter("is_val = 1")
    scored = held.join(m.transform(held), ["user_id", "item_id"])
    assert ndcg(scored, "pred_score").first().ndcg_at_10 > 0.9 > ndcg(scored, "b").first().ndcg_at_10
    assert m.importance()[0][0] == "a" and len(m.history) >= len(m.trees) > 0
    m.save(spark, str(tmp_path / "m"))
    again = LambdaRanker.load(spark, str(tmp_path / "m"))
    assert again.importance() == m.importance()
    assert {(r.user_id, r.item_id): r.pred_score for r in again.transform(held).collect()} == {(r.user_id, r.item_id): r.pred_score for r in m.transform(held).collect()}


def test_ranker_columns():
    assert len(features.NUMERIC) == 39 and len(features.CATEGORICAL) == 5
    assert PREDICT.cutoff == DEFAULT.train_end


def test_submission_file(spark, tmp_path):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    dim = spark.createDataFrame([(k,) for k in range(10)], "item_id long")

    def checks(text, encoding="utf-8"):
        path = tmp_path / f"s{len(list(tmp_path.iterdir()))}.csv"
        path.write_bytes(text.encode(encoding))
        return {r.check: r.ok for r in sinks.validate_submission_file(str(path), users, dim, 2).collect()}

    body = "1,1,1,0\n2,1,2,1\n3,2,1,0\n4,2,2,9\n"
    assert all(checks(f"{sinks.HEADER}\n{body}").values())
    assert not checks(f"{sinks.HEADER}\n{body}", "utf-8-sig")["byte_order_marks"]
    assert not checks(f"ID,user,rank,item_id\n{body}")["headers"]
    bad = checks(f"{sinks.HEADER}\n2,1,1,0\n2,1,1,0\n3,3,3,\n4,2,2,77\n")
    assert {k for k, ok in bad.items() if not ok} == {"repeated_ids", "first_id", "largest_rank", "repeated_user_ranks", "repeated_user_items", "users_of_another_size", "unknown_users", "unknown_items", "rows_with_nulls", "is_valid"}
    only_items = checks(f"{sinks.HEADER}\n{body.replace(',9', ',99')}")
    assert not only_items["unknown_items"] and only_items["is_valid"]
    with pytest.raises(ValueError, match="rows"):
        path = tmp_path / "short.csv"
        path.write_text(f"{sinks.HEADER}\n1,1,1,0\n")
        sinks.validate_submission_file(str(path), users, dim, 2, raise_on_error=True)


def test_folders_and_views(spark, data):
    assert tables.first_files(["c", "a", "b"], 2) == ["a", "b"] and tables.first_files(["b", "a"]) == ["a", "b"]
    made = tables.register_folder(spark, "/root/testdata/sf0.001", ["part"], ["nothing"])
    assert made == ["part"]
    with pytest.raises(FileNotFoundError):
        tables.register_folder(spark, data, ["nothing"])
    assert tables.drop_views(spark, ["part", "never"]) == ["part"]
    got = {r.table: (r.n_files, r.ok) for r in tables.audit_structure(spark, data, {"part": 1, "nothing": 1}).collect()}
    assert got == {"part": (1, True), "nothing": (0, False)}


def test_listings_and_users_are_whole_tables(spark, data):
    assert tables.listing(spark, data).count() == tables.read(spark, data, "part").count()
    assert tables.test_users(spark, data).count() == tables.read(spark, data, "customer").count()


def test_variants_share_one_plan(spark, monkeypatch):
    written = []
    whole = sinks.stage
    for module in (sinks, evaluation):
        monkeypatch.setattr(module, "stage", lambda df, name: written.append(name) or whole(df, name))
    got = {r.variant: r.asDict() for r in registry.queries()["variant_comparison"](spark, "/root/testdata/sf0.001").collect()}
    assert sorted(got) == ["baseline_popularity", "rank_only", "rank_rerank"]
    assert [written.count(name) for name in ("exposure", "dim", "events", "greedy")] == [1, 1, 1, 0]


def test_groups_without_rows_have_a_row(spark):
    recs = spark.createDataFrame([("a", 1, 10, 1), ("a", 1, 11, 2), ("b", 2, 10, 1)], "kind string, user_id long, item_id long, rank int")
    dim = spark.createDataFrame([(10, 5, "private", "2024-01-25"), (11, 6, "agent", None)], "item_id long, seller_id long, seller_type string, posted_date string").withColumn("posted_date", F.col("posted_date").cast("date"))
    gt = spark.createDataFrame([(1, 11), (2, 12)], "user_id long, item_id long")
    groups = spark.createDataFrame([("a",), ("b",), ("c",)], "kind string")
    found = {r.kind: r.asDict() for r in evaluation.recall_ndcg(recs, gt, 10, groups).join(evaluation.shown(evaluation.exposure(recs, dim, by=["kind"]), dim, groups), "kind").collect()}
    assert len(found) == 3
    for g, row in found.items():
        own = recs.filter(F.col("kind") == g)
        want = evaluation.recall_ndcg(own, gt, 10).first().asDict() | evaluation.variant_metrics(own, dim).first().asDict()
        assert {k: v for k, v in row.items() if k != "kind"} == want
    assert found["c"]["n_users"] == 2 and found["c"]["n_users_with_recs"] == 0 and found["c"]["gini_item_exposure"] == 0.0 and found["c"]["fresh_slot_pct"] is None
    none = evaluation.recall_ndcg(recs, gt.limit(0), 10, groups).collect()
    assert sorted((r.kind, r.n_users, r.recall) for r in none) == [("a", 0, None), ("b", 0, None), ("c", 0, None)]


def test_growing_tables_are_not_broadcast(spark, tmp_path):
    """A supplier table of some MB of Parquet goes through a shuffle; only the 25 nations and the one-row count, with hints, don't."""
    for name in ("part", "nation"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        rows = rows.join(spark.range(1000)).withColumn("p_partkey", F.col("p_partkey") + 1000 * F.col("id")).drop("id") if name == "part" else rows
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    spark.range(300_000).selectExpr("id AS s_suppkey", "concat('Supplier#', hash(id)) AS s_name", "id % 25 AS s_nationkey", "CAST(hash(id) AS double) AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        s = registry.Stages(spark, str(tmp_path))
        assert s.dim._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == 2
        assert s.dim.count() == s.dim.select("item_id").distinct().count() > 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        registry.Stages(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
