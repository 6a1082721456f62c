"""Checks of result tables against each other, and verdicts over audits. A row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from .storyline import contact_rate, segment_gini, segment_overall, segment_volume

#: Percentage points of tolerance, counts that may differ, percent of pairs missing that warn and fail, and times the whole rate.
POINTS, COUNTS = 0.1, 1
WARN_PCT, FAIL_PCT, SEGMENT_PCT = 3.0, 10.0, 5.0
TIMES = 3


def _all(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def _check(df: DataFrame, name: str, value: Column, status: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), F.round(value.cast("double"), 6).alias("value"), status.alias("status"))


def _fails(cond: Column, otherwise: str = "OK") -> Column:
    return F.when(cond, "FAIL").otherwise(otherwise)


def _lost(whole: str, part: str) -> Column:
    return 100.0 * (F.col(whole) - F.col(part)) / F.greatest(F.col(whole), F.lit(1))


def _band(whole: str, part: str) -> Column:
    """OK while counts agree or little is missing, WARN beyond WARN_PCT, FAIL beyond FAIL_PCT."""
    pct = F.abs(_lost(whole, part))
    same = F.abs(F.col(whole) - F.col(part)) <= COUNTS
    return F.when(same, "OK").when(pct > FAIL_PCT, "FAIL").when(pct > WARN_PCT, "WARN").otherwise("OK")


def _sums(slices: DataFrame) -> DataFrame:
    """One row: sums, the weighted mean of rates in percent, and extremes."""
    n = F.col("n_qualified")
    return slices.agg(
        F.sum("n_qualified").alias("q"), F.sum("n_positive").alias("p"), (100.0 * ratio(F.sum(F.when(n > 0, F.col("rate") * n)), F.sum(F.when(n > 0, n)))).alias("mean_pct"),
        F.sum(F.when(F.col("rate").isNull(), 1).otherwise(0)).alias("n_null"), F.sum(F.when((F.col("rate") < 0) | (F.col("rate") > 1), 1).otherwise(0)).alias("n_outside"), F.max("rate").alias("most"),
    )


def verify_d30(pairs: DataFrame, funnel: DataFrame) -> DataFrame:
    """Slices by category and by ad and seller type against the funnel: what is missing, weighted means, ranges."""
    f = F.broadcast(funnel.select(F.col("n2_qualified").alias("n2"), F.col("n3_positive_inside").alias("n3"), F.col("contact_rate_pct").alias("whole_pct")))  # one row
    cat = _sums(contact_rate(pairs, ["category"])).crossJoin(f)
    combo = _sums(contact_rate(pairs.filter("ad_type is not null and seller_type is not null"), ["ad_type", "seller_type"])).crossJoin(f)
    rows = [
        _check(cat, "category_qualified_missing_pct", _lost("n2", "q"), _band("n2", "q")),
        _check(cat, "category_positive_missing_pct", _lost("n3", "p"), _band("n3", "p")),
        _check(combo, "ad_seller_qualified_missing_pct", _lost("n2", "q"), _fails(_lost("n2", "q") > FAIL_PCT)),
        _check(cat, "category_weighted_mean_diff_pp", F.col("whole_pct") - F.col("mean_pct"), _fails(F.coalesce(F.abs(F.col("whole_pct") - F.col("mean_pct")) > POINTS, F.lit(True)))),
    ]
    for name, x in (("category", cat), ("ad_seller", combo)):
        rows += [
            _check(x, f"{name}_null_rates", F.col("n_null"), _fails(F.col("n_null") > 0)),
            _check(x, f"{name}_rates_outside_0_1", F.col("n_outside"), _fails(F.col("n_outside") > 0)),
            _check(x, f"{name}_most_against_whole", F.col("most") * 100 / F.col("whole_pct"), F.when(F.col("most") * 100 > TIMES * F.col("whole_pct"), "WARN").otherwise("OK")),
        ]
    return _all(rows)


def segment_proxy(dim: DataFrame) -> DataFrame:
    """Listings by category: how many have a project, and how many are of each segment."""
    b2b = (F.col("category") == 1050) | F.col("project_id").isNotNull()
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    g = dim.groupBy("category").agg(F.count("*").alias("n_listings"), n(F.col("project_id").isNotNull()).alias("n_with_project_id"), n(b2b).alias("n_b2b"), n(~F.coalesce(b2b, F.lit(False))).alias("n_c2c"))
    return g.withColumns({"pct_with_project_id": F.round(100 * ratio(F.col("n_with_project_id"), F.col("n_listings")), 6), "pct_b2b": F.round(100 * ratio(F.col("n_b2b"), F.col("n_listings")), 6)})


def verify_segments(pairs: DataFrame, dim: DataFrame, funnel: DataFrame) -> DataFrame:
    """Segments add up, cover the funnel, have volume, and all rates, shares and Gini coefficients lie in 0 to 1."""
    f = F.broadcast(funnel.select(F.col("n2_qualified").alias("n2"), F.col("contact_rate_pct").alias("whole_pct")))  # one row
    audit = segment_proxy(dim).agg(F.sum("n_listings").alias("n"), F.sum("n_b2b").alias("b"), F.sum("n_c2c").alias("c"), F.sum(F.when(F.col("category") != 1050, F.col("n_with_project_id")).otherwise(0)).alias("hidden"))
    overall = segment_overall(pairs)
    s = _sums(overall).crossJoin(f)
    volume = lambda name: overall.agg(F.coalesce(F.sum(F.when(F.col("segment") == name, F.col("n_qualified"))), F.lit(0)).alias("q"))
    outside = lambda df, c, top=1.0: df.agg(F.sum(F.when((F.col(c) >= 0) & (F.col(c) <= top), 0).otherwise(1)).alias("n"))
    diff = F.col("whole_pct") - F.col("mean_pct")
    rows = [
        _check(audit, "listings_outside_segments", F.col("n") - F.col("b") - F.col("c"), _fails(F.col("b") + F.col("c") != F.col("n"))),
        _check(audit, "hidden_b2b_pct", 100 * F.col("hidden") / F.greatest(F.col("n"), F.lit(1)), F.when(100 * F.col("hidden") / F.greatest(F.col("n"), F.lit(1)) > 1.0, "WARN").otherwise("OK")),
        _check(s, "segment_qualified_missing_pct", _lost("n2", "q"), _fails(_lost("n2", "q") > SEGMENT_PCT)),
        _check(s, "segment_weighted_mean_diff_pp", diff, _fails(F.coalesce(F.abs(diff) > 5 * POINTS, F.lit(True)))),
        *(_check(volume(name), f"{name}_qualified", F.col("q"), _fails(F.col("q") == 0)) for name in ("B2B", "C2C")),
        *(_check(x, name, F.col("n"), _fails(F.col("n") > 0)) for name, x in (("segment_rates_outside_0_1", outside(overall, "rate")), ("segment_ginis_outside_0_1", outside(segment_gini(pairs), "gini")), ("volume_shares_outside_0_1", outside(segment_volume(pairs), "volume_pct", 100.01)))),
    ]
    return _all(rows)


def other_interaction_verdicts(surface: DataFrame, dwell: DataFrame, session: DataFrame, direct: DataFrame, flags: DataFrame) -> DataFrame:
    """Verdicts over the audits of other_interaction (angle, value, verdict), and a final call from those that speak for or against it."""
    other = F.col("event_group") == "other_interaction"
    top = surface.filter(other).agg(F.max("pct").alias("v")).filter("v is not null")
    zero = dwell.filter(other).select(F.col("zero_pct").alias("v")).filter("v is not null")
    m = lambda kind: F.max(F.when(F.col("event_group") == kind, F.col("median_events")))
    often = session.agg(m("other_interaction").alias("o"), m("direct_contact").alias("d")).filter("o is not null").select((F.col("o") / F.greatest(F.col("d"), F.lit(0.5))).alias("v"))
    lost = direct.select(F.col("drop_pct").alias("v")).filter("v is not null")
    flag = flags.filter("event_type = 'other_interaction'").select((100.0 * F.col("flag_1") / (F.col("flag_0") + F.col("flag_1"))).alias("v"))
    v = F.col("v")
    rows = _all([
        x.select(F.lit(angle).alias("angle"), F.round(v, 6).alias("value"), verdict.alias("verdict"))
        for angle, x, verdict in (
            ("A1_surface", top, F.when(v > 50, "concentrated").when(v > 25, "partial").otherwise("spread")),
            ("B1_dwell", zero, F.when(v > 80, "noise_signal").when(v < 30, "real_engagement").otherwise("mixed")),
            ("B2_session_freq", often, F.when(v > 5, "noise_signal").otherwise("normal")),
            ("C_dc_only_cr", lost, F.when(v > 80, "story_collapses").when(v < 30, "story_holds").otherwise("story_partial")),
            ("D_is_contact_flag", flag, F.when(v > 90, "btc_treats_as_contact").when((v > 30) & (v < 90), "btc_inconsistent").otherwise("btc_not_contact")),
        )
    ])
    count = lambda kinds: F.sum(F.when(F.col("verdict").isin(*kinds), 1).otherwise(0))
    calls = rows.agg(count(["noise_signal", "story_collapses", "btc_not_contact"]).alias("bad"), count(["real_engagement", "story_holds", "btc_treats_as_contact"]).alias("good"))
    call = F.when((F.col("bad") == 0) & (F.col("good") >= 2), "keep").when(F.col("bad") >= 2, "change").otherwise("mixed")
    return rows.unionByName(calls.select(F.lit("final_call").alias("angle"), (F.col("good") - F.col("bad")).cast("double").alias("value"), call.alias("verdict")))
