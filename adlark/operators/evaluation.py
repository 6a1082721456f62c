"""Offline quality, candidate ceilings, concentration and marketplace health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import ratio
from ..sources.sinks import stage


def recall_ndcg(pred: DataFrame, gt: DataFrame, k: int, groups: DataFrame | None = None) -> DataFrame:
    """Means over users with ground truth; users without predictions count 0. groups: a few values of a column of pred, a row for each."""
    by = groups.columns if groups else []
    size = gt.groupBy("user_id").agg(F.countDistinct("item_id").alias("g"))
    size = size.crossJoin(F.broadcast(groups)) if groups else size
    hits = pred.filter(F.col("rank") <= k).join(gt.select("user_id", "item_id").distinct(), ["user_id", "item_id"]).groupBy(*by, "user_id").agg(F.count("*").alias("hits"), F.sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.lit(k), F.col("g")).cast("int")), F.lit(0.0), lambda a, r: a + 1.0 / F.log2(r + 1.0))
    per = size.join(hits, [*by, "user_id"], "left").select(*by, F.coalesce(F.col("hits") / F.col("g"), F.lit(0.0)).alias("recall"), F.coalesce(F.col("dcg") / ideal, F.lit(0.0)).alias("ndcg"))
    out = per.groupBy(*by).agg(F.count("*").alias("n_users"), F.round(F.avg("recall"), 6).alias("recall"), F.round(F.avg("ndcg"), 6).alias("ndcg"))
    return groups.join(F.broadcast(out), by, "left").withColumn("n_users", F.coalesce("n_users", F.lit(0))) if groups else out  # a few rows


def candidate_recall(cands: DataFrame, gt: DataFrame, ks: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """Share of ground-truth pairs within the first k candidates of their user."""
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("candidate_score"), F.desc("source_score"), "item_id"))
    rows = gt.select("user_id", "item_id").distinct().join(cands.withColumn("r", rank).select("user_id", "item_id", "r"), ["user_id", "item_id"], "left").withColumn("r", F.coalesce("r", F.lit(99999)))
    return rows.agg(F.count("*").alias("n_pairs"), *(F.round(F.avg(F.when(F.col("r") <= k, 1.0).otherwise(0.0)), 6).alias(f"hit_at_{k}") for k in ks))


def source_breakdown(cands: DataFrame, gt: DataFrame) -> DataFrame:
    hit = gt.select("user_id", "item_id").distinct().withColumn("hit", F.lit(1))
    return cands.join(hit, ["user_id", "item_id"], "left").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("n_users"), F.coalesce(F.sum("hit"), F.lit(0)).cast("long").alias("hits"), F.round(100.0 * F.coalesce(F.sum("hit"), F.lit(0)) / F.count("*"), 6).alias("hit_pct"))


def gini(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Gini coefficients of a column of counts, by groups.

    Equal values are counted first, and ranks come from running sums over distinct values, so the window has a row per
    distinct value and not one per seller. No positive sum: 0. Nulls don't count.
    """
    by = by or []
    v = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("x")).agg(F.count("*").cast("double").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy(*by).orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    v = v.withColumn("rank_sum", F.col("x") * (F.col("c") * before + F.col("c") * (F.col("c") + 1) / 2))
    n, s = F.sum("c"), F.sum(F.col("x") * F.col("c"))
    g = F.when(s > 0, 2 * F.sum("rank_sum") / (n * s) - (n + 1) / n).otherwise(0.0)
    return v.groupBy(*by).agg(F.sum("c").cast("long").alias("n"), F.round(g, 6).alias("gini"))


def lorenz(df: DataFrame, value: str) -> DataFrame:
    """Points of the Lorenz curve, one for each distinct value."""
    v = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").cast("double").alias("c"))
    up, all_ = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    return v.select("x", F.round(F.sum("c").over(up) / F.sum("c").over(all_), 6).alias("cum_sellers"), F.round(F.sum(F.col("x") * F.col("c")).over(up) / F.nullif(F.sum(F.col("x") * F.col("c")).over(all_), F.lit(0.0)), 6).alias("cum_value"))


def top_share(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Shares of the sum held by the first 10, the first hundredth and the first tenth (at least one each).

    Equal values are counted first, as in `gini`; how many rows of a value are among the first k follows from the rows above it.
    """
    by = by or []
    v = df.groupBy(*by, F.col(value).cast("double").alias("x")).agg(F.count("*").alias("c"))
    above = F.coalesce(F.sum("c").over(Window.partitionBy(*by).orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    v = v.withColumns({"above": above, "n": F.sum("c").over(Window.partitionBy(*by))})
    taken = lambda k: F.greatest(F.lit(0), F.least(F.col("c"), k - F.col("above")))
    part = lambda k: F.round(ratio(F.sum(F.col("x") * taken(k)), F.sum(F.col("x") * F.col("c"))), 6)
    return v.groupBy(*by).agg(F.sum("c").alias("n"), part(F.lit(10)).alias("top10_share"), part(F.greatest(F.lit(1), F.floor(F.col("n") / 100))).alias("top1pct_share"), part(F.greatest(F.lit(1), F.floor(F.col("n") / 10))).alias("top10pct_share"))


def top_tenth(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """n, their sum, the number of the first tenth (rounded up) and its share of the sum, by groups."""
    v = df.groupBy(*by, F.col(value).cast("double").alias("x")).agg(F.count("*").alias("c"))
    above = F.coalesce(F.sum("c").over(Window.partitionBy(*by).orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    v = v.withColumns({"above": above, "k": F.greatest(F.lit(1), F.ceil(F.sum("c").over(Window.partitionBy(*by)) * 0.10)).cast("long")})
    taken = F.greatest(F.lit(0), F.least(F.col("c"), F.col("k") - F.col("above")))
    total = F.sum(F.col("x") * F.col("c"))
    return v.groupBy(*by).agg(F.sum("c").alias("n_sellers_with_positive"), total.cast("long").alias("total_lead_pairs"), F.max("k").alias("top10_n_sellers"), F.round(ratio(F.sum(F.col("x") * taken), total), 6).alias("top10_share"))


def exposure(recs: DataFrame, dim: DataFrame, cfg: Config = DEFAULT, by: Sequence[str] = ()) -> DataFrame:
    """Recommendations with seller, seller type and age at the end of training, written once for the aggregates that read them."""
    info = dim.select("item_id", "seller_id", "seller_type", F.datediff(F.lit(cfg.train_end).cast("date"), "posted_date").alias("age"))
    return stage(recs.select(*by, "user_id", "item_id", "rank").join(info, "item_id", "left"), "exposure")


def _slots(rows: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """How often each key is shown, and at rank 1."""
    return rows.filter(F.col(key).isNotNull()).groupBy(*by, key).agg(F.count("*").alias("c"), F.sum((F.col("rank") == 1).cast("long")).alias("first"))


def _beside(one: DataFrame, *others: DataFrame) -> DataFrame:
    for x in others:
        one = one.crossJoin(F.broadcast(x))  # one row each
    return one


def marketplace_health(sub: DataFrame, dim: DataFrame, item_daily: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Coverage of active items, exposure Gini of items and sellers, freshness, seller types, variety and concentration at rank 1.

    Active are items with a positive weight in the 30 days before the end of training.
    """
    rows = exposure(sub, dim, cfg)
    items, sellers = _slots(rows, "item_id"), _slots(rows, "seller_id")
    end = F.lit(cfg.train_end).cast("date")
    active = item_daily.filter((F.col("date") < end) & (F.col("date") >= F.date_sub(end, 30)) & (F.col("weighted_score") > 0)).agg(F.countDistinct("item_id").alias("n_active_items"))
    share = lambda c, of: F.round(F.coalesce(100.0 * ratio(F.sum(F.when(c, 1).otherwise(0)), F.sum(F.when(of, 1).otherwise(0))), F.lit(0.0)), 6)
    kind = F.col("seller_type")
    total = rows.agg(share(F.col("age") <= cfg.fresh_days, F.lit(True)).alias("fresh_slot_pct"), share(kind == "private", kind.isNotNull()).alias("private_slot_pct"), share(kind == "agent", kind.isNotNull()).alias("agent_slot_pct"))
    users = rows.groupBy("user_id").agg(F.countDistinct("seller_id").alias("v")).agg(F.count("*").alias("n_users"), F.round(F.avg(F.when(F.col("v") > 0, F.col("v"))), 6).alias("avg_unique_sellers_per_user"))
    top = lambda x, name: F.round(F.coalesce(100.0 * ratio(F.max("first"), F.sum("first")), F.lit(0.0)), 6).alias(name)
    of = lambda df, what: _beside(df.agg(F.count("*").alias(f"n_distinct_{what}s"), top(df, f"top1_{what}_concentration_pct")), gini(df, "c").select(F.col("gini").alias(f"gini_{what}_exposure")))
    out = _beside(total, users, of(items, "item"), of(sellers, "seller"), active)
    return out.withColumn("item_coverage_pct", F.round(100.0 * F.col("n_distinct_items") / F.greatest(F.col("n_active_items"), F.lit(1)), 6))


def variant_metrics(recs: DataFrame, dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """What a variant shows: coverage of the catalogue's items and sellers, Gini, freshness and seller types over all slots."""
    one = recs.sparkSession.range(1).select(F.lit(0).alias("_one"))
    return shown(exposure(recs.withColumn("_one", F.lit(0)), dim, cfg, ["_one"]), dim, one).drop("_one")


def shown(rows: DataFrame, dim: DataFrame, groups: DataFrame) -> DataFrame:
    """`variant_metrics` of each group of an exposure table, one plan for all; groups: a few values of a column of it, a row for each."""
    by = groups.columns
    pct = lambda c: F.round(100.0 * F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    total = rows.groupBy(*by).agg(pct(F.col("age") <= 7).alias("fresh_slot_pct"), pct(F.col("seller_type") == "private").alias("private_slot_pct"), pct(F.col("seller_type") == "agent").alias("agent_slot_pct"))
    users = rows.select(*by, "user_id").distinct().groupBy(*by).agg(F.count("*").alias("n_users_with_recs"))
    of = lambda what: gini(_slots(rows, f"{what}_id", by), "c", by).select(*by, F.col("n").alias(f"n_distinct_{what}s_recommended"), F.col("gini").alias(f"gini_{what}_exposure"))
    catalogue = dim.agg(F.countDistinct("item_id").alias("_items"), F.countDistinct("seller_id").alias("_sellers"))
    out = groups
    for part in (total, users, of("item"), of("seller")):
        out = out.join(F.broadcast(part), by, "left")  # a few rows
    out = _beside(out, catalogue)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_users_with_recs", "n_distinct_items_recommended", "n_distinct_sellers_recommended", "gini_item_exposure", "gini_seller_exposure")}  # groups without rows
    cover = lambda what: F.round(100.0 * F.col(f"n_distinct_{what}s_recommended") / F.greatest(F.col(f"_{what}s"), F.lit(1)), 6)
    return out.withColumns(zero).withColumns({"item_coverage_pct": cover("item"), "seller_coverage_pct": cover("seller")}).drop("_items", "_sellers")
