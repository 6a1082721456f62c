"""Five candidate sources and their merge. All orders end with ids, so results don't depend on the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config

def top_k(df: DataFrame, by: list[str], order: list, k: int, rank: str = "rn") -> DataFrame:
    """The first k rows of each group; Catalyst prunes before the shuffle by WindowGroupLimit."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k)


def _before(df: DataFrame, cutoff: str, days: int | None = None) -> DataFrame:
    end = F.lit(cutoff).cast("date")
    out = df.filter(F.col("date") < end)
    return out if days is None else out.filter(F.col("date") >= F.date_sub(end, days))


def reengagement(uid: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    g = _before(uid, cfg.cutoff).filter("weighted_score > 0").groupBy("user_id", "item_id").agg(F.sum("weighted_score").alias("w"), F.max("date").alias("last_event_date"))
    age = F.datediff(F.lit(cfg.cutoff).cast("date"), "last_event_date")
    scored = g.withColumn("source_score", F.round(F.col("w") * F.exp(-age * F.log(F.lit(2.0)) / cfg.half_life_days), 9))
    return top_k(scored, ["user_id"], [F.desc("source_score"), F.desc("last_event_date"), "item_id"], cfg.quotas[0]).select("user_id", "item_id", F.lit("reengagement").alias("source"), "source_score", "last_event_date")


def covisit_matrix(uid: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Edges of items that the same users contacted. The cap of seeds bounds a user's pairs, so the join can't explode."""
    w = _before(uid, cfg.cutoff, cfg.lookback_days).groupBy("user_id", "item_id").agg(F.sum("weighted_score").alias("w")).filter("w >= 1")
    seeds = top_k(w, ["user_id"], [F.desc("w"), "item_id"], cfg.seed_cap).select("user_id", "item_id", "w")
    a, b = (seeds.select("user_id", F.col("item_id").alias(f"item_{x}"), F.col("w").alias(f"w_{x}")) for x in "ab")
    edges = a.join(b, "user_id").filter("item_a < item_b").groupBy("item_a", "item_b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("edge_weight"), F.count("*").alias("n_co_users")).filter(F.col("n_co_users") >= cfg.min_pair)
    both = edges.unionByName(edges.select(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "edge_weight", "n_co_users"))
    return top_k(both, ["item_a"], [F.desc("edge_weight"), F.desc("n_co_users"), "item_b"], cfg.neighbours).drop("rn")


def covisit_candidates(uid: DataFrame, matrix: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    w = _before(uid, cfg.cutoff).groupBy("user_id", "item_id").agg(F.sum("weighted_score").alias("w")).filter("w > 0")
    seeds = top_k(w, ["user_id"], [F.desc("w"), "item_id"], cfg.seed_cap)
    near = seeds.join(matrix, seeds["item_id"] == matrix["item_a"]).groupBy("user_id", "item_b").agg(F.sum(F.col("w") * F.col("edge_weight")).alias("source_score"))
    return top_k(near, ["user_id"], [F.desc("source_score"), "item_b"], cfg.quotas[1]).select("user_id", F.col("item_b").alias("item_id"), F.lit("covisit").alias("source"), "source_score")


def recent_popularity(item_daily: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return _before(item_daily, cfg.cutoff, cfg.popularity_days).groupBy("item_id").agg(F.sum("weighted_score").alias("pop")).filter("pop > 0")


def category_pop(item_daily: DataFrame, dim: DataFrame, user_category: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    pop = recent_popularity(item_daily, cfg).join(dim.select("item_id", "category"), "item_id")
    top = top_k(pop, ["category"], [F.desc("pop"), "item_id"], min(cfg.top_category, cfg.quotas[2]))
    mine = top_k(user_category, ["user_id"], [F.desc("weighted_score"), "category"], 1).select("user_id", "category")
    return mine.join(top, "category").select("user_id", "item_id", F.lit("category_pop").alias("source"), F.col("pop").alias("source_score"))


def city_cat_pop(item_daily: DataFrame, dim: DataFrame, user_category: DataFrame, user_city: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    pop = recent_popularity(item_daily, cfg).join(dim.select("item_id", "category", "city_name"), "item_id")
    top = top_k(pop, ["category", "city_name"], [F.desc("pop"), "item_id"], min(cfg.top_cell, cfg.quotas[3]))
    cat = top_k(user_category, ["user_id"], [F.desc("weighted_score"), "category"], 1).select("user_id", "category")
    city = top_k(user_city, ["user_id"], [F.desc("weighted_score"), "city_name"], 1).select("user_id", "city_name")
    return cat.join(city, "user_id").join(top, ["category", "city_name"]).select("user_id", "item_id", F.lit("city_cat_pop").alias("source"), F.col("pop").alias("source_score"))


def global_top(item_daily: DataFrame, k: int, cfg: Config = DEFAULT) -> DataFrame:
    return recent_popularity(item_daily, cfg).orderBy(F.desc("pop"), "item_id").limit(k)


def global_pop(item_daily: DataFrame, users: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The k most popular items for every user; k is a quota of a few, cut before the product is formed."""
    top = global_top(item_daily, min(cfg.top_global, cfg.quotas[4]), cfg)
    return users.select("user_id").distinct().crossJoin(F.broadcast(top)).select("user_id", "item_id", F.lit("global_pop").alias("source"), F.col("pop").alias("source_score"))


def merge(sources: list[DataFrame], cfg: Config = DEFAULT) -> DataFrame:
    """Scores over their source's maximum, the best source of each pair, the best `pool` pairs of each user."""
    cols = ["user_id", "item_id", "source", "source_score"]
    rows = sources[0].select(*cols)
    for s in sources[1:]:
        rows = rows.unionByName(s.select(*cols))
    most = rows.groupBy("source").agg(F.max("source_score").alias("most"))  # a row per source
    rows = rows.join(F.broadcast(most), "source").withColumn("candidate_score", F.when(F.col("most") > 0, F.round(F.col("source_score") / F.col("most"), 9)).otherwise(F.lit(0.0)))
    one = top_k(rows, ["user_id", "item_id"], [F.desc("candidate_score"), F.desc("source_score"), "source"], 1).drop("rn", "most")
    return top_k(one, ["user_id"], [F.desc("candidate_score"), F.desc("source_score"), "item_id"], cfg.pool).select(*cols, "candidate_score")
