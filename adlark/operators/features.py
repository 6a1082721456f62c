"""Point-in-time features, labels and samples for the ranker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import count_if, event_weight, graded_label, is_positive, recency_tier
from .candidates import _before, top_k
from .rollups import global_rank, in_window

#: The columns a ranker reads, numbers and then categories.
NUMERIC = [
    "candidate_score",
    "u_total_weighted", "u_recent_weighted", "u_total_pageview", "u_unique_items", "u_unique_categories", "u_unique_cities", "u_active_days",
    "u_avg_dwell", "u_days_since_last", "u_is_warm", "u_top_category_share", "u_top_category_share_recent",
    "i_has_project_id", "i_area_sqm", "i_bedrooms", "i_bathrooms", "i_images_count", "i_age_days",
    "i_total_weighted", "i_recent_weighted", "i_total_pageview", "i_avg_dwell", "i_pop_rank_global",
    "ui_total_weighted", "ui_recent_weighted", "ui_n_pageview", "ui_n_pos_events", "ui_max_dwell", "ui_n_active_days", "ui_days_since_last", "ui_days_since_first",
    "ui_recency_tier", "u_activity_recency_tier", "i_age_tier",
    "ui_category_match", "ui_city_match", "ui_category_match_top2", "ui_top_cat_match_x_share",
]
CATEGORICAL = ["u_top_category", "u_top2_category", "i_category", "i_seller_type", "i_ad_type"]


def validate_columns(columns: list[str]) -> list[str]:
    return [c for c in (*NUMERIC, *CATEGORICAL) if c not in columns]


def _since(c: str, cfg: Config):
    return F.datediff(F.lit(cfg.cutoff).cast("date"), c)


def user_features(user_daily: DataFrame, uid: DataFrame, dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    end = F.lit(cfg.cutoff).cast("date")
    recent = F.col("date") >= F.date_sub(end, cfg.recency_days)
    base = _before(user_daily, cfg.cutoff).groupBy("user_id").agg(
        F.sum("weighted_score").alias("u_total_weighted"), F.sum(F.when(recent, F.col("weighted_score")).otherwise(0.0)).alias("u_recent_weighted"),
        F.sum("n_pageview").alias("u_total_pageview"), F.countDistinct("date").alias("u_active_days"), F.max("date").alias("_last"),
    )
    pairs = _before(uid, cfg.cutoff).filter("weighted_score > 0").join(dim.select("item_id", "category", "city_name"), "item_id", "left")
    more = pairs.groupBy("user_id").agg(F.countDistinct("item_id").alias("u_unique_items"), F.avg("max_dwell").alias("u_avg_dwell"), F.countDistinct("category").alias("u_unique_categories"), F.countDistinct("city_name").alias("u_unique_cities"))
    cat = pairs.filter("category is not null").groupBy("user_id", "category").agg(F.sum("weighted_score").alias("w"))
    top = top_k(cat, ["user_id"], [F.desc("w"), "category"], 2).groupBy("user_id").agg(F.max(F.when(F.col("rn") == 1, F.col("category"))).alias("u_top_category"), F.max(F.when(F.col("rn") == 2, F.col("category"))).alias("u_top2_category"), F.max(F.when(F.col("rn") == 1, F.col("w"))).alias("_w1"))
    total = cat.groupBy("user_id").agg(F.sum("w").alias("_w"))
    late = pairs.filter(recent & F.col("category").isNotNull()).groupBy("user_id", "category").agg(F.sum("weighted_score").alias("w"))
    late = late.groupBy("user_id").agg(F.max("w").alias("_r1"), F.sum("w").alias("_r"))
    city = top_k(pairs.filter("city_name is not null").groupBy("user_id", "city_name").agg(F.sum("weighted_score").alias("w")), ["user_id"], [F.desc("w"), "city_name"], 1).select("user_id", F.col("city_name").alias("u_top_city"))
    out = base.join(more, "user_id", "left").join(top, "user_id", "left").join(total, "user_id", "left").join(late, "user_id", "left").join(city, "user_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "user_id", "u_total_weighted", "u_recent_weighted", F.col("u_total_pageview").cast("long").alias("u_total_pageview"), zero("u_unique_items"), zero("u_unique_categories"), zero("u_unique_cities"), "u_active_days",
        F.coalesce("u_top_category", F.lit(-1)).alias("u_top_category"), F.coalesce("u_top2_category", F.lit(-1)).alias("u_top2_category"), F.coalesce("u_top_city", F.lit("")).alias("u_top_city"),
        F.round(F.coalesce("u_avg_dwell", F.lit(0.0)) + 1e-7, 4).alias("u_avg_dwell"), _since("_last", cfg).alias("u_days_since_last"), F.when(F.col("u_total_weighted") > 0, 1).otherwise(0).alias("u_is_warm"),
        F.round(F.coalesce(F.col("_w1") / F.col("_w"), F.lit(0.0)), 6).alias("u_top_category_share"), F.round(F.coalesce(F.col("_r1") / F.col("_r"), F.lit(0.0)), 6).alias("u_top_category_share_recent"),
    )


def item_features(item_daily: DataFrame, dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    end = F.lit(cfg.cutoff).cast("date")
    recent = F.col("date") >= F.date_sub(end, cfg.popularity_days)
    act = _before(item_daily, cfg.cutoff).groupBy("item_id").agg(
        F.sum("weighted_score").alias("i_total_weighted"), F.sum(F.when(recent, F.col("weighted_score")).otherwise(0.0)).alias("i_recent_weighted"),
        F.sum("n_pageview").alias("i_total_pageview"), F.sum("n_unique_users").alias("i_total_user_events"), F.avg("avg_dwell").alias("i_avg_dwell"),
    )
    popular = act.filter("i_recent_weighted > 0").select("item_id", "i_recent_weighted")
    ranked = global_rank(popular, [F.desc("i_recent_weighted"), F.asc("item_id")], "i_pop_rank_global").drop("i_recent_weighted")
    out = dim.join(act, "item_id", "left").join(ranked, "item_id", "left")
    d = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return out.select(
        "item_id", F.coalesce("category", F.lit(-1)).alias("i_category"), F.coalesce("city_name", F.lit("")).alias("i_city_name"), F.col("district_name").alias("i_district_name"), F.coalesce("seller_type", F.lit("unknown")).alias("i_seller_type"), F.coalesce("ad_type", F.lit("unknown")).alias("i_ad_type"),
        F.when(F.coalesce("project_id", F.lit("")) != "", 1).otherwise(0).alias("i_has_project_id"), *(F.coalesce(c, F.lit(0.0)).alias(f"i_{c}") for c in ("area_sqm", "bedrooms", "bathrooms", "images_count")),
        F.coalesce(_since("posted_date", cfg), F.lit(999)).alias("i_age_days"), d("i_total_weighted", 0.0), d("i_recent_weighted", 0.0), F.coalesce("i_total_pageview", F.lit(0)).cast("long").alias("i_total_pageview"),
        F.coalesce("i_total_user_events", F.lit(0)).cast("long").alias("i_total_user_events"), F.round(F.coalesce("i_avg_dwell", F.lit(0.0)), 6).alias("i_avg_dwell"), d("i_pop_rank_global", 999999),
    )


def pair_features(uid: DataFrame, candidates: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    recent = F.col("date") >= F.date_sub(F.lit(cfg.cutoff).cast("date"), cfg.recency_days)
    hist = _before(uid, cfg.cutoff).groupBy("user_id", "item_id").agg(
        F.sum("weighted_score").alias("ui_total_weighted"), F.sum(F.when(recent, F.col("weighted_score")).otherwise(0.0)).alias("ui_recent_weighted"), F.sum("n_pageview").alias("ui_n_pageview"), F.sum("n_pos_events").alias("ui_n_pos_events"),
        F.max("max_dwell").alias("ui_max_dwell"), F.countDistinct("date").alias("ui_n_active_days"), F.max("date").alias("_last"), F.min("date").alias("_first"),
    )
    out = candidates.select("user_id", "item_id").distinct().join(hist, ["user_id", "item_id"], "left")
    f = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("user_id", "item_id", f("ui_total_weighted"), f("ui_recent_weighted"), n("ui_n_pageview"), n("ui_n_pos_events"), f("ui_max_dwell"), n("ui_n_active_days"), F.coalesce(_since("_last", cfg), F.lit(999)).alias("ui_days_since_last"), F.coalesce(_since("_first", cfg), F.lit(999)).alias("ui_days_since_first"))


def temporal_features(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    out = pairs.select("user_id", "item_id", "ui_days_since_last").join(users.select("user_id", "u_days_since_last"), "user_id", "left").join(items.select("item_id", "i_age_days"), "item_id", "left")
    return out.select("user_id", "item_id", recency_tier(F.col("ui_days_since_last")).alias("ui_recency_tier"), recency_tier(F.col("u_days_since_last")).alias("u_activity_recency_tier"), recency_tier(F.col("i_age_days")).alias("i_age_tier"))


def ranker_input(candidates: DataFrame, users: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    tiers = temporal_features(pairs, users, items)
    out = candidates.join(users, "user_id", "left").join(items.drop("i_total_user_events"), "item_id", "left").join(pairs, ["user_id", "item_id"], "left").join(tiers, ["user_id", "item_id"], "left")
    defaults = {"u_total_weighted": 0.0, "u_recent_weighted": 0.0, "u_total_pageview": 0, "u_unique_items": 0, "u_unique_categories": 0, "u_unique_cities": 0, "u_active_days": 0, "u_top_category": -1, "u_top2_category": -1, "u_top_city": "", "u_avg_dwell": 0.0, "u_days_since_last": 999, "u_is_warm": 0, "u_top_category_share": 0.0, "u_top_category_share_recent": 0.0,
                "i_category": -1, "i_city_name": "", "i_seller_type": "unknown", "i_ad_type": "unknown", "i_has_project_id": 0, "i_area_sqm": 0.0, "i_bedrooms": 0.0, "i_bathrooms": 0.0, "i_images_count": 0.0, "i_age_days": 999, "i_total_weighted": 0.0, "i_recent_weighted": 0.0, "i_total_pageview": 0, "i_avg_dwell": 0.0, "i_pop_rank_global": 999999}
    out = out.fillna(defaults)
    same = (F.when(F.col("u_top_category") == -1, -2).otherwise(F.col("u_top_category")) == F.col("i_category")).cast("int")
    second = ((F.col("u_top2_category") != -1) & (F.col("u_top2_category") == F.col("i_category"))).cast("int")
    return out.withColumns({"ui_category_match": same, "ui_city_match": (F.col("u_top_city") == F.col("i_city_name")).cast("int"), "ui_category_match_top2": F.greatest(same, second), "ui_top_cat_match_x_share": F.round(same * F.col("u_top_category_share"), 6)})


def ground_truth(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    rows = in_window(events, cfg.gt_start, cfg.gt_end).filter("is_login = 'login' and user_id is not null and item_id is not null")
    w = event_weight(F.col("event_type"), cfg)
    return rows.withColumn("w", w).filter("w > 0").groupBy("user_id", "item_id").agg(F.sum("w").alias("gt_weighted_score"), F.count("*").alias("gt_n_events"))


def labelled(candidates: DataFrame, gt: DataFrame, seed: int = 42) -> DataFrame:
    score = F.coalesce("gt_weighted_score", F.lit(0.0))
    key = F.md5(F.concat_ws("|", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.lit(str(seed))))
    return candidates.select("user_id", "item_id", "candidate_score").join(gt, ["user_id", "item_id"], "left").select("user_id", "item_id", "candidate_score", graded_label(score).alias("label"), key.alias("sample_key"))


def sampled(labels: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """All positives, and per user its negatives of least key: neg_per_pos for each positive. Users without positives go."""
    n = labels.groupBy("user_id").agg(count_if(F.col("label") > 0).alias("n_pos")).filter("n_pos > 0")
    from pyspark.sql import Window

    rows = labels.join(n, "user_id")
    rank = F.row_number().over(Window.partitionBy("user_id", F.col("label") > 0).orderBy("sample_key", "item_id"))
    return rows.withColumn("rn", rank).filter((F.col("label") > 0) | (F.col("rn") <= F.col("n_pos") * cfg.neg_per_pos)).select("user_id", "item_id", "label")


def user_split(users: DataFrame, share: float = 0.1, seed: int = 42) -> DataFrame:
    """is_val for a fixed share of users, by the first hex digits of a hash."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("user_id").cast("string"), F.lit(str(seed)))), 1, 6), 16, 10).cast("long")
    return users.select("user_id").distinct().withColumn("is_val", (h < int(share * 16**6)).cast("int"))


def group_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id").agg(F.count("*").alias("group_size"))


def diagnostics(users: DataFrame) -> DataFrame:
    return users.agg(count_if(F.col("u_top_category_share") >= 0.9).alias("n_loyal"), count_if(F.col("u_top_category_share") <= 0.6).alias("n_cross"), count_if(F.col("u_unique_categories") > 1).alias("n_multi_category"), F.count("*").alias("n_users"))


def positive_history(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return in_window(events, cfg.train_start, cfg.train_end).filter(is_positive(F.col("event_type"))).select("user_id", "item_id").distinct()
