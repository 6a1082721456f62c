"""Cleaning, exploratory tables and the popularity baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, POSITIVE_EVENTS, UNKNOWN, Config
from ..functions.exprs import ACTIVITY_TIERS, SESSION_TIERS, USER_TIERS, banded, count_if, micros, ratio
from ..sources.tables import latest_listing
from .candidates import top_k
from .rollups import shares

#: Spellings of the eight directions, lowered.
DIRECTIONS = {
    "Đông Bắc": ("đông bắc", "dong bac", "đông - bắc", "db", "đb"),
    "Đông Nam": ("đông nam", "dong nam", "đông - nam", "dn", "đn"),
    "Tây Bắc": ("tây bắc", "tay bac", "tây - bắc", "tb"),
    "Tây Nam": ("tây nam", "tay nam", "tây - nam", "tn"),
    "Đông": ("đông", "dong"),
    "Tây": ("tây", "tay"),
    "Nam": ("nam",),
    "Bắc": ("bắc", "bac"),
}


def direction(c) -> F.Column:
    """The direction that a spelling means; unknown and null ones are UNKNOWN."""
    out, low = None, F.lower(c)
    for name, spellings in DIRECTIONS.items():
        out = F.when(low.isin(*spellings), name) if out is None else out.when(low.isin(*spellings), name)
    return out.otherwise(UNKNOWN)


def clean_dim(dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    end = F.lit(cfg.train_end).cast("date")
    one = latest_listing(dim.filter("item_id is not null"))
    return one.select(
        "item_id", "seller_id", F.col("category").try_cast("int").alias("category"), "seller_type", "ad_type", direction(F.col("direction")).alias("direction_clean"), *(F.coalesce(c, F.lit(UNKNOWN)).alias(f"{c}_clean") for c in ("city_name", "district_name", "price_bucket")),
        F.col("area_sqm").try_cast("double").alias("area_sqm"), F.col("project_id").isNotNull().alias("has_project"), "posted_date", "expected_expired_date", F.datediff("expected_expired_date", "posted_date").alias("listing_lifetime_days"),
        (F.col("posted_date") > end).alias("is_post_train_end"), (F.col("expected_expired_date") < F.col("posted_date")).alias("is_expire_before_post"),
    )


def clean_snapshot(snap: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    clip = lambda c: F.greatest(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c)
    return snap.filter("item_id is not null").filter(F.col("date") <= F.lit(cfg.train_end).cast("date")).select("item_id", "date", clip("views_24h"), clip("contacts_24h"), clip("listing_age_days"), F.col("views_24h").isNull().alias("views_was_null"), F.col("contacts_24h").isNull().alias("contacts_was_null"))


def clean_interactions(rows: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    clip = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).cast("long").alias(c)
    return rows.filter(F.col("date") <= F.lit(cfg.train_end).cast("date")).select("user_id", "item_id", "date", "category", *(clip(c) for c in ("adview_count", "lead_count", "chat_message_count", "chat_turn_count")), (F.col("lead_count") > 0).alias("has_lead"))


def clean_events(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Positive events of users that are logged in, before the end of training; dwell clipped to an hour."""
    rows = events.filter(F.col("event_type").isin(*POSITIVE_EVENTS) & (F.col("is_login") == "login") & (F.col("date") <= F.lit(cfg.train_end).cast("date")) & F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    return rows.select("event_id", "user_id", "item_id", "event_type", "date", "category", "city_name", "session_id", "device", micros("event_ts").alias("event_us"), F.least(F.greatest(F.coalesce("dwell_time_sec", F.lit(0.0)), F.lit(0.0)), F.lit(3600.0)).alias("dwell"))


def assert_no_leak(clean: DataFrame, cfg: Config = DEFAULT) -> None:
    """Raise if an event lies after the end of training."""
    if clean.filter(F.col("date") > F.lit(cfg.train_end).cast("date")).limit(1).count():
        raise ValueError("events after the end of training")


def supply(dim: DataFrame, by: str) -> DataFrame:
    return dim.groupBy(by).agg(F.count("*").alias("n_listings"), F.countDistinct("seller_id").alias("n_sellers"))


def city_top(dim: DataFrame, k: int = 20) -> DataFrame:
    return supply(dim, "city_name").orderBy(F.desc("n_listings"), "city_name").limit(k)


def demand(pos: DataFrame, by: str) -> DataFrame:
    return pos.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"))


def weekly(pos: DataFrame) -> DataFrame:
    return pos.groupBy(F.date_trunc("week", "date").cast("date").alias("week")).agg(F.count("*").alias("n_events"), F.countDistinct("user_id").alias("wau"), F.countDistinct("item_id").alias("n_items"))


def cold_start(users: DataFrame, pos: DataFrame, inter: DataFrame) -> DataFrame:
    p = pos.select("user_id").distinct().withColumn("has_positive", F.lit(True))
    i = inter.select("user_id").distinct().withColumn("has_interaction", F.lit(True))
    rows = users.join(p, "user_id", "left").join(i, "user_id", "left").fillna(False, ["has_positive", "has_interaction"])
    return shares(rows.groupBy("has_positive", "has_interaction").agg(F.count("*").alias("n_users")), "n_users")


def interaction_tiers(users: DataFrame, inter: DataFrame) -> DataFrame:
    """Test users by their number of interaction rows."""
    n = inter.groupBy("user_id").agg(F.count("*").alias("n"))
    rows = users.join(n, "user_id", "left").withColumn("user_tier", banded(F.coalesce("n", F.lit(0)), *USER_TIERS))
    return shares(rows.groupBy("user_tier").agg(F.count("*").alias("n_users")), "n_users")


def event_breakdown(pos: DataFrame, exact: bool = True) -> DataFrame:
    """exact=False counts users and items by sketches, which merge without a second shuffle: for tables too large to sort."""
    n = F.countDistinct if exact else F.approx_count_distinct
    return shares(pos.groupBy("event_type").agg(F.count("*").alias("n_events"), n("user_id").alias("n_users"), n("item_id").alias("n_items")), "n_events")


def session_tiers(pos: DataFrame) -> DataFrame:
    n = pos.groupBy("session_id").agg(F.count("*").alias("n"))
    return shares(n.groupBy(banded(F.col("n"), *SESSION_TIERS).alias("session_tier")).agg(F.count("*").alias("n_sessions")), "n_sessions")


def weekly_market(snap: DataFrame) -> DataFrame:
    day = snap.groupBy("date").agg(F.sum("views_24h").alias("v"), F.sum("contacts_24h").alias("c"), F.countDistinct("item_id").alias("active"))
    return day.groupBy(F.date_trunc("week", "date").cast("date").alias("week")).agg(F.sum("v").alias("views"), F.sum("c").alias("contacts"), F.round(F.avg("active"), 6).alias("mean_daily_active"), F.round(ratio(F.sum("c"), F.sum("v")), 6).alias("contact_rate"))


def item_popularity(pos: DataFrame, snap: DataFrame, dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    end = F.lit(cfg.train_end).cast("date")
    day = F.datediff(end, "date")
    p = pos.groupBy("item_id").agg(F.count("*").alias("pos_all"), count_if(day <= 7).alias("pos_7"), count_if(day <= 28).alias("pos_28"), F.countDistinct("user_id").alias("n_users"))
    s = snap.groupBy("item_id").agg(F.sum("views_24h").alias("views"), F.sum("contacts_24h").alias("contacts"))
    rows = dim.join(p, "item_id", "left").join(s, "item_id", "left")
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    cr = F.coalesce(ratio(z("contacts"), z("views")), F.lit(0.0))
    age = F.datediff(end, "posted_date")
    base = 3 * F.log10(1 + z("pos_7")) + 2 * F.log10(1 + z("pos_28")) + F.log10(1 + z("n_users")) + 1.5 * cr + F.when(F.col("seller_type") == "private", 0.25).otherwise(0.0) + F.when(age.between(0, 30), 0.20).otherwise(0.0)
    expired = F.datediff(end, F.coalesce("expected_expired_date", end))
    keep = (F.col("posted_date") <= end) & (F.col("expected_expired_date") >= F.col("posted_date")) & (expired <= 60) & ((z("pos_28") > 0) | (z("views") > 0))
    return rows.filter(keep).select("item_id", "category", "city_name", z("pos_28").cast("long").alias("pos_28"), F.round(base, 6).alias("base_score"))


def user_profile(users: DataFrame, pos: DataFrame) -> DataFrame:
    rows = pos.join(users, "user_id", "left_semi")
    last = F.struct("event_us", "event_id")
    base = rows.groupBy("user_id").agg(F.count("*").alias("n_pos"), F.countDistinct("item_id").alias("n_items"), F.countDistinct("date").alias("n_days"), *(F.max_by(c, last).alias(f"last_{name}") for c, name in (("category", "category"), ("city_name", "city"), ("device", "device"))))
    top = lambda c: top_k(rows.filter(F.col(c).isNotNull()).groupBy("user_id", c).agg(F.count("*").alias("n"), F.max("event_us").alias("d")), ["user_id"], [F.desc("n"), F.desc("d"), c], 1).select("user_id", F.col(c).alias(f"top_{c}"))
    out = users.join(base, "user_id", "left").join(top("category"), "user_id", "left").join(top("city_name"), "user_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("user_id", zero("n_pos"), zero("n_items"), zero("n_days"), "last_category", "last_city", "last_device", "top_category", "top_city_name", banded(F.coalesce("n_pos", F.lit(0)), *ACTIVITY_TIERS).alias("activity_tier"))


def baseline_scores(profile: DataFrame, popularity: DataFrame, k: tuple[int, int, int, int] = (10, 8, 6, 5)) -> DataFrame:
    order = [F.desc("base_score"), F.desc("pos_28"), "item_id"]
    tops = [popularity.orderBy(*order).limit(k[0]), top_k(popularity, ["category"], order, k[1]), top_k(popularity, ["city_name"], order, k[2]), top_k(popularity, ["category", "city_name"], order, k[3])]
    from pyspark.sql import Window

    tops[0] = tops[0].withColumn("rn", F.row_number().over(Window.orderBy(*order)))  # k rows
    p = profile.select("user_id", F.coalesce("top_category", "last_category").alias("category"), F.coalesce("top_city_name", "last_city").alias("city_name"))
    score = lambda tier: F.round(F.lit(float(tier)) + F.col("base_score") - F.col("rn") * 0.01, 6).alias("score")
    take = ["user_id", "item_id"]
    pools = [
        p.select("user_id").crossJoin(F.broadcast(tops[0])).select(*take, score(500), F.lit("global").alias("source")),
        p.join(tops[1].drop("city_name"), "category").select(*take, score(800), F.lit("category").alias("source")),
        p.drop("category").join(tops[2].drop("category"), "city_name").select(*take, score(650), F.lit("city").alias("source")),
        p.join(tops[3], ["category", "city_name"]).select(*take, score(1000), F.lit("cat_city").alias("source")),
    ]
    rows = pools[0].unionByName(pools[1]).unionByName(pools[2]).unionByName(pools[3])
    return rows.groupBy("user_id", "item_id").agg(F.max("score").alias("score"), F.max_by("source", F.struct("score", "source")).alias("source"))


def baseline_top(scores: DataFrame, k: int = 10) -> DataFrame:
    return top_k(scores, ["user_id"], [F.desc("score"), "item_id"], k, "rank").select("user_id", "rank", "item_id", "score")


def recommendation_health(recs: DataFrame, dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    age = F.datediff(F.lit(cfg.train_end).cast("date"), "posted_date")
    rows = recs.join(dim.select("item_id", "seller_id", "seller_type", "posted_date"), "item_id", "left")
    pct = lambda c: F.round(100.0 * F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"), F.countDistinct("seller_id").alias("n_sellers"), pct(F.col("seller_type") == "private").alias("private_pct"), pct(age.between(0, 30)).alias("fresh_pct"))


def run_tables(tables: dict, write) -> dict[str, str]:
    """Write each table (a name and a function that makes it); a failure is kept and the others go on."""
    failed = {}
    for name, make in tables.items():
        try:
            write(name, make())
        except Exception as e:  # one bad table must not stop the others
            failed[name] = str(e)
    return failed
