"""Weighted daily rollups and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import count_if, event_weight, is_positive, micros
from ..sources.sinks import stage


def in_window(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events of the days start to end, both included."""
    return events.filter((F.col("date") >= F.lit(start).cast("date")) & (F.col("date") <= F.lit(end).cast("date")))


def _measures(cfg: Config):
    t = F.col("event_type")
    return (count_if(t == "pageview").alias("n_pageview"), count_if(is_positive(t)).alias("n_pos_events"), F.sum(event_weight(t, cfg)).alias("weighted_score"))


def user_daily(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return in_window(events, cfg.train_start, cfg.train_end).filter("user_id is not null").groupBy("user_id", "date").agg(*_measures(cfg), F.countDistinct("item_id").alias("n_unique_items"))


def item_daily(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return in_window(events, cfg.train_start, cfg.train_end).filter("item_id is not null").groupBy("item_id", "date").agg(*_measures(cfg), F.countDistinct("user_id").alias("n_unique_users"), F.avg("dwell_time_sec").alias("avg_dwell"))


def user_item_daily(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    rows = in_window(events, cfg.train_start, cfg.train_end).filter("user_id is not null and item_id is not null")
    return rows.groupBy("user_id", "item_id", "date").agg(*_measures(cfg), F.max("dwell_time_sec").alias("max_dwell"), F.min(micros("event_ts")).alias("first_event_us"), F.max(micros("event_ts")).alias("last_event_us"))


def user_attribute(events: DataFrame, attribute: str, until: str | None = None, cfg: Config = DEFAULT) -> DataFrame:
    """Weight of each user in each value of an attribute; until: last day that counts, the whole window if it is None."""
    rows = in_window(events, cfg.train_start, until or cfg.train_end).filter(f"user_id is not null and {attribute} is not null")
    t = F.col("event_type")
    out = rows.groupBy("user_id", attribute).agg(count_if(is_positive(t)).alias("n_pos_events"), F.sum(event_weight(t, cfg)).alias("weighted_score"), F.countDistinct("item_id").alias("n_unique_items"))
    return out.filter("weighted_score > 0")


def event_type_daily(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return in_window(events, cfg.train_start, cfg.train_end).groupBy("date", "event_type").agg(F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n_users"), F.countDistinct("item_id").alias("n_items"))


def shares(counts: DataFrame, n: str, by: list[str] | None = None, name: str = "pct") -> DataFrame:
    """Percentage of each row in the sum of n, over the whole (small) table or within groups."""
    total = F.sum(n).over(Window.partitionBy(*(by or [])))
    return counts.withColumn(name, F.round(F.col(n) * 100.0 / total, 2))


def event_share(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return shares(in_window(events, cfg.train_start, cfg.train_end).groupBy("event_type").agg(F.count("*").alias("n")), "n")


def global_rank(df: DataFrame, order: list, name: str) -> DataFrame:
    """A number from 1 for each row in a total order, without one task that sorts all: ranges are numbered by themselves
    and start after the rows of those before."""
    parts = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = parts.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offset = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return parts.withColumn("_place", place).join(F.broadcast(offset), "_range").withColumn(name, (F.col("_before") + F.col("_place")).cast("int")).drop("_range", "_place", "_before")
