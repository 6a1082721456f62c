"""Daily rollups over a stream of events, with a watermark for late ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.exprs import count_if, event_weight, is_positive


def item_daily_stream(events: DataFrame, late: str = "1 day", cfg: Config = DEFAULT) -> DataFrame:
    """item_id, date, n_pageview, n_pos_events, weighted_score; a day closes when the watermark has passed it."""
    t = F.col("event_type")
    g = events.withWatermark("event_ts", late).groupBy("item_id", F.window("event_ts", "1 day").alias("w"))
    return g.agg(count_if(t == "pageview").alias("n_pageview"), count_if(is_positive(t)).alias("n_pos_events"), F.sum(event_weight(t, cfg)).alias("weighted_score")).select("item_id", F.col("w.start").cast("date").alias("date"), "n_pageview", "n_pos_events", "weighted_score")
