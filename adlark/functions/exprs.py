"""Column expressions of the domain: weights, tiers, bins, rates and intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, HARD_CONTACTS, OTHER_CONTACT, POSITIVE_EVENTS, Config


def event_weight(c: Column, cfg: Config = DEFAULT) -> Column:
    return F.when(c.isin(*HARD_CONTACTS), F.lit(cfg.hard_weight)).when(c == OTHER_CONTACT, F.lit(cfg.other_weight)).otherwise(F.lit(0.0))


def is_positive(c: Column) -> Column:
    return c.isin(*POSITIVE_EVENTS)


def is_direct(c: Column) -> Column:
    return c.isin(*HARD_CONTACTS)


def count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0.0)))


def recency_tier(days: Column) -> Column:
    """0 for at most 3 days (negative ones too), then up to 7, 14, 30 and 180; 5 beyond and for null."""
    d = F.coalesce(days, F.lit(999))
    return F.when(d <= 3, 0).when(d <= 7, 1).when(d <= 14, 2).when(d <= 30, 3).when(d <= 180, 4).otherwise(5)


def graded_label(score: Column) -> Column:
    return F.when(score >= 6, 3).when(score >= 3, 2).when(score > 0, 1).otherwise(0)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def wilson(k: Column, n: Column, upper: bool, z: float = 1.96) -> Column:
    """A bound of the 95 % interval of a rate, in 0 to 1; null without trials."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = k.cast("double") / n
    centre = (p + z * z / (n * 2)) / (z * z / n + 1)
    half = z * F.sqrt((p * (F.lit(1.0) - p) + z * z / (n * 4)) / n) / (z * z / n + 1)
    # greatest and least skip nulls, so a rate without trials is kept apart
    return F.when(n.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), centre + half if upper else centre - half)))


def dwell_valid(c: Column) -> Column:
    """A dwell time strictly between 0 and an hour; else null."""
    d = F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
    return F.when((d > 0) & (d < 3600), d)


def banded(c: Column, edges: Sequence[float], labels: Sequence[str], inclusive: bool = True) -> Column:
    """The label of the first edge that c does not exceed (or, exclusively, lies below); the last label beyond all, and for null."""
    out = None
    for edge, label in zip(edges, labels):
        inside = c <= edge if inclusive else c < edge
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise(labels[len(edges)])


#: Edges and labels of bins and tiers.
DWELL_BINS = (5, 10, 30, 60, 180, 600), ("0-5s", "5-10s", "10-30s", "30-60s", "1-3m", "3-10m", "10m+")
AGE_BINS = (3, 7, 14, 30, 60, 90, 180), ("00_0-3", "01_4-7", "02_8-14", "03_15-30", "04_31-60", "05_61-90", "06_91-180", "07_180+")
IMAGE_BINS = (2, 5, 10, 15), ("00_0-2", "01_3-5", "02_6-10", "03_11-15", "04_16+")
USER_TIERS = (0, 5, 20, 100), ("0_zero_history", "1_low_1_5", "2_mid_6_20", "3_high_21_100", "4_heavy_100+")
SESSION_TIERS = (1, 5, 20, 100), ("1_single", "2_short_2_5", "3_medium_6_20", "4_long_21_100", "5_very_long_100+")
ACTIVITY_TIERS = (0, 5, 50), ("0_cold", "1_low", "2_mid", "3_high")


def flag(c: Column) -> Column:
    """1 for true, whether it comes as a boolean, a number or a word; else 0."""
    yes = F.coalesce(c.try_cast("boolean"), F.lit(False)) | F.coalesce(c.try_cast("int") == 1, F.lit(False))
    return F.when(yes, 1).otherwise(0)


def days_between(later, earlier) -> Column:
    return F.datediff(later, earlier)


def micros(c: str) -> Column:
    """Microseconds of a timestamp without zone since 1970."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({c} as timestamp_ntz))")
