"""Funnel, contact-rate, segment, concentration and audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, NEW_SELLER_FROM, UNKNOWN, Config
from ..functions.exprs import AGE_BINS, DWELL_BINS, IMAGE_BINS, banded, count_if, dwell_valid, flag, is_direct, is_positive, micros, ratio, wilson
from .candidates import top_k
from .evaluation import gini, top_share, top_tenth
from .rollups import in_window, shares

T = "event_type"


def pair_flags(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One conditional aggregate per pair instead of a full outer join of views and contacts."""
    rows = in_window(events, cfg.train_start, cfg.train_end)
    t, us = F.col(T), micros("event_ts")
    g = rows.groupBy("user_id", "item_id").agg(
        count_if(t == "pageview").alias("n_pageview"), count_if(is_positive(t)).alias("n_pos"), count_if(is_direct(t)).alias("n_direct"),
        F.max(F.when(t == "pageview", dwell_valid(F.col("dwell_time_sec")))).alias("max_dwell"), F.min(F.when(t == "pageview", us)).alias("first_view_us"), F.min(F.when(is_positive(t), us)).alias("first_pos_us"),
    )
    q = (F.col("n_pageview") > 0) & (F.coalesce("max_dwell", F.lit(0.0)) >= 30)
    return g.withColumn("is_qualified", q.cast("int")).withColumn("is_qualified_pos", (q & (F.col("n_pos") > 0)).cast("int"))


def funnel(pairs: DataFrame) -> DataFrame:
    view, q = F.col("n_pageview") > 0, F.col("is_qualified") == 1
    out = pairs.agg(count_if(view).alias("n1_pairs"), count_if(q).alias("n2_qualified"), count_if(F.col("n_pos") > 0).alias("n3_positive_all"), count_if(F.col("n_direct") > 0).alias("n3_direct_all"), count_if(q & (F.col("n_pos") > 0)).alias("n3_positive_inside"), count_if(q & (F.col("n_direct") > 0)).alias("n3_direct_inside"))
    pct = lambda a, b, name: F.round(100 * ratio(F.col(a), F.col(b)), 6).alias(name)
    return out.select("*", pct("n2_qualified", "n1_pairs", "qualified_pct"), pct("n3_positive_inside", "n2_qualified", "contact_rate_pct"), pct("n3_direct_inside", "n2_qualified", "direct_rate_pct"), pct("n3_positive_all", "n1_pairs", "total_positive_pct"))


def daily_counts(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    t = F.col(T)
    g = in_window(events, cfg.train_start, cfg.train_end).groupBy("date").agg(count_if(t == "pageview").alias("pageviews"), count_if(is_positive(t)).alias("positives"), count_if(is_direct(t)).alias("directs"))
    return g.select("*", F.round(ratio(F.col("positives"), F.col("pageviews")), 6).alias("positive_intensity"), F.round(ratio(F.col("directs"), F.col("pageviews")), 6).alias("direct_intensity"))


def daily_pair_rates(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Same-day conversion of viewed pairs and its mean over up to seven rows."""
    t = F.col(T)
    pair = in_window(events, cfg.train_start, cfg.train_end).groupBy("date", "user_id", "item_id").agg(F.max(F.when(t == "pageview", 1).otherwise(0)).alias("v"), F.max(F.when(is_positive(t), 1).otherwise(0)).alias("p")).filter("v = 1")
    day = pair.groupBy("date").agg(F.count("*").alias("viewed_pairs"), F.sum("p").cast("long").alias("converted_pairs")).withColumn("rate", F.round(ratio(F.col("converted_pairs"), F.col("viewed_pairs")), 6))
    return day.withColumn("rate_7", F.round(F.avg("rate").over(Window.orderBy("date").rowsBetween(-6, 0)), 6))  # a row per day


def dwell_quantiles(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Dwell of page views up to the first contact of their session."""
    t = F.col(T)
    rows = in_window(events, cfg.train_start, cfg.train_end).select("session_id", T, micros("event_ts").alias("us"), dwell_valid(F.col("dwell_time_sec")).alias("d"))
    first = rows.filter(is_positive(t)).groupBy("session_id").agg(F.min("us").alias("first_us"))
    v = rows.filter((t == "pageview") & F.col("d").isNotNull()).join(first, "session_id").filter("us <= first_us")
    return v.agg(F.count("*").alias("n"), *(F.round(F.percentile("d", q), 6).alias(name) for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))))


def user_positives(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    rows = in_window(events, cfg.train_start, cfg.train_end).filter(is_positive(F.col(T)) & (F.col("is_login") == "login"))
    return rows.groupBy("user_id").agg(F.count("*").alias("n_events"), F.countDistinct("item_id").alias("n_items"), F.countDistinct("date").alias("n_days"))


def user_segments(users: DataFrame, events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    rows = in_window(events, cfg.train_start, cfg.train_end).filter("is_login = 'login'").groupBy("user_id").agg(count_if(F.col(T) == "pageview").alias("v"), count_if(is_positive(F.col(T))).alias("p"))
    viewed, contacted = (F.coalesce(c, F.lit(0)) > 0 for c in "vp")
    seg = F.when(~viewed & ~contacted, "0_no_history").when(viewed & ~contacted, "1_browser_only").when(~viewed & contacted, "2_positive_no_pageview").otherwise("3_warm_with_positive")
    return shares(users.join(rows, "user_id", "left").groupBy(seg.alias("user_segment")).agg(F.count("*").alias("n_users")), "n_users")


def gap_hours(pairs: DataFrame) -> DataFrame:
    gap = (F.col("first_pos_us") - F.col("first_view_us")) / F.lit(3.6e9)
    return pairs.withColumn("g", gap).filter("g >= 0").agg(F.count("*").alias("n"), F.round(F.percentile("g", 0.5), 6).alias("median_hours"), F.round(F.avg("g"), 6).alias("mean_hours"))


def category_heatmap(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    g = in_window(events, cfg.train_start, cfg.train_end).filter("is_login = 'login' and category is not null").groupBy("user_id", "category").agg(count_if(F.col(T) == "pageview").alias("v"), count_if(is_positive(F.col(T))).alias("p"))
    top = lambda c, name: top_k(g.filter(F.col(c) > 0), ["user_id"], [F.desc(c), "category"], 1).select("user_id", F.col("category").alias(name))
    n = top("v", "view_category").join(top("p", "contact_category"), "user_id").groupBy("view_category", "contact_category").agg(F.count("*").alias("n_users"))
    return shares(n, "n_users", ["view_category"], "row_pct")


def device_surface(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    s = F.when(F.col("surface") == "adview", "ad_view").otherwise(F.col("surface")).alias("surface")
    return in_window(events, cfg.train_start, cfg.train_end).groupBy("device", s, T).agg(F.count("*").alias("n"))


def segment(category, project) -> F.Column:
    return F.when((category == 1050) | project.isNotNull(), "B2B").otherwise("C2C")


def item_metrics(snap: DataFrame, dim: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Every listing with its views, contacts and ages up to the end of training; zeros without a snapshot."""
    clip = lambda c: F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))
    g = snap.filter(F.col("date") <= F.lit(cfg.train_end).cast("date")).groupBy("item_id").agg(F.sum(clip("views_24h")).alias("views"), F.sum(clip("contacts_24h")).alias("contacts"), F.avg(clip("listing_age_days")).alias("avg_age"), F.max(clip("listing_age_days")).alias("max_age"), F.count("*").alias("n_days"))
    d = dim.select("item_id", "seller_id", "category", "seller_type", "ad_type", "city_name", "district_name", "images_count", "area_sqm", "bedrooms", "price_bucket", "project_id", "posted_date", segment(F.col("category"), F.col("project_id")).alias("segment"))
    zero = lambda c, t: F.coalesce(c, F.lit(0)).cast(t)
    out = d.join(g, "item_id", "left").withColumns({c: zero(c, "long") for c in ("views", "contacts", "max_age", "n_days")})
    return out.withColumn("avg_age", F.round(zero("avg_age", "double"), 6)).withColumn("contact_rate", F.round(ratio(F.col("contacts"), F.col("views")), 6))


def seller_metrics(items: DataFrame) -> DataFrame:
    return items.groupBy("seller_id").agg(F.min("seller_type").alias("seller_type"), F.count("*").alias("n_listings"), F.sum("views").alias("views"), F.sum("contacts").alias("contacts"), count_if(F.col("contacts") > 0).alias("n_contacted"), F.min("posted_date").alias("first_post"), F.max("posted_date").alias("last_post")).withColumn("contact_rate", F.round(ratio(F.col("contacts"), F.col("views")), 6))


def pairs_with_dim(pairs: DataFrame, dim: DataFrame) -> DataFrame:
    d = dim.select("item_id", "seller_id", "category", "seller_type", "ad_type", segment(F.col("category"), F.col("project_id")).alias("segment"))
    return pairs.filter("n_pageview > 0").join(d, "item_id")


def contact_rate(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Qualified pairs, those with a contact, the rate and its interval by groups."""
    n, k = F.sum("is_qualified").cast("long"), F.sum("is_qualified_pos").cast("long")
    g = pairs.groupBy(*by).agg(F.count("*").alias("n_pairs"), n.alias("n_qualified"), k.alias("n_positive"))
    n, k = F.col("n_qualified"), F.col("n_positive")
    return g.select("*", F.round(ratio(k, n), 6).alias("rate"), F.round(wilson(k, n, False), 6).alias("low"), F.round(wilson(k, n, True), 6).alias("high"))


def snapshot_rate(items: DataFrame, by: list[str]) -> DataFrame:
    return items.groupBy(*by).agg(F.count("*").alias("n_items"), F.sum("views").alias("views"), F.sum("contacts").alias("contacts")).withColumn("rate", F.round(ratio(F.col("contacts"), F.col("views")), 6))


def age_decay(items: DataFrame) -> DataFrame:
    """Items by their mean age over the days with a snapshot."""
    return items.groupBy(banded(F.col("avg_age"), *AGE_BINS).alias("age_bin")).agg(F.count("*").alias("n_items"), F.sum("views").alias("views"), F.sum("contacts").alias("contacts")).withColumn("rate", F.round(ratio(F.col("contacts"), F.col("views")), 6))


def image_sample(items: DataFrame, least: int = 10, k: int = 5000) -> DataFrame:
    """The first k items of each bucket of image counts, among those with a rate and `least` views or more."""
    n = F.col("images_count").try_cast("double")
    bucket = F.when(n.isNull(), "unknown").otherwise(banded(n, *IMAGE_BINS))
    rows = items.filter((F.col("views") >= least) & F.col("contact_rate").isNotNull()).withColumn("image_bucket", bucket)
    return top_k(rows, ["image_bucket"], ["item_id"], k).select("image_bucket", "item_id", "views", "contacts", "contact_rate")


def geo_top(items: DataFrame, k: int = 20) -> DataFrame:
    """The districts with most contacts; those without a name don't count."""
    rows = items.filter(F.col("district_name").isNotNull() & (F.col("district_name") != UNKNOWN))
    g = rows.groupBy("city_name", "district_name").agg(F.count("*").alias("n_items"), F.sum("views").alias("views"), F.sum("contacts").alias("contacts"))
    return g.withColumn("rate", F.round(ratio(F.col("contacts"), F.col("views")), 6)).orderBy(F.desc("contacts"), "city_name", "district_name").limit(k)


def seller_cohort(items: DataFrame, new_from: str = NEW_SELLER_FROM) -> DataFrame:
    """Listings by the week they were posted and whether their seller's first posting is recent."""
    rows = items.filter("posted_date is not null and seller_id is not null")
    first = rows.groupBy("seller_id").agg(F.min("posted_date").alias("first_post"))
    cohort = F.when(F.col("first_post") >= F.lit(new_from).cast("date"), "new_seller").otherwise("established_seller")
    g = rows.join(first, "seller_id").groupBy(cohort.alias("seller_cohort"), F.date_trunc("week", "posted_date").cast("date").alias("week")).agg(F.count("*").alias("n_listings"), F.sum("views").alias("views"), F.sum("contacts").alias("contacts"))
    return g.withColumn("rate", F.round(ratio(F.col("contacts"), F.col("views")), 6))


def segment_audit(dim: DataFrame) -> DataFrame:
    return dim.groupBy(segment(F.col("category"), F.col("project_id")).alias("segment"), "seller_type", "category").agg(F.count("*").alias("n_items"), F.countDistinct("seller_id").alias("n_sellers"))


def segment_overall(pairs: DataFrame) -> DataFrame:
    q = F.col("is_qualified") == 1
    ids = pairs.groupBy("segment").agg(*(F.countDistinct(F.when(q, F.col(c))).alias(f"n_{c[:-3]}s") for c in ("user_id", "item_id", "seller_id")))
    return contact_rate(pairs, ["segment"]).join(ids, "segment")


def segment_volume(pairs: DataFrame) -> DataFrame:
    return shares(contact_rate(pairs, ["segment", "ad_type", "seller_type"]), "n_qualified", ["segment"], "volume_pct")


def seller_distribution(pairs: DataFrame) -> DataFrame:
    g = pairs.groupBy("segment", "seller_id").agg(F.sum("is_qualified").cast("long").alias("n_qualified"), F.sum("is_qualified_pos").cast("long").alias("n_positive"))
    return g.filter("n_qualified > 0")


def segment_gini(pairs: DataFrame) -> DataFrame:
    """Concentration of contacts over sellers, per segment and for all."""
    d = seller_distribution(pairs)
    both = d.unionByName(pairs.groupBy(F.lit("ALL").alias("segment"), "seller_id").agg(F.sum("is_qualified").cast("long").alias("n_qualified"), F.sum("is_qualified_pos").cast("long").alias("n_positive")).filter("n_qualified > 0"))
    return gini(both, "n_positive", ["segment"]).drop("n").join(top_share(both, "n_positive", ["segment"]), "segment")


def snapshot_gini(items: DataFrame) -> DataFrame:
    return gini(items.filter("seller_id is not null").groupBy("segment", "seller_id").agg(F.sum("contacts").alias("contacts")), "contacts", ["segment"])


def comparison(pairs: DataFrame) -> DataFrame:
    """Segments, metric and value in long form."""
    o = segment_overall(pairs)
    rows = None
    for m in ("n_pairs", "n_qualified", "n_positive", "rate", "n_users", "n_items", "n_sellers"):
        r = o.select("segment", F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        rows = r if rows is None else rows.unionByName(r)
    return rows


def slide_core(pairs: DataFrame) -> DataFrame:
    q, p = F.col("is_qualified") == 1, F.col("is_qualified_pos") == 1
    d = lambda c, cond, name: F.countDistinct(F.when(cond, F.col(c))).alias(name)
    out = pairs.agg(F.count("*").alias("pairs"), F.countDistinct("user_id").alias("users"), F.countDistinct("item_id").alias("items"), F.countDistinct("seller_id").alias("sellers"), d("user_id", q, "users_q"), d("item_id", q, "items_q"), d("user_id", p, "users_p"), d("item_id", p, "items_p"), F.sum("is_qualified").cast("long").alias("pairs_q"), F.sum("is_qualified_pos").cast("long").alias("pairs_p"))
    r = lambda a, b, name: F.round(ratio(F.col(a), F.col(b)), 6).alias(name)
    return out.select("*", r("pairs_q", "pairs", "q_rate"), r("pairs_p", "pairs_q", "cr"), r("users_p", "users_q", "user_cr"), r("items_p", "items_q", "item_cr"))


def dwell_histogram(pairs: DataFrame) -> DataFrame:
    """Viewed pairs by their longest dwell; the rate is that of qualified pairs with a contact."""
    rows = pairs.filter("n_pageview > 0").withColumn("max_dwell", F.coalesce("max_dwell", F.lit(0.0)))
    g = rows.groupBy(banded(F.col("max_dwell"), *DWELL_BINS, inclusive=False).alias("bin_label")).agg(F.count("*").alias("pairs"), F.sum("is_qualified_pos").cast("long").alias("positive_pairs"))
    return g.withColumn("positive_rate", F.round(ratio(F.col("positive_pairs"), F.col("pairs")), 6))


def event_group() -> F.Column:
    return F.when(F.col(T) == "pageview", "pageview").when(is_direct(F.col(T)), "direct_contact").otherwise("other_interaction")


def attribute_share(events: DataFrame, attribute: str, cfg: Config = DEFAULT) -> DataFrame:
    return shares(in_window(events, cfg.train_start, cfg.train_end).groupBy(event_group().alias("event_group"), F.coalesce(F.col(attribute).cast("string"), F.lit("null")).alias("value")).agg(F.count("*").alias("n")), "n", ["event_group"])


def dwell_audit(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Dwell, clipped to an hour, by kind of event; events without one are counted but don't weigh."""
    rows = in_window(events, cfg.train_start, cfg.train_end).select(event_group().alias("event_group"), F.when(F.col("dwell_time_sec").isNotNull(), F.least(F.greatest("dwell_time_sec", F.lit(0.0)), F.lit(3600.0))).alias("d"))
    d = F.col("d")
    pct = lambda c: F.round(100.0 * F.avg(F.when(d.isNotNull(), c.cast("double"))), 6)
    return rows.groupBy("event_group").agg(F.count("*").alias("n_events"), F.count("d").alias("n_with_dwell"), pct(d == 0).alias("zero_pct"), pct(d < 5).alias("lt5_pct"), pct(d < 30).alias("lt30_pct"), *(F.round(F.percentile(d, q), 6).alias(name) for q, name in ((0.5, "median"), (0.75, "p75"), (0.95, "p95"))))


def direct_audit(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Contact rates with all and with direct contacts; here dwell is clipped just below an hour, so long stays qualify."""
    t = F.col(T)
    d = F.least(F.greatest(F.coalesce("dwell_time_sec", F.lit(0.0)), F.lit(0.0)), F.lit(3599.999))
    g = in_window(events, cfg.train_start, cfg.train_end).groupBy("user_id", "item_id").agg(F.max(F.when(t == "pageview", d)).alias("d"), count_if(is_positive(t)).alias("p"), count_if(is_direct(t)).alias("k")).filter("d >= 30")
    out = g.agg(F.count("*").alias("n_qualified"), count_if(F.col("p") > 0).alias("n_full"), count_if(F.col("k") > 0).alias("n_direct"))
    return out.select("*", F.round(100 * (1 - ratio(F.col("n_direct"), F.col("n_full"))), 6).alias("drop_pct"))


def flag_crosstab(events: DataFrame) -> DataFrame:
    return events.groupBy(T).agg(count_if(F.col("is_contact") == 0).alias("flag_0"), count_if(F.col("is_contact") == 1).alias("flag_1"))


def pair_view(df: DataFrame) -> DataFrame:
    """The columns slide tables read, from a pair table of any shape: missing ones get neutral values, flags and numbers any type."""
    has = set(df.columns)
    name = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("unknown")) if c in has else F.lit("unknown")
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in has else F.lit(0.0)
    some = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    q = flag(F.col("is_qualified")) if "is_qualified" in has else F.when((number("max_dwell") >= 30) | (number("n_pos") > 0), 1).otherwise(0)
    p = flag(F.col("is_qualified_pos")) if "is_qualified_pos" in has else F.when(number("n_pos") > 0, 1).otherwise(0)
    return df.select(*(some(c).alias(c) for c in ("user_id", "item_id", "seller_id", "category")), *(name(c).alias(c) for c in ("seller_type", "ad_type")), *(number(c).alias(c) for c in ("n_pageview", "n_pos", "n_direct", "max_dwell")), q.alias("q_pair"), p.alias("q_pos_pair"))


def slide_rates(view: DataFrame) -> DataFrame:
    """Contact rates by ad and seller type, with the items seen and contacted."""
    items = F.countDistinct(F.when(F.col("q_pos_pair") == 1, F.col("item_id")))
    g = view.groupBy("ad_type", "seller_type").agg(F.count("*").alias("observed_pairs"), F.sum("q_pair").cast("long").alias("d30_engaged_pairs"), F.sum("q_pos_pair").cast("long").alias("d30_positive_pairs"), F.countDistinct("item_id").alias("observed_items"), items.alias("contacted_items"))
    r = lambda b: F.round(ratio(F.col("d30_positive_pairs"), F.col(b)), 6)
    return g.withColumns({"cr_d30": r("d30_engaged_pairs"), "cr_observed": r("observed_pairs")})


def slide_concentration(view: DataFrame) -> DataFrame:
    """How leads concentrate on sellers, by kind of seller: share of the first tenth (rounded up) and Gini, over sellers with a lead."""
    kind = F.when(F.col("seller_type") == "agent", "B2B_agent").when(F.col("seller_type") == "private", "C2C_private").otherwise("unknown")
    s = view.filter("seller_id is not null").groupBy(kind.alias("seller_group"), "seller_id").agg(F.sum("q_pos_pair").cast("long").alias("leads")).filter("leads > 0")
    return gini(s, "leads", ["seller_group"]).drop("n").join(top_tenth(s, "leads", ["seller_group"]), "seller_group")


def cold_tiers(counts: DataFrame) -> DataFrame:
    """The four tiers of test users, from their counts by has_positive and has_interaction."""
    p, i = flag(F.col("has_positive")) == 1, flag(F.col("has_interaction")) == 1
    tier = F.when(p & i, "warm_positive").when(p, "positive_no_pageview").when(i, "browser_only").otherwise("no_history")
    return shares(counts.groupBy(tier.alias("tier")).agg(F.sum("n_users").alias("n_users")), "n_users")


def summary_metrics(funnel_row: DataFrame, cold: DataFrame, pairs: DataFrame, pairs_dim: DataFrame, sellers: DataFrame) -> DataFrame:
    """branch, metric, value and description of the numbers that slides quote."""
    f = lambda branch, df, metric, value, text: df.select(F.lit(branch).alias("branch"), metric.alias("metric") if isinstance(metric, F.Column) else F.lit(metric).alias("metric"), F.round(value.cast("double"), 6).alias("value"), F.lit(text).alias("description"))
    c = F.col
    gap = (c("first_pos_us") - c("first_view_us")) / F.lit(3.6e9)
    hours = pairs.withColumn("g", gap).filter("g >= 0 and g <= 720").agg(F.percentile("g", 0.5).alias("v")).filter("v is not null")
    cat = contact_rate(pairs_dim, ["category"]).filter("rate is not null").orderBy(F.desc("rate"), "category").limit(1)
    seg = segment_overall(pairs_dim)
    con = segment_gini(pairs_dim)
    rows = [
        *(f("A1", funnel_row, m, c(col), t) for m, col, t in (
            ("N1_pageview_pairs", "n1_pairs", "pairs of user and item with a page view"), ("N2_qualified_pairs_d30", "n2_qualified", "pairs with a dwell of 30 seconds or more"),
            ("N3_qualified_pos_pairs_d30", "n3_positive_inside", "qualified pairs with a positive event"), ("CR_D30_overall_pct", "contact_rate_pct", "contact rate of qualified pairs"),
            ("N3_qualified_dc_pos_pairs_d30", "n3_direct_inside", "qualified pairs with a direct contact"), ("CR_D30_dc_only_pct", "direct_rate_pct", "contact rate by direct contacts alone"),
            ("P_total_positive_over_pageview_pct", "total_positive_pct", "positive pairs over pairs with a page view"))),
        f("A1", funnel_row, "D_selected_sec", F.lit(30.0), "least dwell of a qualified pair"),
        f("A2", cold.filter("user_segment = '0_no_history'"), "test_no_history_pct", c("pct"), "test users without history"),
        f("A2", hours, "median_view_to_contact_hours", c("v"), "median hours from first view to first contact, up to 30 days"),
        f("A3", gini(sellers.filter("seller_id is not null"), "contacts"), "seller_contact_gini", c("gini"), "concentration of contacts on sellers"),
        f("A3", cat, "best_category_by_cr_d30", c("category"), "category of the highest contact rate"),
        f("A3", cat, "best_category_cr_d30_pct", 100 * c("rate"), "its contact rate"),
        f("A3", contact_rate(pairs_dim.filter("ad_type is not null and seller_type is not null"), ["ad_type", "seller_type"]), F.concat(F.lit("cr_d30_pct__"), c("ad_type"), F.lit("_"), c("seller_type")), 100 * c("rate"), "contact rate by ad and seller type"),
        f("A3_seg", seg, F.concat(F.lit("cr_d30_pct__"), c("segment")), 100 * c("rate"), "contact rate of a segment"),
        f("A3_seg", seg, F.concat(F.lit("qualified_pairs__"), c("segment")), c("n_qualified"), "qualified pairs of a segment"),
        f("A3_seg", con, F.concat(F.lit("gini_d30__"), c("segment")), c("gini"), "concentration of leads on sellers of a segment"),
        f("A3_seg", con.filter("segment <> 'ALL' and top10pct_share is not null"), F.concat(F.lit("top10pct_share__"), c("segment")), c("top10pct_share"), "leads of the first tenth of sellers"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def exposure_vs_rate(pairs: DataFrame) -> DataFrame:
    rows = shares(contact_rate(pairs, ["seller_type"]), "n_pairs", None, "exposure_pct")
    items = pairs.groupBy("seller_type").agg(F.countDistinct("item_id").alias("n_listings"))
    return rows.join(items, "seller_type").withColumns({"pageview_per_listing": F.round(ratio(F.col("n_pairs"), F.col("n_listings")), 2), "qualified_per_listing": F.round(ratio(F.col("n_qualified"), F.col("n_listings")), 2), "qualifying_rate_pct": F.round(100 * ratio(F.col("n_qualified"), F.col("n_pairs")), 2), "cr_d30_pct": F.round(100 * ratio(F.col("n_positive"), F.col("n_qualified")), 2)})


def exposure_ratios(table: DataFrame) -> DataFrame:
    """Each measure of private sellers and agents side by side, and how many times as large the agents' is."""
    measures = ["n_listings", "n_pairs", "n_qualified", "n_positive", "pageview_per_listing", "qualified_per_listing", "qualifying_rate_pct", "cr_d30_pct"]
    long = table.select("seller_type", F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in measures))).alias("x")).select("seller_type", "x.metric", "x.v")
    of = lambda kind: F.max(F.when(F.col("seller_type") == kind, F.col("v"))).alias(kind)
    return long.groupBy("metric").agg(of("private"), of("agent")).withColumn("ratio_agent_over_private", F.round(F.try_divide("agent", "private"), 2))


def segment_seller_crosstab(pairs: DataFrame) -> DataFrame:
    """Counts by segment with a total row, by ROLLUP."""
    return pairs.rollup("segment").agg(count_if(F.col("seller_type") == "private").alias("private"), count_if(F.col("seller_type") == "agent").alias("agent"), F.count("*").alias("total")).fillna("Total", ["segment"])


def verify_slices(pairs: DataFrame, funnel_row: DataFrame) -> DataFrame:
    """Sums over slices against the funnel, and the weighted mean of their rates against the whole rate."""
    rows = None
    for by in ("category", "seller_type", "segment"):
        r = contact_rate(pairs, [by]).agg(F.lit(by).alias("slice"), F.sum("n_qualified").alias("sum_qualified"), F.sum("n_positive").alias("sum_positive"))
        rows = r if rows is None else rows.unionByName(r)
    f = funnel_row.select("n2_qualified", "n3_positive_inside")
    return rows.crossJoin(F.broadcast(f)).select("slice", "sum_qualified", "sum_positive", (F.col("sum_qualified") == F.col("n2_qualified")).alias("qualified_ok"), (F.col("sum_positive") == F.col("n3_positive_inside")).alias("positive_ok"))


def session_audit(events: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Events of each kind in a session that has any."""
    s = in_window(events, cfg.train_start, cfg.train_end).groupBy("session_id", event_group().alias("event_group")).agg(F.count("*").alias("n"))
    return s.groupBy("event_group").agg(F.count("*").alias("n_sessions"), F.round(F.percentile("n", 0.5), 6).alias("median_events"), F.round(F.avg("n"), 6).alias("mean_events"), F.round(F.percentile("n", 0.95), 6).alias("p95_events"), F.max("n").alias("max_events"))
