"""All marketplace queries by name: functions of a session and a folder of tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT as C
from ..config import PREDICT, Config
from ..operators import altranker, eda, evaluation, features, ranking, rollups, verify
from ..operators import candidates as ca
from ..operators import storyline as st
from ..operators.lambdarank import LambdaRanker, ndcg
from ..sources import sinks
from ..sources import tables as t


#: Stages that several later ones read; each is written once per query, so events are not scanned and shuffled again for each reader.
KEPT = {"item_daily", "uid", "user_category", "pool", "scored", "raw", "submission", "base_scores", "alt_pairs"}


#: Bytes of a table that Spark may broadcast without a hint: its own 10 MB of Parquet are over a million listings or users in the driver.
MOST_BROADCAST = 256 << 10


def _bounded(spark: SparkSession) -> None:
    """Keep tables that grow out of the driver's memory; a lower threshold of the session stays."""
    if spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() > MOST_BROADCAST:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(MOST_BROADCAST))
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")  # the same, then


class Stages:
    """The tables that queries share, each made from the one before when a query asks for it; cfg sets windows and cutoff."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config = C):
        _bounded(spark)
        self.spark, self.dir, self.cfg, self._made = spark, sf_dir, cfg, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or f"make_{name}" not in dir(type(self)):
            raise AttributeError(name)
        if name not in self._made:
            made = self.fresh(name)
            self._made[name] = sinks.stage(made, name) if name in KEPT else made
        return self._made[name]

    def fresh(self, name: str) -> DataFrame:
        """A stage that nothing else will read."""
        return getattr(type(self), f"make_{name}")(self)

    def keep(self, *names: str) -> None:
        """Write these stages as tables as well; for queries with so many readers that their plans fill the driver's memory."""
        self._made |= {name: sinks.stage(getattr(self, name), name) for name in names}

    def make_events(self):
        return t.events(self.spark, self.dir)

    def make_dim(self):
        return t.latest_listing(t.listing(self.spark, self.dir))

    def make_users(self):
        return t.test_users(self.spark, self.dir)

    def make_snap(self):
        return t.snapshot(self.spark, self.dir)

    def make_snap_clean(self):
        return eda.clean_snapshot(self.snap, self.cfg)

    def make_inter(self):
        return t.interactions(self.spark, self.dir)

    def make_user_daily(self):
        return rollups.user_daily(self.events, self.cfg)

    def make_item_daily(self):
        return rollups.item_daily(self.events, self.cfg)

    def make_uid(self):
        return rollups.user_item_daily(self.events, self.cfg)

    def _last_day(self) -> str:
        return (date.fromisoformat(self.cfg.cutoff) - timedelta(1)).isoformat()

    def make_user_category(self):
        return rollups.user_attribute(self.events, "category", self._last_day(), self.cfg)

    def make_user_city(self):
        return rollups.user_attribute(self.events, "city_name", self._last_day(), self.cfg)

    def make_matrix(self):
        return ca.covisit_matrix(self.uid, self.cfg)

    def make_asked(self):
        """Users that get candidates: all with activity, or the test users as of the end of training."""
        return self.users if self.cfg == PREDICT else self.user_daily.select("user_id").distinct()

    def make_sources(self):
        c = self.cfg
        return [ca.reengagement(self.uid, c), ca.covisit_candidates(self.uid, self.matrix, c), ca.category_pop(self.item_daily, self.dim, self.user_category, c), ca.city_cat_pop(self.item_daily, self.dim, self.user_category, self.user_city, c), ca.global_pop(self.item_daily, self.asked, c)]

    def make_pool(self):
        sources = [s.join(self.asked, "user_id", "left_semi") for s in self.sources] if self.cfg == PREDICT else self.sources
        return ca.merge(sources, self.cfg)

    def make_user_features(self):
        return features.user_features(self.user_daily, self.uid, self.dim, self.cfg)

    def make_item_features(self):
        return features.item_features(self.item_daily, self.dim, self.cfg)

    def make_pair_features(self):
        return features.pair_features(self.uid, self.pool, self.cfg)

    def make_ranker_input(self):
        return features.ranker_input(self.pool, self.user_features, self.item_features, self.pair_features)

    def make_gt(self):
        return features.ground_truth(self.events)

    def make_labelled(self):
        return features.labelled(self.pool, self.gt)

    def make_scored(self):
        return ranking.LinearRanker().score(self.ranker_input)

    def make_raw(self):
        return ranking.rerank_raw(self.scored, self.cfg)

    def make_submission(self):
        return ranking.submission(self.raw, self.users, self.item_daily, self.dim, self.cfg)

    def make_pos(self):
        return eda.clean_events(self.events)

    def make_pairs(self):
        return st.pair_flags(self.events)

    def make_pairs_dim(self):
        return st.pairs_with_dim(self.pairs, self.dim)

    def make_pair_view(self):
        return st.pair_view(self.pairs_dim)

    def make_funnel(self):
        return st.funnel(self.pairs)

    def make_items(self):
        return st.item_metrics(self.snap, self.dim)

    def make_sellers(self):
        return st.seller_metrics(self.items)

    def make_popularity(self):
        return eda.item_popularity(self.pos, self.snap_clean, self.dim)

    def make_profile(self):
        return eda.user_profile(self.users, self.pos)

    def make_base_scores(self):
        return eda.baseline_scores(self.profile, self.popularity)

    def make_baseline(self):
        return eda.baseline_top(self.base_scores)

    def make_alt_items(self):
        return altranker.item_features(self.snap_clean, self.dim, C.gt_start)

    def make_alt_users(self):
        return altranker.user_features(self.pos, C.gt_start)

    def make_alt_pairs(self):
        return altranker.training_pairs(self.pos, self.base_scores, C.gt_start)


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _gbt(s: Stages) -> DataFrame:
    rows = s.ranker_input.join(s.gt, ["user_id", "item_id"], "left").withColumn("label", features.graded_label(F.coalesce("gt_weighted_score", F.lit(0.0))).cast("double"))
    use = ["candidate_score", "ui_total_weighted", "ui_recent_weighted", "i_recent_weighted", "u_total_weighted", "ui_category_match", "ui_days_since_last"]
    return ranking.GbtRanker(use, iterations=5, depth=3).fit(rows).transform(rows).select("user_id", "item_id", "pred_score")


def _lambda(s: Stages):
    """A ranker fitted to graded labels on sampled pairs of nine tenths of the users, stopped by the others."""
    rows = features.sampled(s.labelled).join(features.user_split(s.user_daily), "user_id").join(s.ranker_input, ["user_id", "item_id"])
    return LambdaRanker(features.NUMERIC, rounds=8, patience=3).fit(sinks.stage(rows, "training"))


def _lambda_ndcg(s: Stages) -> DataFrame:
    """NDCG of held-out users' whole candidate lists: by the fitted ranker and by candidate scores."""
    scores = _lambda(s).transform(s.ranker_input)
    held = s.labelled.join(features.user_split(s.user_daily).filter("is_val = 1"), "user_id").join(scores, ["user_id", "item_id"])
    kept = sinks.stage(held, "held")
    return ndcg(kept, "pred_score").withColumn("ranker", F.lit("lambdarank")).unionByName(ndcg(kept, "candidate_score").withColumn("ranker", F.lit("candidate_score")))


def _alt_frame(s: Stages) -> DataFrame:
    return altranker.training_frame(s.alt_pairs, s.alt_items, s.alt_users)


def _alt_scores(s: Stages) -> DataFrame:
    """The second ranker: fitted to its frame, a fifth of the users held out; ten candidates for each test user."""
    numbers = [c for c in (*altranker.ITEM_FEATURES, *altranker.USER_FEATURES, *altranker.CROSS_FEATURES) if c not in ("i_ad_type", "i_seller_type", "u_top_city", "x_candidate_source")]
    frame = _alt_frame(s)
    rows = sinks.stage(frame.join(altranker.valid_users(frame), "user_id"), "alt")
    pool = s.base_scores.select("user_id", "item_id", F.col("source").alias("x_candidate_source"))
    return altranker.ranked(LambdaRanker(numbers, rounds=5, patience=2).fit(rows).transform(altranker.training_frame(pool, s.alt_items, s.alt_users)))


def _variants(s: Stages) -> DataFrame:
    """All variants in one table and one plan, listings and events written once: the driver's memory holds no plan for each."""
    s.keep("dim", "events")
    made = {"baseline_popularity": s.baseline, "rank_only": s.fresh("raw"), "rank_rerank": ranking.greedy_rerank(s.scored, s.dim, C.train_end)}
    recs = functools.reduce(DataFrame.unionByName, (rows.select("user_id", "item_id", "rank", F.lit(name).alias("variant")) for name, rows in made.items()))
    rows, names = evaluation.exposure(recs, s.dim, by=["variant"]), s.spark.createDataFrame([(name,) for name in made], "variant string")
    both = evaluation.recall_ndcg(rows, s.gt, C.final_k, names).join(F.broadcast(evaluation.shown(rows, s.dim, names)), "variant")  # a row for each variant
    return both.select(*(c for c in both.columns if c != "variant"), "variant")


def _deltas(s: Stages) -> DataFrame:
    """What re-ranking changes against ranking alone."""
    v = _variants(s).filter("variant <> 'baseline_popularity'")
    after, before = (lambda c, n=n: F.sum(F.when(F.col("variant") == n, F.col(c)).otherwise(0.0)) for n in ("rank_rerank", "rank_only"))
    delta = lambda c, name: F.round(after(c) - before(c), 6).alias(name)
    return v.agg(delta("recall", "delta_recall"), delta("gini_item_exposure", "delta_gini_item"), delta("fresh_slot_pct", "delta_fresh_pp"))


QUERIES: dict[str, Callable[[Stages], DataFrame]] = {
    "user_daily": lambda s: s.user_daily,
    "item_daily": lambda s: _rounded(s.fresh("item_daily"), "avg_dwell"),
    "user_item_daily": lambda s: s.fresh("uid"),
    "user_category": lambda s: s.fresh("user_category"),
    "user_category_whole_window": lambda s: rollups.user_attribute(s.events, "category"),
    "user_city": lambda s: s.user_city,
    "event_type_daily": lambda s: rollups.event_type_daily(s.events),
    "event_share": lambda s: rollups.event_share(s.events),
    "clean_dim": lambda s: eda.clean_dim(s.dim),
    "clean_snapshot": lambda s: s.snap_clean,
    "clean_interactions": lambda s: eda.clean_interactions(s.inter),
    "clean_events": lambda s: s.pos,
    "reengagement": lambda s: s.sources[0],
    "covisit_matrix": lambda s: s.matrix,
    "covisit_candidates": lambda s: s.sources[1],
    "category_pop": lambda s: s.sources[2],
    "city_cat_pop": lambda s: s.sources[3],
    "global_pop": lambda s: s.sources[4],
    "merge_candidates": lambda s: s.fresh("pool"),
    "user_features": lambda s: s.user_features,
    "item_features": lambda s: s.item_features,
    "pair_features": lambda s: s.pair_features,
    "temporal_features": lambda s: features.temporal_features(s.pair_features, s.user_features, s.item_features),
    "ranker_input": lambda s: s.ranker_input,
    "feature_diagnostics": lambda s: features.diagnostics(s.user_features),
    "internal_gt": lambda s: s.gt,
    "graded_labels": lambda s: s.labelled,
    "negative_sample": lambda s: features.sampled(s.labelled),
    "user_split": lambda s: features.user_split(s.user_daily),
    "group_sizes": lambda s: features.group_sizes(s.pool),
    "linear_scores": lambda s: s.scored.select("user_id", "item_id", "pred_score"),
    "gbt_scores": _gbt,
    "rerank_raw": lambda s: s.fresh("raw"),
    "rerank_health": lambda s: ranking.rerank_health(s.scored, s.dim),
    "greedy_rerank": lambda s: ranking.greedy_rerank(s.scored, s.dim, C.train_end),
    "submission": lambda s: s.fresh("submission"),
    "submission_checks": lambda s: ranking.submission_checks(s.submission, s.users, s.dim),
    "recall_ndcg": lambda s: evaluation.recall_ndcg(s.raw, s.gt, C.final_k),
    "candidate_recall": lambda s: evaluation.candidate_recall(s.pool, s.gt),
    "source_breakdown": lambda s: evaluation.source_breakdown(s.pool, s.gt),
    "marketplace_health": lambda s: evaluation.marketplace_health(s.submission, s.dim, s.item_daily),
    "variant_comparison": _variants,
    "variant_deltas": _deltas,
    "item_popularity": lambda s: s.popularity,
    "user_profile": lambda s: s.profile,
    "baseline_top10": lambda s: s.baseline,
    "baseline_health": lambda s: eda.recommendation_health(s.baseline, s.dim),
    "eda_01_category_supply": lambda s: eda.supply(s.dim, "category"),
    "eda_02_city_supply": lambda s: eda.city_top(s.dim),
    "eda_03_category_demand": lambda s: eda.demand(s.pos, "category"),
    "eda_04_city_demand": lambda s: eda.demand(s.pos, "city_name").orderBy(F.desc("n_events"), "city_name").limit(20),
    "eda_05_weekly_events": lambda s: eda.weekly(s.pos),
    "eda_06_cold_start": lambda s: eda.cold_start(s.users, s.pos, s.inter),
    "eda_07_interaction_tier": lambda s: eda.interaction_tiers(s.users, eda.clean_interactions(s.inter)),
    "eda_08_event_types": lambda s: eda.event_breakdown(s.pos),
    "eda_09_session_tier": lambda s: eda.session_tiers(s.pos),
    "eda_10_weekly_market": lambda s: eda.weekly_market(s.snap_clean),
    "pair_flags": lambda s: s.pairs,
    "d30_funnel": lambda s: s.funnel,
    "daily_counts": lambda s: st.daily_counts(s.events),
    "daily_pair_rates": lambda s: st.daily_pair_rates(s.events),
    "dwell_quantiles": lambda s: st.dwell_quantiles(s.events),
    "user_positives": lambda s: st.user_positives(s.events),
    "cold_start_segments": lambda s: st.user_segments(s.users, s.events),
    "gap_hours": lambda s: st.gap_hours(s.pairs),
    "category_heatmap": lambda s: st.category_heatmap(s.events),
    "device_surface": lambda s: st.device_surface(s.events),
    "item_metrics": lambda s: s.items,
    "seller_metrics": lambda s: s.sellers,
    "cr_by_category": lambda s: st.contact_rate(s.pairs_dim, ["category"]),
    "cr_by_ad_seller": lambda s: st.contact_rate(s.pairs_dim, ["ad_type", "seller_type"]),
    "snapshot_cr_category": lambda s: st.snapshot_rate(s.items, ["category"]),
    "snapshot_cr_ad_seller": lambda s: st.snapshot_rate(s.items, ["ad_type", "seller_type"]),
    "age_decay": lambda s: st.age_decay(s.items),
    "image_sample": lambda s: st.image_sample(s.items),
    "geo_top": lambda s: st.geo_top(s.items),
    "seller_cohort": lambda s: st.seller_cohort(s.items),
    "segment_audit": lambda s: st.segment_audit(s.dim),
    "segment_overall": lambda s: st.segment_overall(s.pairs_dim),
    "segment_volume": lambda s: st.segment_volume(s.pairs_dim),
    "segment_category": lambda s: st.contact_rate(s.pairs_dim, ["segment", "category"]),
    "seller_distribution": lambda s: st.seller_distribution(s.pairs_dim),
    "segment_gini": lambda s: st.segment_gini(s.pairs_dim),
    "snapshot_gini": lambda s: st.snapshot_gini(s.items),
    "segment_comparison": lambda s: st.comparison(s.pairs_dim),
    "gini_item_contacts": lambda s: evaluation.gini(s.items, "contacts"),
    "lorenz_items": lambda s: evaluation.lorenz(s.items, "contacts"),
    "top_share_items": lambda s: evaluation.top_share(s.items, "contacts"),
    "slide_core": lambda s: st.slide_core(s.pairs_dim),
    "dwell_hist": lambda s: st.dwell_histogram(s.pairs),
    "audit_surface": lambda s: st.attribute_share(s.events, "surface"),
    "audit_device": lambda s: st.attribute_share(s.events, "device"),
    "audit_dwell": lambda s: st.dwell_audit(s.events),
    "audit_session": lambda s: st.session_audit(s.events),
    "audit_dc_cr": lambda s: st.direct_audit(s.events),
    "audit_flag_crosstab": lambda s: st.flag_crosstab(s.events),
    "exposure_vs_cr": lambda s: st.exposure_vs_rate(s.pairs_dim),
    "segment_seller_crosstab": lambda s: st.segment_seller_crosstab(s.pairs_dim),
    "alt_item_features": lambda s: s.alt_items,
    "alt_user_features": lambda s: s.alt_users,
    "alt_training_pairs": lambda s: s.alt_pairs,
    "alt_popular_pairs": lambda s: altranker.popular_pairs(s.pos, C.gt_start),
    "alt_training_frame": _alt_frame,
    "alt_holdout": lambda s: altranker.holdout(s.pos, C.gt_start, C.gt_end),
    "alt_ranker_top10": _alt_scores,
    "lambdarank_scores": lambda s: _lambda(s).transform(s.ranker_input),
    "lambdarank_ndcg": _lambda_ndcg,
    "pair_view": lambda s: s.pair_view,
    "slide_rates": lambda s: st.slide_rates(s.pair_view),
    "slide_concentration": lambda s: st.slide_concentration(s.pair_view),
    "cold_tiers": lambda s: st.cold_tiers(eda.cold_start(s.users, s.pos, s.inter)),
    "summary_metrics": lambda s: st.summary_metrics(s.funnel, st.user_segments(s.users, s.events), s.pairs, s.pairs_dim, s.sellers),
    "exposure_ratios": lambda s: st.exposure_ratios(st.exposure_vs_rate(s.pairs_dim)),
    "segment_proxy": lambda s: verify.segment_proxy(s.dim),
    "verify_d30": lambda s: verify.verify_d30(s.pairs_dim, s.funnel),
    "verify_segments": lambda s: verify.verify_segments(s.pairs_dim, s.dim, s.funnel),
    "other_interaction_verdicts": lambda s: verify.other_interaction_verdicts(st.attribute_share(s.events, "surface"), st.dwell_audit(s.events), st.session_audit(s.events), st.direct_audit(s.events), st.flag_crosstab(s.events)),
    "verify_slices": lambda s: st.verify_slices(s.pairs_dim, s.funnel),
}


#: The same stages as of the end of training, for test users.
AT_PREDICTION: dict[str, Callable[[Stages], DataFrame]] = {
    "merge_candidates_predict": lambda s: s.fresh("pool"),
    "ranker_input_predict": lambda s: s.ranker_input,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = {name: (lambda spark, sf_dir, f=f: f(Stages(spark, sf_dir))) for name, f in QUERIES.items()}
    return made | {name: (lambda spark, sf_dir, f=f: f(Stages(spark, sf_dir, PREDICT))) for name, f in AT_PREDICTION.items()}
