"""Every operator of the inventory as a runnable query over the supplied tables.

``QUERIES[name](spark, sf_dir) -> DataFrame``.  Inputs are the parquet tables
mapped by :mod:`rekindle.sources.adapters`; each query is the lazy plan of the
operator applied to the canonical tables (and to the upstream operators it
needs).  Double columns are rounded to 6 decimals at the output so results can
be compared with an independent SQL engine (float sums depend on order).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ADAPTER_A, ADAPTER_B
from ..functions.exprs import round_doubles
from ..operators import boost as BO
from ..operators import calibration as CA
from ..operators import correlation as CO
from ..operators import events as EV
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import quality as Q
from ..operators import stats as SS
from ..operators import study as ST
from ..operators import timeline as TL
from ..session import bucketed, cut_lineage, shared_folder
from ..sources import adapters as A
from ..sources import io as IO


class Tables:
    """Canonical tables and shared upstream plans for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.d = spark, sf_dir
        self.cfg, self.cfg_b = ADAPTER_A, ADAPTER_B

    @cached_property
    def orders(self): return A.orders_a(self.spark, self.d)
    @cached_property
    def orders_b(self): return A.orders_b(self.spark, self.d)
    @cached_property
    def lines(self): return A.lines_a(self.spark, self.d)
    @cached_property
    def members(self): return A.members_a(self.spark, self.d)
    @cached_property
    def scored(self): return A.scored_fixture(self.spark, self.d)
    @cached_property
    def valid(self): return TL.valid_purchases(self.orders, self.cfg)
    @cached_property
    def valid_b(self): return TL.valid_purchases(self.orders_b, self.cfg_b)
    @cached_property
    def unique(self): return TL.unique_orders(self.valid)
    @cached_property
    def gthr(self): return TL.gaps_with_threshold(self.valid, self.cfg)
    @cached_property
    def gthr_b(self): return TL.gaps_with_threshold(self.valid_b, self.cfg_b)
    @cached_property
    def events(self): return EV.revival_events(self.gthr)
    @cached_property
    def events_b(self): return EV.revival_events(self.gthr_b)
    # events and label orders come from one valid table: the join-free label path
    @cached_property
    def labelled(self):
        return EV.revival_labels(self.events, TL.unique_orders(self.valid, TL.LABEL_COLS),
                                 self.cfg.window_days, same_source=True)
    @cached_property
    def labelled_b(self):
        return EV.revival_labels(self.events_b, TL.unique_orders(self.valid_b, TL.LABEL_COLS),
                                 self.cfg_b.window_days, same_source=True)
    @cached_property
    def samples(self):
        # the numbering materialises the rows (once); this is a join with its offsets
        return EV.samples(self.orders, self.cfg)
    @cached_property
    def orders_fl(self):
        # stage-2 order table feeds three feature branches: materialise once
        return cut_lineage(TL.scan_orders_flagged(self.orders, self.cfg))
    @cached_property
    def lines_v(self): return FE.scan_lines_valid(self.lines, self.cfg)
    @cached_property
    def members_c(self): return FE.scan_members(self.members)
    @cached_property
    def hist(self): return FE.history_features(self.samples, self.orders_fl, self.cfg)
    @cached_property
    def f1(self): return FE.f1_history(self.samples, self.orders_fl, self.cfg, self.hist)
    @cached_property
    def f2(self): return FE.f2_t0_order(self.samples, self.orders_fl, self.cfg)
    @cached_property
    def features(self):
        return FE.assemble_features(self.samples, self.orders_fl, self.lines_v, self.members_c, self.cfg)
    @cached_property
    def features_clean(self): return FE.clean_ranges(self.features, self.cfg)
    @cached_property
    def features_stored(self): return cut_lineage(self.features_clean)  # for readers of several passes
    @cached_property
    def sgaps(self): return cut_lineage(ST.study_gaps(self.orders, self.cfg))  # every sweep reads it twice


NUMERIC_FEATURES = [c for c in FE.FEATURE_COLS if c not in FE.CATEGORICAL_COLS]
RATIO_FEATURES = FE.RATIO_FEATURES

# ---------------------------------------------------------------------------- registry
_Q: dict[str, Callable[[Tables], DataFrame]] = {}


def q(name):
    def deco(fn):
        _Q[name] = fn
        return fn
    return deco


ORDER_OUT = ["member_id", "order_code", "order_ts", "status", "sales_amount", "ts_count", "qty",
             "total_price", "total_discount", "total_coupon_discount", "channel", "payment",
             "shipping"]


def _nz(c):  # -0.0 -> 0.0
    return (F.col(c) + F.lit(0.0)).alias(c)


# --- sources ---------------------------------------------------------------------------
@q("scan_orders")
def _(t): return t.orders.select(*[_nz(c) if c in ("total_discount", "total_coupon_discount")
                                   else F.col(c) for c in ORDER_OUT])
@q("scan_orders_events")
def _(t): return t.orders_b.select("member_id", "order_code", "order_ts", "status", "sales_amount")
@q("scan_orders_flagged")
def _(t): return t.orders_fl.select("member_id", "order_code", "order_ts", "status", "channel",
                                    "payment", "shipping", "is_return", "is_valid", "is_nonfail")
@q("scan_lines_valid")
def _(t): return t.lines_v
@q("scan_members")
def _(t): return t.members_c
@q("shop_filter")
def _(t): return TL.shop_filter(t.orders, "payment", "1-URGENT").select(
    "member_id", "order_code", "order_ts", "status", "sales_amount")

# --- sinks, and scans of what they wrote ---------------------------------------------------
def _written_samples(t):
    path = shared_folder(t.spark, "samples")
    IO.write_samples(t.samples, path)
    return path
@q("scan_samples")
def _(t): return IO.scan_samples(t.spark, _written_samples(t))
@q("samples_file_order")
def _(t):
    # L3: ids rise inside every file, and from each file to the next one by name
    rows = t.spark.read.parquet(_written_samples(t)).select(
        "sample_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    in_file = Window.partitionBy("file").orderBy("at")
    files = (rows.withColumn("falls", (F.col("sample_id") <= F.lag("sample_id").over(in_file)).cast("long"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("lo"), F.max("sample_id").alias("hi"),
                                  F.coalesce(F.sum("falls"), F.lit(0)).alias("falls")))
    by_name = Window.orderBy("file")  # a row a file
    return files.withColumn("overlaps", F.col("lo") <= F.lag("hi").over(by_name)).agg(
        F.sum("n").alias("n"), F.sum("falls").alias("rows_out_of_order"), F.count_if("overlaps").alias("files_out_of_order"))
def _written_features(t):
    path = shared_folder(t.spark, "features")
    IO.write_split_features(t.features_stored, path)
    return IO.scan_features(t.spark, path)
@q("scan_features")
def _(t): return _written_features(t)[0].select(*FE.ID_COLS, *FE.FEATURE_COLS)
@q("feature_subset")
def _(t):
    df, cols = _written_features(t)
    full, rest = df.select(*FE.ID_COLS, *cols), df.drop(*t.cfg.snapshot_cols)
    kept = MD.feature_columns(rest)
    counts = full.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "feature", "n_present")
    return counts.withColumn("without_snapshot", F.col("feature").isin(kept))
@q("write_metric_tables")
def _(t):
    folder = shared_folder(t.spark, "metrics")
    tables = {"metric_table": round_doubles(M.metric_table(t.scored)), "tiers": round_doubles(M.tiers(t.scored))}
    IO.write_metric_tables(tables, folder)
    back = [t.spark.read.schema(df.schema).option("header", True).csv(f"{folder}/{name}") for name, df in tables.items()]
    return back[0].join(back[1].groupBy("split").agg(F.sum("n").alias("n_in_tiers")), "split", "left")
@q("scan_pages")
def _(t):
    path = shared_folder(t.spark, "pages")
    p = A.read_table(t.spark, t.d, "pages")
    titled = p.select((F.col("page_id") % 3).alias("ShopId"), F.col("page_id").alias("SalePageId"),
                      F.concat(F.lit('"'), "url", F.lit('", x')).alias("Title"))
    titled.write.option("header", True).option("escape", '"').csv(path)
    return IO.scan_pages(t.spark, path, shop_id="1")

# --- filters / predicates --------------------------------------------------------------
@q("valid_purchases")
def _(t): return t.valid.select("member_id", "order_code", "order_ts", "status", "sales_amount", "date")
@q("valid_definitions")
def _(t): return TL.valid_definitions(t.orders, t.cfg)
@q("order_flags")
def _(t): return TL.order_flags(t.orders, t.cfg).select("order_code", "is_return", "is_valid", "is_nonfail")
@q("clean_ranges")
def _(t): return t.features_clean.select("sample_id", "age_at_t0", "days_since_register")
@q("dormancy_threshold")
def _(t): return t.gthr.select("member_id", "date_from", "date_to", "gap_days", "ci_days",
                               "threshold_days")
@q("dormancy_threshold_report")
def _(t): return TL.threshold_report(t.gthr, t.cfg)
@q("censor_report")
def _(t): return EV.censor_report(t.labelled, t.cfg.censor_cutoff)
@q("embargo_split")
def _(t): return EV.embargo_split(EV.censor(t.labelled, t.cfg.censor_cutoff), t.cfg,
                                  keep_embargo=True).select("member_id", "t0_date", "label", "split")

# --- windows ----------------------------------------------------------------------------
@q("dedup_orders")
def _(t): return TL.dedup_orders(t.lines, "order_code").select(
    "order_code", "member_id", "sale_page_id", "qty", "unit_price")
@q("daily_timeline")
def _(t): return TL.daily_timeline(t.valid)
@q("purchase_gaps")
def _(t): return TL.purchase_gaps(TL.daily_timeline(t.valid))
@q("dynamic_ci")
def _(t): return t.gthr.select("member_id", "date_to", "gap_days", "n_prior", "ci_days", "ci_branch")
@q("best_order_per_day")
def _(t): return TL.best_order_per_day(t.valid_b, t.cfg_b)
@q("samples")
def _(t): return t.samples.select(*EV.SAMPLE_COLS)

# --- joins ------------------------------------------------------------------------------
@q("revival_events")
def _(t): return t.events
@q("revival_events_b")
def _(t): return t.events_b
@q("revival_labels")
def _(t): return t.labelled
@q("revival_labels_b")
def _(t): return t.labelled_b
@q("revival_labels_join")
def _(t): return EV.revival_labels(t.events, TL.unique_orders(t.valid, TL.LABEL_COLS),
                                   t.cfg.window_days)
@q("revival_labels_join_b")
def _(t): return EV.revival_labels(t.events_b, TL.unique_orders(t.valid_b, TL.LABEL_COLS),
                                   t.cfg_b.window_days)
@q("semi_reduce")
def _(t): return t.lines_v.join(t.samples.select("member_id"), "member_id", "left_semi").select(
    "member_id", "order_code", "sale_page_id", "unit_price")
@q("t0_order_lookup")
def _(t): return FE.t0_order_lookup(t.samples, t.orders_fl).select(
    "sample_id", "t0_order_code", "sales_amount", "ts_count", "channel")
@q("t0_order_lookup_bucketed")
def _(t): return FE.t0_order_lookup(t.samples, bucketed(t.orders_fl, ["order_code"], "orders_fl")).select(
    "sample_id", "t0_order_code", "sales_amount", "ts_count", "channel")
@q("t0_lines")
def _(t): return t.samples.select("sample_id", "t0_order_code").join(
    t.lines_v.select(F.col("order_code").alias("t0_order_code"), "sale_page_id", "unit_price"),
    "t0_order_code").select("sample_id", "sale_page_id", "unit_price")
@q("familiar_product")
def _(t): return FE.f3_products(t.samples, t.lines_v, t.cfg).select(
    "sample_id", "t0_buys_familiar_product")
@q("familiar_product_null_safe")
def _(t): return FE.f3_products(t.samples, t.lines_v, t.cfg.with_(null_safe_pages=True)).select(
    "sample_id", "t0_buys_familiar_product")
@q("member_dim_join")
def _(t): return FE.member_dim_join(t.samples, t.members_c).select(
    "sample_id", "member_id", "register_source", "register_date", "birthday", "card_level")
@q("assemble_features")
def _(t): return t.features
@q("window_range_join")
def _(t): return ST.window_range_join(t.sgaps, 90)
@q("window_range_join_personal")
def _(t): return ST.window_range_join_personal(t.sgaps, 2.0)
@q("split_overlap")
def _(t): return EV.split_overlap(t.samples)
@q("attach_member_ci")
def _(t): return t.sgaps.select("member_id", "t_revival", "gap", "ci")

# --- aggregations -----------------------------------------------------------------------
@q("value_share")
def _(t): return M_value_share(t)
def M_value_share(t): return TL.value_share(t.orders, "status")
@q("table_overview")
def _(t): return TL.table_overview(t.orders)
@q("sign_shares")
def _(t): return TL.sign_shares(t.orders)
@q("purchase_count_dist")
def _(t): return TL.purchase_count_dist(t.unique)
@q("item_count_dist")
def _(t): return TL.item_count_dist(t.unique)
@q("static_ci")
def _(t): return TL.static_ci_stats(TL.purchase_gaps(TL.daily_timeline(t.valid)), t.unique)
@q("gap_dist")
def _(t): return TL.gap_dist(TL.purchase_gaps(TL.daily_timeline(t.valid)))
@q("ci_stats")
def _(t): return TL.ci_stats(t.gthr)
@q("threshold_sweep")
def _(t): return ST.threshold_sweep(t.sgaps, t.cfg)
@q("window_stats")
def _(t): return ST.window_stats(t.sgaps, t.cfg, 3.0, 90, "90d")
@q("window_sweep")
def _(t): return ST.window_sweep(t.sgaps, t.cfg)
@q("k_m_grid")
def _(t): return ST.k_m_grid(t.sgaps, t.cfg)
@q("k_m_pivot")
def _(t): return ST.k_m_pivot(ST.k_m_grid(t.sgaps, t.cfg))
@q("best_window")
def _(t): return ST.best_window(ST.window_sweep(t.sgaps, t.cfg))
@q("best_window_100")
def _(t): return ST.best_window(ST.window_sweep(t.sgaps, t.cfg), 100)
@q("dormancy_length_dist")
def _(t): return ST.dormancy_length_dist(t.sgaps, t.cfg)
@q("return_rates")
def _(t): return ST.return_rates(t.orders, t.cfg)
@q("monthly_volume")
def _(t): return ST.monthly_volume(t.orders, t.cfg)
@q("split_summary")
def _(t): return EV.split_summary(EV.censor(t.labelled, t.cfg.censor_cutoff), t.cfg)
@q("split_month_dist")
def _(t): return EV.split_month_dist(t.samples)
@q("funnel")
def _(t): return EV.funnel(t.orders, t.cfg)
@q("funnel_checks")
def _(t): return EV.funnel_checks(t.samples, t.cfg)
@q("funnel_checks_fixture")
def _(t): return EV.funnel_checks(t.samples, t.cfg.with_(label_rate_bounds=(0.2, 0.4)))
@q("f1_history")
def _(t): return t.f1
@q("f2_t0_order")
def _(t): return t.f2
@q("f3_products")
def _(t): return FE.f3_products(t.samples, t.lines_v, t.cfg)
@q("f4_member")
def _(t): return FE.f4_member(t.samples, t.members_c)
@q("f5_interactions")
def _(t): return t.features.select("sample_id", *FE.F5_COLS)
@q("f6_recent")
def _(t): return FE.f6_recent(t.samples, t.orders_fl, t.cfg, t.hist)
@q("f6_recent_b")
def _(t):
    s = EV.samples(t.orders_b, t.cfg_b)
    return FE.f6_recent(s, TL.scan_orders_flagged(t.orders_b, t.cfg_b), t.cfg_b.with_(recent_days=(1, 2, 7),
                                                                                       pre_dormancy_days=3))
@q("f1_history_b")
def _(t):
    s = EV.samples(t.orders_b, t.cfg_b)
    return FE.f1_history(s, TL.scan_orders_flagged(t.orders_b, t.cfg_b), t.cfg_b)
@q("hist_mode_channel")
def _(t): return FE.hist_mode(t.samples, t.orders_fl, "channel", "hist_main_channel")
@q("hist_mode")
def _(t): return FE.hist_mode(t.samples, t.orders_fl, "payment", "hist_main_payment")
@q("missing_rates")
def _(t): return Q.missing_rates(t.features_clean)
@q("group_missing_median")
def _(t): return Q.group_missing_median(Q.missing_rates(t.features_clean))
@q("feature_quantiles")
def _(t): return Q.feature_quantiles(t.features_stored, NUMERIC_FEATURES)
@q("extreme_values")
def _(t): return Q.extreme_values(t.features_stored, RATIO_FEATURES)
@q("leakage_audit")
def _(t): return FE.leakage_audit(t.samples, t.orders_fl, t.cfg, t.hist)
@q("histograms")
def _(t): return ST.histogram(t.unique.groupBy("member_id").count(), "count", 20, kind="linear")
@q("histogram_unit")
def _(t): return ST.histogram(t.unique, "ts_count", 0, kind="unit", clip_upper=5)
@q("histogram_unit_20")
def _(t): return ST.histogram(t.unique, "ts_count", 0, kind="unit", clip_upper=20)
@q("histogram_unit_30")
def _(t): return ST.histogram(t.unique, "qty", 0, kind="unit", clip_upper=30)
@q("histogram_log")
def _(t): return ST.histogram(t.unique.groupBy("member_id").count(), "count", 59, kind="log")
@q("histogram_log_small")
def _(t): return ST.histogram(t.scored.withColumn("x", F.col("score") * 3), "x", 12, kind="log", by="label")
@q("clean_report")
def _(t): return Q.clean_report(t.features, t.features_clean)

# --- sort / set ---------------------------------------------------------------------------
@q("topk_features")
def _(t): return M.topk(Q.missing_rates(t.features_clean), "missing_pct", 10).select(
    "rank", "feature", "missing_pct")
@q("union_splits")
def _(t): return EV.union_splits(t.samples.filter("split = 'train'"),
                                 t.samples.filter("split = 'test'")).select(*EV.SAMPLE_COLS)
@q("member_intersection")
def _(t): return EV.member_intersection(t.samples.filter("split = 'train'"),
                                        t.samples.filter("split = 'test'"))
@q("distinct_pairs")
def _(t): return t.samples.select("sample_id", "t0_order_code").join(
    t.lines_v.select(F.col("order_code").alias("t0_order_code"), "sale_page_id"),
    "t0_order_code").select("sample_id", "sale_page_id").distinct()
@q("topk_overlap")
def _(t):
    tr = M.topk(Q.missing_rates(t.features_clean.filter("split = 'train'")), "missing_pct", 10)
    te = M.topk(Q.missing_rates(t.features_clean.filter("split = 'test'")), "missing_pct", 10)
    return M.topk_overlap(tr, te, 10)

# --- metrics on the scored fixture ---------------------------------------------------------
@q("auc_roc")
def _(t): return M.auc_roc(t.scored)
@q("average_precision")
def _(t): return M.average_precision(t.scored)
@q("brier")
def _(t): return M.brier(t.scored)
@q("confusion_metrics")
def _(t): return M.confusion_metrics(t.scored)
@q("class_report")
def _(t): return M.class_report(t.scored)
@q("metric_table")
def _(t): return M.metric_table(t.scored)
@q("auc_gap")
def _(t): return M.auc_gap(t.scored)
@q("tiers")
def _(t): return M.tiers(t.scored)
@q("midband_calibration")
def _(t): return M.midband_calibration(t.scored)
@q("score_histogram")
def _(t): return M.score_histogram(t.scored)
@q("score_histogram_test")
def _(t): return M.score_histogram(t.scored.filter("split = 'test'"))
@q("coerce_numeric")
def _(t):
    o = A.read_table(t.spark, t.d, "orders")
    k = F.col("o_orderkey")
    mixed = (F.when(k % 3 == 0, F.col("o_orderpriority")).when(k % 3 == 1, k.cast("string"))
             .when(k % 6 == 2, F.concat((k % 97).cast("string"), F.lit(".5"))))
    return IO.coerce_numeric(o.select(k.alias("order_code"), mixed.alias("x")), ["x"])
@q("midband_share")
def _(t): return M.midband_share(t.scored)
@q("smd_profile")
def _(t): return M.smd_profile(t.scored, ["f1", "f2"])
@q("direction")
def _(t): return M.direction(t.scored, ["f1", "f2"])

# --- next steps of the study ---------------------------------------------------------------------
@q("mann_whitney")
def _(t): return SS.mann_whitney(t.features_stored, RATIO_FEATURES)
@q("chi_square")
def _(t): return SS.chi_square(t.features_stored, ["t0_channel", "t0_payment", "gender", "country_code"])
@q("spearman")
def _(t): return CO.spearman(t.scored, ["f1", "f2", "score"]).drop("n")


def _rounded_features(t):  # equal values stay ties in any engine
    return t.features_stored.select("sample_id", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in NUMERIC_FEATURES])


@q("spearman_features")
def _(t): return CO.spearman(_rounded_features(t), NUMERIC_FEATURES)
@q("prune_features")
def _(t): return CO.pruning(_rounded_features(t), NUMERIC_FEATURES)
@q("target_encode")
def _(t):
    f = t.features_stored
    return SS.target_encode(f, ["t0_payment", "country_code"]).select("sample_id", "t0_payment_te", "country_code_te")
@q("winsorise")
def _(t): return SS.winsorise(t.features_stored, RATIO_FEATURES).select("sample_id", *RATIO_FEATURES)
@q("subgroup_metrics")
def _(t): return SS.subgroup_metrics(t.scored.withColumn("odd", F.col("id") % 2), "odd")

def _maps(t): return CA.calibrated_maps(t.scored)
@q("calibration_table")
def _(t): return CA.calibration_table(_maps(t))
@q("reliability")
def _(t): return CA.reliability(_maps(t))
@q("calibrated_tiers")
def _(t): return CA.calibrated_tiers(_maps(t))
@q("logistic_fit")
def _(t):
    scaled = t.scored.select("split", "label", (F.col("f1") / 100000).alias("f1"), (F.col("f2") / 50).alias("f2"))
    coefs = CA.fit_logistic(scaled.filter("split = 'train'"), ["f1", "f2"], l2=0.01)
    return t.spark.createDataFrame(list(zip(["intercept", "f1", "f2"], coefs)), "term string, coefficient double")

# --- model (no SQL oracle; each has a companion row with exact properties) --------------------
_MODELS: dict = {}


def _model(t):
    """Features and the model of default size, fitted once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.d)
    if key not in _MODELS:
        f = t.features_stored
        cols = MD.feature_columns(f)
        _MODELS[key] = f, cols, MD.train_gbt(f.filter("split = 'train'"), cols)
    return _MODELS[key]


def _attribution(t):
    f, cols, m = _model(t)
    return MD.permutation_importance(m, f.filter("split = 'test'"), cols)
@q("model_scores")
def _(t):
    f, cols, m = _model(t)
    return MD.score_split(m, f)
@q("model_scores_check")
def _(t):
    f, cols, m = _model(t)
    s = MD.score_split(m, f)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"),
                                  F.count_if(F.col("score").between(0, 1)).alias("in_range"),
                                  F.count_distinct("sample_id").alias("ids"))
@q("model_metrics")
def _(t):
    f, cols, m = _model(t)
    return MD.evaluate(MD.score_split(m, f), "gbt")
@q("model_metrics_check")
def _(t):
    f, cols, m = _model(t)
    e = MD.evaluate(MD.score_split(m, f), "gbt")
    unit = [F.col(c).between(0, 1) for c in ("auc_roc", "auc_pr", "brier", "precision", "recall", "f1")]
    ok = unit[0]
    for u in unit[1:]:
        ok = ok & u
    return e.select("model", "split", ok.alias("in_range"), (F.col("auc_roc") > 0.5).alias("better_than_chance"))
# --- boosted trees that know missing values: gains by SQL, the rest by exact properties -----------
def _boosted(t):
    """Features with encoded categories and the boosted model, fitted once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.d, "boosted")
    if key not in _MODELS:
        cats = list(FE.CATEGORICAL_COLS)
        f = cut_lineage(SS.target_encode(t.features_stored, cats))
        cols = [*NUMERIC_FEATURES, *[f"{c}_te" for c in cats]]
        _MODELS[key] = f, cols, {f"{c}_te" for c in cats}, BO.train_boosted(f.filter("split = 'train'"), cols, rounds=10)
    return _MODELS[key]


@q("split_gains")
def _(t):
    f = t.features_stored.filter("split = 'train'")
    x = BO.binned(f, RATIO_FEATURES, BO.bin_edges(f, RATIO_FEATURES, 8, exact=True))
    rows = x.select(F.lit(0).alias("node"), "bins", (F.lit(0.5) - F.col("label")).alias("g"), F.lit(0.25).alias("h"))
    names = F.array(*[F.lit(c) for c in RATIO_FEATURES])
    return BO.split_gains(BO.histogram(rows)).select(
        F.get(names, F.col("f")).alias("feature"), "bin", "missing_left", "gain", F.col("hl").alias("left_cover"))
@q("boosted_scores")
def _(t):
    f, _cols, _cats, m = _boosted(t)
    return BO.score_boosted(m, f)
@q("boosted_check")
def _(t):
    f, _cols, _cats, m = _boosted(t)
    s = BO.score_boosted(m, f)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score").between(0, 1)).alias("in_range"),
                                  F.count_distinct("sample_id").alias("ids")).join(
        M.auc_ap(s, by="split").select("split", (F.col("auc_roc") > 0.5).alias("better_than_chance")), "split")
@q("contributions")
def _(t):
    f, _cols, _cats, m = _boosted(t)
    return BO.contributions(m, f.filter("split = 'test'")).select("sample_id", "margin", "phi")
@q("contributions_check")
def _(t):
    f, cols, _cats, m = _boosted(t)
    x = BO.contributions(m, f)
    total = F.aggregate("phi", F.lit(0.0), lambda a, v: a + v)
    return x.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("phi") == len(cols)).alias("whole"),
        F.count_if(F.abs(total + F.lit(BO.base_value(m)) - F.col("margin")) > 1e-9).alias("off"))
@q("attribution")
def _(t):
    f, cols, _cats, m = _boosted(t)
    return BO.attribution(BO.contributions(m, f.filter("split = 'test'")), cols)
@q("contribution_direction")
def _(t):
    f, cols, cats, m = _boosted(t)
    return BO.contribution_direction(BO.contributions(m, f.filter("split = 'test'")), cols, cats)
@q("contribution_direction_check")
def _(t):
    f, cols, cats, m = _boosted(t)
    x = BO.contributions(m, f.filter("split = 'test'"))
    d, few = (BO.contribution_direction(y, cols, cats) for y in (x, x.orderBy("sample_id").limit(10)))
    top = BO.attribution(x, cols).filter("rank <= 5").select("feature", F.col("rank").alias("r"))
    ok = F.col("sign").isin("up", "down") == F.col("corr").isNotNull()
    return (d.join(top, "feature", "left").agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("rank") == F.col("r")).alias("same_rank"),
        F.count_if(ok & F.coalesce(F.abs("corr") <= 1.0 + 1e-9, F.lit(True))).alias("guarded"))
        .join(few.agg(F.count_if(F.col("sign").isin("n/a", "category")).alias("silent_for_ten_rows"))))
@q("gain_importance")
def _(t):
    f, cols, m = _model(t)
    return MD.gain_importance(m, cols, f)
@q("gain_importance_check")
def _(t):
    f, cols, m = _model(t)
    return MD.gain_importance(m, cols, f).agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("gain"), 6).alias("total"),
        F.count_if(F.col("gain") < 0).alias("negative"), F.max("rank").alias("last_rank"))
@q("key_feature_ranks")
def _(t):
    f, cols, m = _model(t)
    return MD.key_feature_ranks(MD.gain_importance(m, cols, f), FE.WATCH_LIST)
@q("key_feature_ranks_check")
def _(t):
    f, cols, m = _model(t)
    r = MD.key_feature_ranks(MD.gain_importance(m, cols, f), [*FE.WATCH_LIST, "no_such_feature"])
    return r.select("feature", F.col("rank").between(1, len(cols)).alias("ranked"))
@q("permutation_importance")
def _(t):
    return _attribution(t)
@q("permutation_importance_check")
def _(t):
    f, cols, m = _model(t)
    still = f.filter("split = 'test'").withColumn(cols[0], F.lit(1).cast(dict(f.dtypes)[cols[0]]))
    r = MD.permutation_importance(m, still, cols)
    return r.agg(F.count(F.lit(1)).alias("features"), F.count_distinct("feature").alias("names"),
                 F.max(F.when(F.col("feature") == cols[0], F.col("delta_auc"))).alias("delta_of_constant"),
                 F.count_if(F.abs("delta_auc") > 1).alias("out_of_range"))
def _baselines(t):
    """The comparison, computed once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.d, "baselines")
    if key not in _MODELS:
        f, cols, m = _model(t)
        _MODELS[key] = cut_lineage(SS.baseline_comparison(f, cols, m))
    return _MODELS[key]
@q("baseline_comparison")
def _(t): return _baselines(t)
@q("baseline_comparison_check")
def _(t):
    b = _baselines(t)
    unit = F.least("auc_roc", "auc_pr", "brier") >= 0
    return b.select("model", "split", (unit & (F.greatest("auc_roc", "auc_pr", "brier") <= 1)).alias("in_range"),
                    (F.col("auc_roc") > 0.5).alias("better_than_chance"),
                    ((F.col("model") == "gbt") <= (F.col("auc_lead") == 0)).alias("lead_of_itself_is_zero"))
@q("ablation")
def _(t):
    f, cols, _m = _model(t)
    return MD.ablation(f.filter("split = 'train'"), f.filter("split = 'test'"), cols, t.cfg.snapshot_cols)
@q("ablation_check")
def _(t):
    f, _cols, _m = _model(t)
    # a column that knows three labels in four: without it the test AUC falls
    told = F.when(F.pmod(F.xxhash64("sample_id"), F.lit(4)) > 0, F.col("label")).otherwise(1 - F.col("label"))
    g = f.withColumn("planted", told.cast("double"))
    r = MD.ablation(g.filter("split = 'train'"), g.filter("split = 'test'"), ["planted", *RATIO_FEATURES], ["planted"])
    return r.select("model", "split", (F.col("delta_auc") > 0.1).alias("misses_the_planted_column"))
@q("seeded_sample")
def _(t): return MD.seeded_sample(t.samples, 20, 42).select(*EV.SAMPLE_COLS)
@q("seeded_sample_check")
def _(t):
    a, b = MD.seeded_sample(t.samples, 20, 42), MD.seeded_sample(t.samples.repartition(5), 20, 42)
    return a.select("sample_id").union(b.select("sample_id")).groupBy("sample_id").count() \
        .groupBy(F.col("count").alias("times")).agg(F.count(F.lit(1)).alias("n"))

# element-wise doubles (bit-identical in any engine): no rounding, which would
# only introduce half-way ties between rounding implementations
NO_ROUND = {"scan_lines_valid", "dedup_orders", "semi_reduce", "t0_lines"}

NO_ORACLE = {"model_scores", "model_metrics", "gain_importance", "key_feature_ranks",
             "permutation_importance", "ablation", "seeded_sample",
             "boosted_scores", "baseline_comparison", "contributions", "attribution", "contribution_direction"}


def make(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = _Q[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(Tables(spark, sf_dir))
        return df if name in NO_ROUND else round_doubles(df)
    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: make(name) for name in _Q}
