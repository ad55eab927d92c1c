"""The 57 leak-free features as of the revival moment (F1-F6) and their
assembly (J9).

History semantics: a sample's history is every order of its member with
``order_ts < t0_date`` (midnight, T10).

Scale design (why there is no "explode history" join)
------------------------------------------------------
The reference joins every sample with all earlier orders of its member and
aggregates — Σ_samples |history| rows, quadratic for heavy members.  Here
the orders are first aggregated to one row per (member, day) (partial
aggregation before the shuffle), the sample rows are unioned into that
member-day timeline, and every history feature is a cumulative window frame
over it:

* ``ROWS UNBOUNDED PRECEDING .. 1 PRECEDING`` ordered by (day, kind) with the
  sample row sorted before the day rows of its own day -> exactly the days
  strictly before t0 (counts, sums, max, min, median and std of gaps);
* ``RANGE n PRECEDING .. 1 PRECEDING`` on the day number for the recency
  windows, with one extra frame for orders exactly at the lower midnight;
* the pre-dormancy window is anchored at the last purchase day, so it is
  evaluated on that day's row and carried to the sample row with
  ``last(.., ignorenulls)``.

Per member the timeline holds at most (#calendar days + #samples) rows,
whatever the order volume, so no task ever receives an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RevivalConfig
from ..functions.exprs import (as_ts, discount_floor, flag, floor_days, is_not,
                               nonzero_or_null, safe_div, sentinel_to_null, weekday0)
from .timeline import on_timeline

F1_COLS = ["sleep_days", "hist_n_orders", "hist_total_amount", "hist_avg_ticket",
           "hist_max_ticket", "hist_total_qty", "personal_ci", "gap_std", "gap_cv",
           "hist_discount_ratio", "hist_coupon_order_ratio", "hist_return_ratio",
           "hist_main_channel", "hist_main_payment", "member_tenure_days", "was_sealed",
           "prior_once_only"]
F2_COLS = ["t0_amount", "t0_ts_count", "t0_qty", "t0_used_coupon", "t0_discount_ratio",
           "t0_channel", "t0_payment", "t0_shipping", "t0_month", "t0_weekday",
           "t0_is_weekend", "t0_is_big_promo"]
F3_COLS = ["hist_distinct_salepages", "hist_repeat_sku_ratio", "t0_n_distinct_salepages",
           "t0_buys_familiar_product", "t0_avg_unit_price", "t0_min_unit_price",
           "t0_max_unit_price"]
F4_COLS = ["register_source", "gender", "age_at_t0", "days_since_register", "country_code",
           "member_card_level", "is_app_installed", "marketing_optin_count"]
F5_COLS = ["t0_vs_avg_ticket_ratio", "t0_vs_max_ticket_ratio", "sleep_vs_ci_ratio",
           "t0_discount_vs_hist_ratio", "t0_used_coupon_vs_hist", "t0_channel_matches_hist",
           "t0_payment_matches_hist", "t0_qty_vs_avg"]
F6_COLS = ["recent_90d_n_orders", "recent_180d_n_orders", "recent_365d_n_orders",
           "pre_dormancy_90d_n_orders", "pre_dormancy_90d_amount"]
FEATURE_GROUPS = {"F1": F1_COLS, "F2": F2_COLS, "F3": F3_COLS, "F4": F4_COLS,
                  "F5": F5_COLS, "F6": F6_COLS}
FEATURE_COLS = [c for g in FEATURE_GROUPS.values() for c in g]
CATEGORICAL_COLS = ["hist_main_channel", "hist_main_payment", "t0_channel", "t0_payment",
                    "t0_shipping", "register_source", "gender", "country_code"]
ID_COLS = ["sample_id", "label", "split", "member_id", "t0_date", "t0_order_code"]

# The ratio features whose extremes are reported, and the
# features whose importance rank is watched.
RATIO_FEATURES = ["hist_discount_ratio", "hist_coupon_order_ratio", "hist_return_ratio",
                  "t0_discount_ratio", "t0_vs_avg_ticket_ratio", "t0_vs_max_ticket_ratio",
                  "sleep_vs_ci_ratio", "t0_discount_vs_hist_ratio", "t0_qty_vs_avg",
                  "hist_repeat_sku_ratio", "gap_cv"]
WATCH_LIST = ["sleep_days", "t0_buys_familiar_product", "t0_vs_avg_ticket_ratio",
              "sleep_vs_ci_ratio", "t0_discount_vs_hist_ratio"]

DEC = T.DecimalType(38, 6)


def _dec(c: Column) -> Column:
    return c.cast(DEC)


def _day_num(c) -> Column:
    return F.unix_date(F.to_date(c))


# --------------------------------------------------------------------------- sources
def scan_lines_valid(lines: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """S3: order lines with status not Fail and unit_price > 0; status dropped."""
    return (lines.filter(is_not("status", cfg.status_fail) & (F.col("unit_price") > 0))
                 .drop("status"))


def scan_members(members: DataFrame) -> DataFrame:
    """Sentinel 1900-01-01 -> NULL dates, card level 0 -> NULL."""
    import datetime as dt
    s = dt.date(1900, 1, 1)
    return members.withColumns({
        "register_date": sentinel_to_null(F.to_date("register_date"), s),
        "birthday": sentinel_to_null(F.to_date("birthday"), s),
        "card_level": sentinel_to_null(F.col("card_level").cast("double"), 0.0),
    })


# --------------------------------------------------------------------------- F1 + F6
def _history_timeline(samples: DataFrame, orders_fl: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Member-day aggregates of the flagged orders, unioned with the sample rows."""
    valid = F.col("is_valid") == 1
    ts = F.col("order_ts")
    midnight = ts == as_ts(F.to_date(ts))
    amt = F.col("sales_amount")
    day = (on_timeline(orders_fl).withColumn("dn", _day_num(ts))
           .groupBy("member_id", "dn").agg(
               F.count_if(valid & amt.isNotNull()).alias("v_n"),
               F.sum(F.when(valid, _dec(amt))).alias("v_amt"),
               F.max(F.when(valid, amt)).alias("v_max"),
               F.sum(F.when(valid, F.col("qty").cast("long"))).alias("v_qty"),
               F.sum(F.when(valid, _dec(F.abs("total_discount")))).alias("v_disc"),
               F.sum(F.when(valid, _dec(F.col("total_price")))).alias("v_price"),
               F.count_if(valid & nonzero_or_null("total_coupon_discount",
                                                  cfg.null_coupon_is_used)).alias("v_coupon"),
               F.min(F.when(valid, ts)).alias("v_min_ts"),
               F.max(F.when(valid, ts)).alias("v_max_ts"),
               F.count_if(F.col("is_nonfail") == 1).alias("nf_n"),
               F.count_if((F.col("is_nonfail") == 1) & (F.col("is_return") == 1)).alias("ret_n"),
               F.count_if(valid & midnight).alias("v_mid_n"),
               F.sum(F.when(valid & midnight, _dec(amt))).alias("v_mid_amt"),
           )
           .withColumn("kind", F.lit(1))
           .withColumn("sample_id", F.lit(None).cast("long"))
           .withColumn("t0_date", F.lit(None).cast("date")))
    smp = (samples.select("sample_id", "member_id", "t0_date")
                  .withColumn("dn", F.unix_date("t0_date"))
                  .withColumn("kind", F.lit(0)))
    return day.unionByName(smp, allowMissingColumns=True)


def _before():
    """Member timeline frame: every earlier row (sample rows sort first on their day)."""
    return (Window.partitionBy("member_id").orderBy("dn", "kind")
                  .rowsBetween(Window.unboundedPreceding, -1))


def _history_window(u: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """F1/F6 window columns over a member timeline (day rows kind 1 carrying
    the ``v_*`` day aggregates, sample rows kind 0); rows of other kinds of
    day events may be present, their ``v_*`` columns are NULL and ignored."""
    before = _before()
    by_day = Window.partitionBy("member_id").orderBy("dn")

    def rng(lo, hi):
        return by_day.rangeBetween(lo, hi)

    # gaps between consecutive valid purchase days (on day rows only)
    u = u.withColumn("_prev_vdn", F.last(F.when(F.col("v_n") > 0, F.col("dn")), True).over(before))
    u = u.withColumn("gap", F.when(F.col("v_n") > 0, F.col("dn") - F.col("_prev_vdn")))

    # pre-dormancy window, evaluated on each valid day row
    P = cfg.pre_dormancy_days
    day_max_midnight = F.col("v_max_ts") == as_ts(F.date_from_unix_date("dn"))
    n_a = F.sum("v_n").over(rng(-P, 0)) - F.coalesce(F.sum("v_mid_n").over(rng(-P, -P)), F.lit(0))
    n_b = F.sum("v_n").over(rng(-(P - 1), 0)) - F.coalesce(F.sum("v_mid_n").over(rng(-(P - 1), -(P - 1))), F.lit(0))
    zero = F.lit(0).cast(DEC)
    a_a = F.coalesce(F.sum("v_amt").over(rng(-P, 0)), zero) \
        - F.coalesce(F.sum("v_mid_amt").over(rng(-P, -P)), zero)
    a_b = F.coalesce(F.sum("v_amt").over(rng(-(P - 1), 0)), zero) \
        - F.coalesce(F.sum("v_mid_amt").over(rng(-(P - 1), -(P - 1))), zero)
    u = u.withColumn("_pre_n", F.when(F.col("v_n") > 0, F.when(day_max_midnight, n_a).otherwise(n_b)))
    u = u.withColumn("_pre_amt", F.when(F.col("v_n") > 0, F.when(day_max_midnight, a_a).otherwise(a_b)))

    # recency windows (t0 - N days midnight, t0): RANGE frame, minus orders exactly at the lower midnight
    rec = {}
    for N in cfg.recent_days:
        rec[f"recent_{N}d_n_orders"] = (
            F.coalesce(F.sum("v_n").over(rng(-N, -1)), F.lit(0))
            - F.coalesce(F.sum("v_mid_n").over(rng(-N, -N)), F.lit(0))).cast("int")

    cum = {
        "_n": F.sum("v_n").over(before),
        "_amt": F.sum("v_amt").over(before),
        "_max": F.max("v_max").over(before),
        "_qty": F.sum("v_qty").over(before),
        "_disc": F.sum("v_disc").over(before),
        "_price": F.sum("v_price").over(before),
        "_coupon": F.sum("v_coupon").over(before),
        "_min_ts": F.min("v_min_ts").over(before),
        "_max_ts": F.max("v_max_ts").over(before),
        "_nf": F.sum("nf_n").over(before),
        "_ret": F.sum("ret_n").over(before),
        "_n_gaps": F.count("gap").over(before),
        "_ci": F.percentile("gap", 0.5).over(before),
        "_std": F.stddev_samp("gap").over(before),
        "_last_pre_n": F.last("_pre_n", True).over(before),
        "_last_pre_amt": F.last("_pre_amt", True).over(before),
    }
    return u.withColumns({**cum, **rec})


def _history_outputs(cfg: RevivalConfig) -> list[Column]:
    """F1 (without the two modes) + F6 + ``max_hist_ts`` over the window columns."""
    has = F.coalesce(F.col("_n"), F.lit(0)) > 0
    t0 = F.col("t0_date")
    sleep = F.when(has, floor_days(t0, "_max_ts"))
    two = F.col("_n_gaps") >= 2
    ci = F.when(has & two, F.col("_ci"))
    std = F.when(has & two, F.col("_std"))
    zero_d = F.lit(0).cast(DEC)
    rec = [f"recent_{n}d_n_orders" for n in cfg.recent_days]
    return [
        sleep.alias("sleep_days"),
        F.when(has, F.col("_n")).cast("long").alias("hist_n_orders"),
        F.when(has, F.col("_amt")).cast("double").alias("hist_total_amount"),
        F.when(has, safe_div(F.col("_amt").cast("double"), "_n")).alias("hist_avg_ticket"),
        F.when(has, F.col("_max")).alias("hist_max_ticket"),
        F.when(has, F.coalesce(F.col("_qty"), F.lit(0))).cast("double").alias("hist_total_qty"),
        ci.alias("personal_ci"),
        std.alias("gap_std"),
        safe_div(std, ci).alias("gap_cv"),
        F.when(has, safe_div(F.coalesce(F.col("_disc"), zero_d).cast("double"),
                             F.coalesce(F.col("_price"), zero_d).cast("double")))
         .alias("hist_discount_ratio"),
        F.when(has, safe_div("_coupon", "_n")).alias("hist_coupon_order_ratio"),
        F.when(F.coalesce(F.col("_nf"), F.lit(0)) > 0, safe_div("_ret", "_nf"))
         .alias("hist_return_ratio"),
        F.when(has, floor_days(t0, "_min_ts")).alias("member_tenure_days"),
        flag(sleep > cfg.sealed_days).alias("was_sealed"),
        flag(F.when(has, F.col("_n")) == 1).alias("prior_once_only"),
        *[F.col(c) for c in rec],
        F.coalesce(F.col("_last_pre_n"), F.lit(0)).cast("int").alias("pre_dormancy_90d_n_orders"),
        F.coalesce(F.col("_last_pre_amt"), zero_d).cast("double").alias("pre_dormancy_90d_amount"),
        F.col("_max_ts").alias("max_hist_ts"),
    ]


def history_features(samples: DataFrame, orders_fl: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """F1 (without the two modes) + F6 + leakage audit columns, per sample."""
    u = _history_window(_history_timeline(samples, orders_fl, cfg), cfg)
    return u.filter(F.col("kind") == 0).select("sample_id", *_history_outputs(cfg))


def _mode_rows(orders_fl: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Day rows of the member timeline for the history modes: for each value
    of each column whose running count k (valid orders, per member) grows on
    a day, a key ``struct(-k, value)`` in that column's slot ``_mk_i``."""
    names = list(cols)
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in names)
    cd = (on_timeline(orders_fl).filter(F.col("is_valid") == 1)
                   .select("member_id", _day_num("order_ts").alias("dn"),
                           F.expr(f"stack({len(names)}, {pairs}) as (col, v)"))
                   .groupBy("member_id", "col", "v", "dn")
                   .agg(F.count(F.lit(1)).alias("c")))
    run = (Window.partitionBy("member_id", "col", "v").orderBy("dn")
                 .rowsBetween(Window.unboundedPreceding, 0))
    key = F.struct((-F.sum("c").over(run)).alias("nk"), F.col("v").alias("v"))
    return cd.select("member_id", "dn", F.lit(1).alias("kind"),
                     *[F.when(F.col("col") == c, key).alias(f"_mk_{i}") for i, c in enumerate(names)])


def _mode_window(cols: dict[str, str]) -> dict[str, Column]:
    b = _before()
    return {f"_m_{i}": F.min(f"_mk_{i}").over(b) for i in range(len(cols))}


def _mode_outputs(cols: dict[str, str]) -> list[Column]:
    return [F.coalesce(F.col(f"_m_{i}").getField("v"), F.lit("unknown")).alias(o)
            for i, o in enumerate(cols.values())]


def hist_modes(samples: DataFrame, orders_fl: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Most frequent value of each column in ``cols`` ({col: out_col})
    among the valid history orders of each sample (count desc, value asc on
    ties; 'unknown' if none) -> sample_id + out columns.

    Running counts only grow, so the mode before t0 is the smallest
    ``struct(-k, value)`` over every "value reached count k" day event
    before t0: a running ``min`` on the member timeline.  Per-value running
    counts come from one window per (member, column, value) over its days;
    samples are not replicated per value."""
    smp = samples.select("sample_id", "member_id", F.unix_date("t0_date").alias("dn"),
                         F.lit(0).alias("kind"))
    u = _mode_rows(orders_fl, cols).unionByName(smp, allowMissingColumns=True)
    return (u.withColumns(_mode_window(cols)).filter(F.col("kind") == 0)
             .select("sample_id", *_mode_outputs(cols)))


def hist_mode(samples: DataFrame, orders_fl: DataFrame, col: str, out_col: str) -> DataFrame:
    """A23 for one column."""
    return hist_modes(samples, orders_fl, {col: out_col})


def f1_history(samples: DataFrame, orders_fl: DataFrame, cfg: RevivalConfig,
               hist: DataFrame | None = None) -> DataFrame:
    """history RFM and stability -> sample_id + 17 columns."""
    h = hist if hist is not None else history_features(samples, orders_fl, cfg)
    modes = hist_modes(samples, orders_fl, {"channel": "hist_main_channel",
                                             "payment": "hist_main_payment"})
    return h.join(modes, "sample_id", "left").select("sample_id", *F1_COLS)


def f6_recent(samples: DataFrame, orders_fl: DataFrame, cfg: RevivalConfig,
              hist: DataFrame | None = None) -> DataFrame:
    """recency windows and the pre-dormancy window -> sample_id + 5."""
    h = hist if hist is not None else history_features(samples, orders_fl, cfg)
    rec = [f"recent_{n}d_n_orders" for n in cfg.recent_days]
    return h.select("sample_id", *rec, "pre_dormancy_90d_n_orders", "pre_dormancy_90d_amount")


def leakage_audit(samples: DataFrame, orders_fl: DataFrame, cfg: RevivalConfig,
                  hist: DataFrame | None = None) -> DataFrame:
    """Latest history timestamp per sample; ok iff it is before t0_date.
    Checks every sample (the reference spot-checks 5)."""
    h = hist if hist is not None else history_features(samples, orders_fl, cfg)
    s = samples.select("sample_id", "t0_date")
    return (s.join(h.select("sample_id", "max_hist_ts"), "sample_id", "left")
             .withColumn("ok", F.col("max_hist_ts").isNull()
                         | (F.col("max_hist_ts") < as_ts("t0_date"))))


# --------------------------------------------------------------------------- F2
def t0_order_lookup(samples: DataFrame, orders_fl: DataFrame) -> DataFrame:
    """Sample left-joined with its (valid) t0 order on the order code."""
    t0 = (orders_fl.filter(F.col("is_valid") == 1)
                   .select(F.col("order_code").alias("t0_order_code"), "sales_amount",
                           "ts_count", "qty", "total_coupon_discount", "total_discount",
                           "total_price", "channel", "payment", "shipping"))
    return samples.select("sample_id", "t0_order_code", "t0_date").join(t0, "t0_order_code", "left")


def f2_t0_order(samples: DataFrame, orders_fl: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """attributes of the revival order itself -> sample_id + 12."""
    j = t0_order_lookup(samples, orders_fl)
    wd = weekday0("t0_date")
    return j.select(
        "sample_id",
        F.col("sales_amount").alias("t0_amount"),
        F.col("ts_count").cast("long").alias("t0_ts_count"),
        F.col("qty").cast("long").alias("t0_qty"),
        nonzero_or_null("total_coupon_discount", cfg.null_coupon_is_used).cast("int")
         .alias("t0_used_coupon"),
        safe_div(F.abs("total_discount"), "total_price").alias("t0_discount_ratio"),
        F.coalesce("channel", F.lit("unknown")).alias("t0_channel"),
        F.coalesce("payment", F.lit("unknown")).alias("t0_payment"),
        F.coalesce("shipping", F.lit("unknown")).alias("t0_shipping"),
        F.month("t0_date").alias("t0_month"),
        wd.alias("t0_weekday"),
        flag(wd.isin(5, 6)).alias("t0_is_weekend"),
        flag(F.month("t0_date").isin(*cfg.promo_months)).alias("t0_is_big_promo"),
    )


# --------------------------------------------------------------------------- F3
def _page_day_counts(lines_v: DataFrame) -> DataFrame:
    """Line rows per (member, page, day), NULL page included (one aggregation)."""
    return (on_timeline(lines_v).withColumn("dn", _day_num("order_ts"))
                   .groupBy("member_id", "sale_page_id", "dn")
                   .agg(F.count(F.lit(1)).alias("c")))


def _f3_timeline(samples: DataFrame, lines_v: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """F3 rows of the member timeline: one day row per (member, day) with the
    line count and the page events, one row per sample with its t0 lines.

    History pages: distinct pages and the share bought more than once (T15).
    t0 pages: the lines of the t0 order (joined on order code only, T18);
    familiar = one of them was bought by the member on an earlier day (NULL
    pages never match unless ``cfg.null_safe_pages``, T4).

    One pass over the lines: per (member, page, day) counts and the t0 lines
    (pre-aggregated per sample and page) share one window per (member, page)
    ordered by day, t0 rows first on their day, so the count strictly before
    a row says whether the page was seen before (familiarity on t0 rows, the
    'first seen' / 'second purchase' day events on day rows).  One aggregate
    per (member, day, sample) then feeds the member timeline, whose
    cumulative frame gives the history counts as of each t0 (evaluated by
    :func:`f3_products`)."""
    pdc = (_page_day_counts(lines_v)
           .select("member_id", "sale_page_id", "dn", "c",
                   F.lit(1).alias("kind"), F.lit(None).cast("long").alias("sample_id")))
    t0p = (samples.select("sample_id", "member_id", "t0_date", "t0_order_code")
                  .join(lines_v.select(F.col("order_code").alias("t0_order_code"),
                                       "sale_page_id", "unit_price"), "t0_order_code", "inner")
                  .groupBy("sample_id", "member_id", F.unix_date("t0_date").alias("dn"),
                           "sale_page_id")
                  .agg(F.count(F.lit(1)).alias("t_n"),
                       # exact (DECIMAL) sum: the mean does not depend on the addition order
                       F.sum(F.col("unit_price").cast(T.DecimalType(38, 7))).alias("t_sum"),
                       F.count("unit_price").alias("t_cnt"),
                       F.min("unit_price").alias("t_min"),
                       F.max("unit_price").alias("t_max"))
                  .withColumn("kind", F.lit(0)))
    page_w = (Window.partitionBy("member_id", "sale_page_id").orderBy("dn", "kind")
                    .rowsBetween(Window.unboundedPreceding, -1))
    prior = F.coalesce(F.sum("c").over(page_w), F.lit(0))
    pw = pdc.unionByName(t0p, allowMissingColumns=True).withColumn("prior", prior)

    smp = samples.select("sample_id", "member_id", "t0_date",
                         F.unix_date("t0_date").alias("dn"), F.lit(0).alias("kind"))
    day_row = F.col("kind") == 1
    page = F.col("sale_page_id").isNotNull()
    t0_row = F.col("t_n").isNotNull()
    fam_page = page if not cfg.null_safe_pages else F.lit(True)
    per = (pw.unionByName(smp, allowMissingColumns=True)
             .groupBy("member_id", "dn", "sample_id")
             .agg(F.sum("c").alias("n_lines"),
                  F.count_if(day_row & page & (F.col("prior") == 0)).alias("new_pages"),
                  F.count_if(day_row & page & (F.col("prior") < 2)
                             & (F.col("prior") + F.col("c") >= 2)).alias("new_reps"),
                  F.sum("t_n").alias("t_n"),
                  F.count_if(t0_row & page).alias("t_pages"),
                  F.sum("t_sum").alias("t_sum"),
                  F.sum("t_cnt").alias("t_cnt"),
                  F.min("t_min").alias("t_min"),
                  F.max("t_max").alias("t_max"),
                  F.max(t0_row & fam_page & (F.col("prior") > 0)).alias("t_fam"),
                  F.max("t0_date").alias("t0_date"))
             .withColumn("kind", F.when(F.col("sample_id").isNull(), 1).otherwise(0)))
    return per


def _f3_window() -> dict[str, Column]:
    b = _before()
    return {"_lines": F.sum("n_lines").over(b), "_pages": F.sum("new_pages").over(b),
            "_reps": F.sum("new_reps").over(b)}


def _f3_outputs() -> list[Column]:
    has_t0 = F.coalesce(F.col("t_n"), F.lit(0)) > 0
    return [F.when(F.col("_lines") > 0, F.coalesce(F.col("_pages"), F.lit(0)))
             .cast("long").alias("hist_distinct_salepages"),
            safe_div(F.coalesce(F.col("_reps"), F.lit(0)), "_pages")
             .alias("hist_repeat_sku_ratio"),
            F.when(has_t0, F.col("t_pages")).alias("t0_n_distinct_salepages"),
            F.when(has_t0, flag(F.col("t_fam"))).alias("t0_buys_familiar_product"),
            F.when(has_t0, F.col("t_sum").cast("double") / F.col("t_cnt"))
             .alias("t0_avg_unit_price"),
            F.col("t_min").alias("t0_min_unit_price"),
            F.col("t_max").alias("t0_max_unit_price")]


def f3_products(samples: DataFrame, lines_v: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """product behaviour from order lines -> sample_id + 7 (see
    :func:`_f3_timeline`)."""
    return (_f3_timeline(samples, lines_v, cfg).withColumns(_f3_window())
            .filter(F.col("kind") == 0).select("sample_id", *_f3_outputs()))


# --------------------------------------------------------------------------- F4
def unique_members(members_c: DataFrame) -> DataFrame:
    """The member table, failing the job that reads it if a member has two rows
    (they would multiply samples); rows without a member are left out.

    The check is one aggregate on the key, evaluated as a scalar subquery."""
    m = members_c.filter(F.col("member_id").isNotNull())
    twice = (m.groupBy("member_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
              .agg(F.count(F.lit(1)), F.min("member_id").alias("one"))
              .select(F.when(F.col("one").isNotNull(), F.col("one").cast("string"))).scalar())
    found = F.when(twice.isNotNull(), F.raise_error(F.concat(F.lit("several rows for member "), twice))
                   .cast("boolean")).otherwise(F.lit(True))
    return m.filter(found)


def member_dim_join(samples: DataFrame, members_c: DataFrame) -> DataFrame:
    """Sample left-joined with the member dimension (unique by member)."""
    return samples.select("sample_id", "member_id", "t0_date").join(unique_members(members_c), "member_id", "left")


def f4_member(samples: DataFrame, members_c: DataFrame) -> DataFrame:
    """member background -> sample_id + 8 (snapshot columns annotated in cfg)."""
    j = member_dim_join(samples, members_c)
    optin = sum(F.coalesce(F.col(c), F.lit(False)).cast("int")
                for c in ("optin_email", "optin_push", "optin_sms"))
    return j.select(
        "sample_id",
        F.coalesce("register_source", F.lit("unknown")).alias("register_source"),
        F.col("gender"),
        (floor_days("t0_date", "birthday") / F.lit(365.25)).alias("age_at_t0"),
        floor_days("t0_date", "register_date").alias("days_since_register"),
        F.coalesce("country", F.lit("unknown")).alias("country_code"),
        F.col("card_level").cast("double").alias("member_card_level"),
        F.col("is_app_installed").cast("int").alias("is_app_installed"),
        optin.alias("marketing_optin_count"),
    )


# --------------------------------------------------------------------------- F5
def f5_columns() -> dict[str, Column]:
    """F5 expressions over a row that already holds the F1 and F2 columns."""
    return {
        "t0_vs_avg_ticket_ratio": safe_div("t0_amount", "hist_avg_ticket"),
        "t0_vs_max_ticket_ratio": safe_div("t0_amount", "hist_max_ticket"),
        "sleep_vs_ci_ratio": safe_div("sleep_days", "personal_ci"),
        "t0_discount_vs_hist_ratio": safe_div("t0_discount_ratio",
                                              discount_floor("hist_discount_ratio")),
        "t0_used_coupon_vs_hist": F.col("t0_used_coupon").cast("double")
                                  - F.col("hist_coupon_order_ratio"),
        "t0_channel_matches_hist": flag(F.col("t0_channel") == F.col("hist_main_channel")),
        "t0_payment_matches_hist": flag(F.col("t0_payment") == F.col("hist_main_payment")),
        "t0_qty_vs_avg": safe_div("t0_qty", safe_div("hist_total_qty", "hist_n_orders")),
    }


def f5_interactions(f1: DataFrame, f2: DataFrame) -> DataFrame:
    """the t0 order against the member's own history -> sample_id + 8."""
    b = f1.join(f2, "sample_id", "full")
    return b.select("sample_id", *[e.alias(n) for n, e in f5_columns().items()])


# --------------------------------------------------------------------------- J9 + P7
def assemble_features(samples: DataFrame, orders_fl: DataFrame, lines_v: DataFrame,
                      members_c: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Skeleton left-joined with F1..F6 on sample_id -> ids + 57 features.

    Each group is computed once, F1 and F6 from one timeline.  The three member
    timelines (order days, mode keys, line days) stay apart and narrow: their union
    deals rows of some forty columns, most of them NULL, and was the slower form in
    the same run.  What is joined at the end is one row a sample from each; F5 is a
    projection over the joined F1 and F2 columns."""
    hist = history_features(samples, orders_fl, cfg).drop("max_hist_ts")
    modes = hist_modes(samples, orders_fl, {"channel": "hist_main_channel", "payment": "hist_main_payment"})
    out = samples.select("sample_id", "label", "split", "member_id", "t0_date", "t0_order_code")
    for f in (hist, modes, f3_products(samples, lines_v, cfg), f2_t0_order(samples, orders_fl, cfg),
              f4_member(samples, members_c)):
        out = out.join(f, "sample_id", "left")
    out = out.withColumns(f5_columns())
    return out.select(*ID_COLS, *FEATURE_COLS)


def clean_ranges(features: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Age outside [lo, hi] -> NULL; negative days_since_register -> NULL."""
    lo, hi = cfg.age_bounds
    return features.withColumns({
        "age_at_t0": F.when(F.col("age_at_t0").between(lo, hi), F.col("age_at_t0")),
        "days_since_register": F.when(F.col("days_since_register") >= cfg.min_days_since_register,
                                      F.col("days_since_register")),
    })


def check_unique_ids(df: DataFrame, key: str = "sample_id") -> None:
    """K2 guard: the key must be unique (one aggregate job, nothing collected)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d")).first()
    if r["n"] != r["d"]:
        raise ValueError(f"duplicate {key}: {r['n']} rows, {r['d']} distinct")
