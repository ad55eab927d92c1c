"""Purchase timeline operators: validity, de-duplication, member-day timeline,
gaps, the leak-free personal cycle and the dormancy threshold (R2-R5), plus
the descriptive statistics over them (A1-A8).

Scale notes
-----------
* Everything per member runs on the *member-day* timeline: one row per
  (member, calendar day).  It is produced by a ``groupBy`` (partial
  aggregation before the shuffle, so a member holding a third of all orders
  is combined map-side), and its size per member is bounded by the number of
  calendar days in the data, whatever the order volume.  The window
  functions below therefore never see an unbounded partition.
* Keep-first de-duplication and top-1 picks are ``min_by`` aggregates, not
  ``row_number`` windows: they combine partially before the shuffle, so a hot
  key is never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RevivalConfig
from ..functions.exprs import dormancy_threshold, fill_unknown, flag, is_not

ORDER_COLS = ["member_id", "order_code", "order_ts", "status", "sales_amount",
              "ts_count", "qty", "total_price", "total_discount",
              "total_coupon_discount", "channel", "payment", "shipping"]


# --------------------------------------------------------------------------- P1-P4
def shop_filter(df: DataFrame, shop_col: str, shop_id) -> DataFrame:
    """Keep one tenant (the predicate reaches the Parquet scan)."""
    return df.filter(F.col(shop_col) == F.lit(shop_id))


def valid_purchases(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Status is not Fail and amount > 0; adds the calendar ``date``."""
    return (orders.filter(is_not("status", cfg.status_fail) & (F.col("sales_amount") > 0))
                  .withColumn("date", F.to_date("order_ts")))


def valid_definitions(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Three candidate validity definitions -> definition, n, pct."""
    nf = is_not("status", cfg.status_fail)
    agg = orders.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(nf).alias("a"),
        F.count_if(nf & (F.col("sales_amount") > 0)).alias("b"),
        F.count_if(F.col("status") == cfg.status_finish).alias("c"),
    )
    long = agg.select("total", F.expr(
        "stack(3, 'excl_fail', a, 'excl_fail_amount_pos', b, 'finish_only', c) as (definition, n)"))
    return long.select("definition", "n", (F.col("n") * 100.0 / F.col("total")).alias("pct"))


def order_flags(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """is_return, is_valid, is_nonfail as 0/1 ints (NULL comparisons -> 0)."""
    nonfail = is_not("status", cfg.status_fail)
    return orders.withColumns({
        "is_return": flag(F.col("status") == cfg.status_return),
        "is_valid": flag(nonfail & (F.col("sales_amount") > 0)),
        "is_nonfail": flag(nonfail),
    })


# --------------------------------------------------------------------------- W4
def dedup_orders(df: DataFrame, key: str = "order_code",
                 order_by: list[str | Column] | None = None) -> DataFrame:
    """One row per ``key``.

    The reference keeps the first row in file order; files have no order in
    Spark, so the kept row is the smallest by ``order_by`` (default
    ``order_ts``) with every remaining column as tie-break — deterministic.
    A row without an ordering value comes after those that have one (an undated
    copy of an order never replaces the dated one).
    Implemented as a ``min`` over one struct (map-side combine).
    """
    cols = df.columns
    ob = [F.col(c) if isinstance(c, str) else c for c in (order_by or ["order_ts"])]
    ob = [x for c in ob for x in (c.isNull(), c)]
    # one struct: ordering fields first, then the row itself -> min() is the
    # first row by (order_by, all columns) and the row travels once
    row = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(ob)], *[F.col(c) for c in cols])
    return (df.groupBy(key)
              .agg(F.min(row).alias("_r"))
              .select(*[F.col(f"_r.{c}").alias(c) for c in cols]))


def scan_orders_flagged(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Stage-2 order view — dedup by code *then* flag (T5), unknown-filled."""
    return fill_unknown(order_flags(dedup_orders(orders), cfg),
                        ["channel", "payment", "shipping"])


LABEL_COLS = ["member_id", "order_code", "order_ts"]


def unique_orders(valid: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """R3-1: valid orders, one per order code (stage-1 order: filter then dedup).

    ``cols`` projects before the de-duplication shuffle (the label rule needs
    only member, code and timestamp)."""
    return dedup_orders(valid.select(*cols) if cols else valid)


# --------------------------------------------------------------------------- W5 + W3
def on_timeline(orders: DataFrame, ts_col: str = "order_ts") -> DataFrame:
    """Rows that have a place in a member's history: an order without a member
    or without a timestamp belongs to no timeline (it still counts as an order)."""
    return orders.filter(F.col("member_id").isNotNull() & F.col(ts_col).isNotNull())


def member_days(valid: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """R3-2 + W3 in one aggregation: one row per (member, date) carrying the
    day's candidate t0 order — Finish first, then the largest amount, then
    the smallest order code.
    """
    not_finish = (~F.coalesce(F.col("status") == cfg.status_finish, F.lit(False))).cast("int")
    rank = F.struct(not_finish.alias("nf"), (-F.col("sales_amount")).alias("neg_amt"),
                    F.col("order_code").alias("code"))
    pick = F.min_by(F.struct("order_code", "order_ts"), rank)
    return (on_timeline(valid).groupBy("member_id", "date")
                 .agg(pick.alias("_b"))
                 .select("member_id", "date",
                         F.col("_b.order_code").alias("t0_order_code"),
                         F.col("_b.order_ts").alias("t0_order_ts")))


def daily_timeline(valid: DataFrame) -> DataFrame:
    """Distinct (member_id, date)."""
    return on_timeline(valid, "date").select("member_id", "date").distinct()


def best_order_per_day(valid: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Top-1 order per (member, day) -> member_id, date, order_code, order_ts."""
    return member_days(valid, cfg).select(
        "member_id", "date", F.col("t0_order_code").alias("order_code"),
        F.col("t0_order_ts").alias("order_ts"))


# --------------------------------------------------------------------------- W1, W2, P9
def _by_member(order_col: str = "date"):
    return Window.partitionBy("member_id").orderBy(order_col)


def purchase_gaps(days: DataFrame) -> DataFrame:
    """Consecutive purchase-day gaps -> member_id, date_from, date_to, gap_days
    (+ any carried day columns such as the t0 candidate of ``date_to``)."""
    w = _by_member()
    carried = [c for c in days.columns if c not in ("member_id", "date")]
    return (on_timeline(days, "date").withColumn("date_from", F.lag("date").over(w))
                .filter(F.col("date_from").isNotNull())
                .select("member_id", "date_from", F.col("date").alias("date_to"),
                        F.datediff("date", "date_from").alias("gap_days"), *carried))


def dynamic_ci(gaps: DataFrame, fallback: int) -> DataFrame:
    """The cycle of gap i from gaps 1..i-1 only (no future leakage).

    >= 2 prior gaps -> int(median) (interpolated, then truncated, T7);
    1 prior gap -> that gap; none -> ``fallback``.  ``percentile`` over a
    ``ROWS UNBOUNDED PRECEDING .. 1 PRECEDING`` frame (T23); the frame is
    bounded by the member's number of purchase days.
    """
    w = _by_member("date_to").rowsBetween(Window.unboundedPreceding, -1)
    n_prior = F.count("gap_days").over(w)
    med = F.percentile("gap_days", 0.5).over(w)
    return (gaps.withColumn("n_prior", n_prior)
                .withColumn("_med", med)
                .withColumn("ci_days", F.when(F.col("n_prior") >= 1, F.col("_med").cast("int"))
                                       .otherwise(F.lit(fallback)))
                .withColumn("ci_branch", F.when(F.col("n_prior") >= 2, F.lit("median"))
                                          .when(F.col("n_prior") == 1, F.lit("single"))
                                          .otherwise(F.lit("fallback")))
                .drop("_med"))


def add_threshold(gaps_ci: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """threshold_days = int(clip(k * ci_days, lo, hi))."""
    return gaps_ci.withColumn("threshold_days",
                              dormancy_threshold("ci_days", cfg.k, cfg.clip_lo, cfg.clip_hi))


def threshold_report(gaps_ci: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """P9 report: raw / clipped medians and the share clipped at each end."""
    raw = F.col("ci_days") * F.lit(cfg.k)
    thr = dormancy_threshold("ci_days", cfg.k, cfg.clip_lo, cfg.clip_hi)
    a = gaps_ci.agg(
        F.floor(F.median(raw)).cast("double").alias("thr_median_raw"),
        F.floor(F.median(thr)).cast("double").alias("thr_median_clipped"),
        (F.count_if(raw < cfg.clip_lo) * 100.0 / F.count(F.lit(1))).alias("clipped_lo_pct"),
        (F.count_if(raw > cfg.clip_hi) * 100.0 / F.count(F.lit(1))).alias("clipped_hi_pct"),
    )
    return _long(a, ["thr_median_raw", "thr_median_clipped", "clipped_lo_pct", "clipped_hi_pct"])


def gaps_with_threshold(valid: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """R3-2 -> R5 as one plan: member days -> gaps -> cycle -> threshold."""
    return add_threshold(dynamic_ci(purchase_gaps(member_days(valid, cfg)), cfg.fallback_ci), cfg)


# --------------------------------------------------------------------------- A1-A8
def _long(row_df: DataFrame, metrics: list[str]) -> DataFrame:
    """One-row wide aggregate -> (metric, value double) rows."""
    pairs = ", ".join(f"'{m}', cast(`{m}` as double)" for m in metrics)
    return row_df.select(F.expr(f"stack({len(metrics)}, {pairs}) as (metric, value)"))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """A1: value counts with share and rank -> value, n, pct, rank.

    The rank is a dense index over the aggregated table range-partitioned on
    (n desc, value), so a high-cardinality column is never ranked in one task."""
    from .events import row_index
    total = df.select(F.count(F.lit(1))).scalar()
    g = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc_nulls_first("value")]
    n_part = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = row_index(g.repartitionByRange(n_part, *order).sortWithinPartitions(*order), "_i")
    return ranked.select("value", "n", (F.col("n") * 100.0 / total).alias("pct"),
                         (F.col("_i") + 1).cast("int").alias("rank"))


def table_overview(df: DataFrame, ts_col: str = "order_ts") -> DataFrame:
    """A2: rows, distinct members, first and last calendar day."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct("member_id").alias("members"),
                  F.to_date(F.min(ts_col)).alias("min_date"),
                  F.to_date(F.max(ts_col)).alias("max_date"))


def sign_shares(df: DataFrame) -> DataFrame:
    """A3: share (%) of amount < 0, amount = 0 and qty < 0."""
    n = F.count(F.lit(1))
    a = df.agg((F.count_if(F.col("sales_amount") < 0) * 100.0 / n).alias("amount_neg_pct"),
               (F.count_if(F.col("sales_amount") == 0) * 100.0 / n).alias("amount_zero_pct"),
               (F.count_if(F.col("qty") < 0) * 100.0 / n).alias("qty_neg_pct"))
    return _long(a, ["amount_neg_pct", "amount_zero_pct", "qty_neg_pct"])


def purchase_count_dist(unique_valid: DataFrame) -> DataFrame:
    """A4: orders per member — P25..P95, mean, max, one-time share, >=2/3/5."""
    per = (unique_valid.filter(F.col("member_id").isNotNull())
           .groupBy("member_id").agg(F.count(F.lit(1)).alias("n")))
    qs = [0.25, 0.5, 0.75, 0.9, 0.95]
    p = F.percentile("n", F.array(*[F.lit(q) for q in qs]))
    a = per.agg(p.alias("p"), F.avg("n").alias("mean"), F.max("n").alias("max"),
                (F.avg((F.col("n") == 1).cast("double")) * 100).alias("one_time_pct"),
                F.count_if(F.col("n") >= 2).alias("ge2"),
                (F.avg((F.col("n") >= 2).cast("double")) * 100).alias("ge2_pct"),
                F.count_if(F.col("n") >= 3).alias("ge3"),
                (F.avg((F.col("n") >= 3).cast("double")) * 100).alias("ge3_pct"),
                F.count_if(F.col("n") >= 5).alias("ge5"),
                (F.avg((F.col("n") >= 5).cast("double")) * 100).alias("ge5_pct"))
    a = a.select(*[F.col("p")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(qs)],
                 "mean", "max", "one_time_pct", "ge2", "ge2_pct", "ge3", "ge3_pct", "ge5", "ge5_pct")
    return _long(a, a.columns)


def item_count_dist(unique_valid: DataFrame) -> DataFrame:
    """A5: per-order TsCount / Qty quantiles, mean, max and single-SKU share."""
    qs = [0.25, 0.5, 0.75, 0.9]
    cols = []
    for c in ("ts_count", "qty"):
        x = F.col(c).cast("double")
        p = F.percentile(x, F.array(*[F.lit(q) for q in qs]))
        cols += [p[i].alias(f"{c}_p{int(q * 100)}") for i, q in enumerate(qs)]
        cols += [F.avg(x).alias(f"{c}_mean"), F.max(x).alias(f"{c}_max")]
    cols.append((F.count_if(F.col("ts_count") == 1) * 100.0
                 / F.count("ts_count")).alias("single_sku_pct"))
    a = unique_valid.agg(*cols)
    return _long(a, a.columns)


def attach_member_ci(gaps: DataFrame) -> DataFrame:
    """Whole-life (static) per-member median gap joined back to each gap.
    A whole-partition window — no join, partition bounded by member days."""
    return gaps.withColumn("ci", F.percentile("gap_days", 0.5).over(Window.partitionBy("member_id")))


def static_ci(gaps: DataFrame) -> DataFrame:
    """Per-member median gap -> member_id, ci."""
    return gaps.groupBy("member_id").agg(F.percentile("gap_days", 0.5).alias("ci"))


def static_ci_stats(gaps: DataFrame, unique_valid: DataFrame) -> DataFrame:
    """A6 report: Ci quantiles, mean, max, fallback (median of member medians),
    single-purchase members."""
    ci = static_ci(gaps)
    qs = [0.25, 0.5, 0.75, 0.9]
    a = ci.agg(F.percentile("ci", F.array(*[F.lit(q) for q in qs])).alias("p"),
               F.avg("ci").alias("mean"), F.max("ci").alias("max"),
               F.count(F.lit(1)).alias("members"))
    single = (unique_valid.filter(F.col("member_id").isNotNull()).groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
                          .filter("n = 1").select(F.count(F.lit(1))).scalar())
    a = a.select(*[F.col("p")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(qs)],
                 "mean", "max", F.col("p")[1].alias("fallback"), "members",
                 single.alias("single_purchase_members"))
    return _long(a, a.columns)


def gap_dist(gaps: DataFrame, cap: int = 365) -> DataFrame:
    """Quantiles of gaps <= cap and the share above cap."""
    qs = [0.25, 0.5, 0.75, 0.9]
    g = F.col("gap_days").cast("double")
    a = gaps.agg(F.percentile(F.when(g <= cap, g), F.array(*[F.lit(q) for q in qs])).alias("p"),
                 (F.avg((g > cap).cast("double")) * 100).alias("over_cap_pct"))
    a = a.select(*[F.col("p")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(qs)], "over_cap_pct")
    return _long(a, a.columns)


def ci_stats(gaps_ci: DataFrame) -> DataFrame:
    """Cycle percentiles (numpy linear, truncated to int) and branch shares."""
    qs = [0.25, 0.5, 0.75, 0.9]
    n = F.count(F.lit(1))
    a = gaps_ci.agg(
        n.alias("total_gaps"),
        F.percentile("ci_days", F.array(*[F.lit(q) for q in qs])).alias("p"),
        F.count_if(F.col("ci_branch") == "median").alias("use_median"),
        F.count_if(F.col("ci_branch") == "single").alias("use_single"),
        F.count_if(F.col("ci_branch") == "fallback").alias("use_fallback"))
    a = a.select("total_gaps",
                 *[F.floor(F.col("p")[i]).alias(f"ci_p{int(q * 100)}") for i, q in enumerate(qs)],
                 "use_median", "use_single", "use_fallback",
                 (F.col("use_median") * 100.0 / F.col("total_gaps")).alias("use_median_pct"),
                 (F.col("use_single") * 100.0 / F.col("total_gaps")).alias("use_single_pct"),
                 (F.col("use_fallback") * 100.0 / F.col("total_gaps")).alias("use_fallback_pct"))
    return _long(a, a.columns)
