"""Revival events, labels, censoring, calendar split and sample ids (R6-R10),
with the split / funnel summaries (A17-A20, J11, U2).

Scale notes
-----------
* R6 needs no join: the t0 candidate of a day is carried on the member-day
  row, and a gap is that row plus ``lag``.
* R7 ("is there another order in (t0_ts, t0_ts + W]?") is *not* an
  event x orders join on member — that would emit every (event, order) pair
  of a member.  Instead:
    - whole days strictly inside the window are counted with a ``RANGE``
      frame over the member-day timeline of the de-duplicated orders (bounded
      by calendar days per member);
    - the two partial boundary days are matched with an equi-join on
      (member, day): at most two event rows share such a key, so the output is
      linear in the order rows; the order side is the left side of an inner
      join, which AQE's skew handling can split for a hot (member, day).
* Sample ids need a global order; it is computed by range partitioning on
  the full key plus per-partition offsets (a table bounded by the partition
  count, broadcast) — never a single-partition window over rows, and a hot
  day is split by member.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RevivalConfig
from .timeline import LABEL_COLS, gaps_with_threshold, on_timeline, unique_orders

EVENT_COLS = ["member_id", "t0_date", "t0_order_code", "t0_order_ts"]
SAMPLE_COLS = ["sample_id", "label", "member_id", "t0_date", "t0_order_code", "split"]


# --------------------------------------------------------------------------- R6 / J1
def revival_events(gaps_thr: DataFrame) -> DataFrame:
    """Dormant gaps (gap > threshold, strict) -> events with the t0 order."""
    return (gaps_thr.filter(F.col("gap_days") > F.col("threshold_days"))
                    .select("member_id", F.col("date_to").alias("t0_date"),
                            "t0_order_code", "t0_order_ts"))


# --------------------------------------------------------------------------- R7 / J2
def revival_labels(events: DataFrame, orders1: DataFrame, window_days: int,
                   same_source: bool = False) -> DataFrame:
    """label = 1 iff an order of the member with another order code has
    ``t0_ts < order_ts <= t0_ts + window_days`` (timestamp exact, T10).

    ``orders1`` are the R3-1 orders (valid, one row per code).

    ``same_source``: the events and ``orders1`` come from the same valid-order
    table (as in :func:`samples`).  ``orders1`` then holds the *earliest* row
    of each code, so the row of the t0 code is at or before t0_ts: it can
    never fall in the window, and "another code" needs no check.  The two
    boundary days reduce to day aggregates read by ``RANGE`` frames on the
    member-day timeline (day t0: latest order after t0_ts; day t0 + W:
    earliest order at or before t0_ts + W) — one aggregation and one window,
    no join with the orders.
    """
    W = int(window_days)
    orders1 = on_timeline(orders1)
    if same_source and W >= 1:
        return _labels_same_source(events, orders1, W)
    o = orders1.select("member_id", "order_code", "order_ts",
                       F.to_date("order_ts").alias("day"))
    ev = events.select(*EVENT_COLS)

    # (a) whole days strictly inside the window: RANGE frame on the member-day timeline
    if W >= 2:
        od = o.groupBy("member_id", "day").agg(F.count(F.lit(1)).alias("n"))
        u = (od.select("member_id", F.unix_date("day").alias("dn"), "n",
                       F.lit(None).cast("date").alias("t0_date"))
               .unionByName(ev.select("member_id", F.unix_date("t0_date").alias("dn"),
                                      F.lit(None).cast("long").alias("n"), "t0_date")))
        w = Window.partitionBy("member_id").orderBy("dn").rangeBetween(1, W - 1)
        inner = (u.withColumn("inner_n", F.coalesce(F.sum("n").over(w), F.lit(0)))
                  .filter(F.col("t0_date").isNotNull())
                  .select("member_id", "t0_date", "inner_n"))
    else:
        inner = ev.select("member_id", "t0_date", F.lit(0).cast("long").alias("inner_n"))

    # the t0 code's own R3-1 row, if it lies on an inner day, is not "another" order
    own = (ev.join(o.select(F.col("order_code").alias("t0_order_code"),
                            F.col("day").alias("own_day")), "t0_order_code", "inner")
             .filter((F.col("own_day") > F.col("t0_date"))
                     & (F.col("own_day") < F.date_add("t0_date", W)))
             .select("member_id", "t0_date", F.lit(1).alias("own_inner")))

    # (b) the two boundary days, exact on timestamp, via an equi-join on (member, day)
    bounds = ev.select("member_id", "t0_date", "t0_order_code", "t0_order_ts",
                       F.explode(F.array(F.lit(0), F.lit(1))).alias("edge"))
    bounds = bounds.withColumn("day", F.when(F.col("edge") == 0, F.col("t0_date"))
                                        .otherwise(F.date_add("t0_date", W)))
    x = o.select(F.col("member_id").alias("x_member"), F.col("day").alias("x_day"),
                 F.col("order_code").alias("x_code"), F.col("order_ts").alias("x_ts"))
    end_ts = F.col("t0_order_ts") + F.expr(f"INTERVAL {W} DAYS")
    hit_cond = (
        (F.col("member_id") == F.col("x_member")) & (F.col("day") == F.col("x_day"))
        & (F.col("x_code") != F.col("t0_order_code"))
        & (F.col("x_ts") > F.col("t0_order_ts")) & (F.col("x_ts") <= end_ts))
    # orders on the left of an inner join: AQE's skew handling may split the
    # order side of a hot (member, day); at most two event rows share a key
    hits = (x.join(bounds, hit_cond, "inner")
             .select("member_id", "t0_date").distinct()
             .withColumn("edge_hit", F.lit(1)))

    keyed = ["member_id", "t0_date"]
    out = (ev.join(inner, keyed, "left").join(own, keyed, "left").join(hits, keyed, "left"))
    n_other = F.coalesce(F.col("inner_n"), F.lit(0)) - F.coalesce(F.col("own_inner"), F.lit(0))
    label = ((n_other > 0) | F.col("edge_hit").isNotNull()).cast("int")
    return out.select(*EVENT_COLS, label.alias("label"))


def _labels_same_source(events: DataFrame, orders1: DataFrame, W: int) -> DataFrame:
    od = (orders1.groupBy("member_id", F.unix_date(F.to_date("order_ts")).alias("dn"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("order_ts").alias("min_ts"),
                      F.max("order_ts").alias("max_ts"))
                 .withColumn("kind", F.lit(1)))
    ev = events.select(*EVENT_COLS, F.unix_date("t0_date").alias("dn"), F.lit(0).alias("kind"))
    u = od.unionByName(ev, allowMissingColumns=True)
    by_day = Window.partitionBy("member_id").orderBy("dn")
    inner = (F.coalesce(F.sum("n").over(by_day.rangeBetween(1, W - 1)), F.lit(0)) if W >= 2
             else F.lit(0))
    first_day = F.max("max_ts").over(by_day.rangeBetween(0, 0))
    last_day = F.min("min_ts").over(by_day.rangeBetween(W, W))
    end_ts = F.col("t0_order_ts") + F.expr(f"INTERVAL {W} DAYS")
    label = ((inner > 0) | F.coalesce(first_day > F.col("t0_order_ts"), F.lit(False))
             | F.coalesce(last_day <= end_ts, F.lit(False))).cast("int")
    return (u.withColumn("label", label).filter(F.col("kind") == 0)
             .select(*EVENT_COLS, "label"))


# --------------------------------------------------------------------------- R8-R10
def censor(events: DataFrame, cutoff: dt.date | None) -> DataFrame:
    """Keep t0_date <= cutoff (inclusive, T14)."""
    if cutoff is None:
        return events
    return events.filter(F.col("t0_date") <= F.lit(cutoff))


def censor_report(labelled: DataFrame, cutoff: dt.date | None) -> DataFrame:
    """P10 report: before, kept, dropped and kept label rate."""
    keep = F.col("t0_date") <= F.lit(cutoff) if cutoff is not None else F.lit(True)
    a = labelled.agg(F.count(F.lit(1)).alias("before"),
                     F.count_if(keep).alias("kept"),
                     F.count_if(~keep).alias("dropped"),
                     F.avg(F.when(keep, F.col("label").cast("double"))).alias("kept_label_rate"))
    return a


def split_label(cfg: RevivalConfig):
    t0 = F.col("t0_date")
    if cfg.train_end is None:
        return F.lit("train")
    return (F.when(t0 <= F.lit(cfg.train_end), F.lit("train"))
             .when(t0 >= F.lit(cfg.test_start), F.lit("test"))
             .otherwise(F.lit("embargo")))


def embargo_split(events: DataFrame, cfg: RevivalConfig, keep_embargo: bool = False) -> DataFrame:
    """Train (t0 <= TRAIN_END) / test (t0 >= TRAIN_END + embargo);
    embargo rows are dropped unless ``keep_embargo``."""
    out = events.withColumn("split", split_label(cfg))
    return out if keep_embargo else out.filter(F.col("split") != "embargo")


def row_index(df: DataFrame, name: str = "_idx") -> DataFrame:
    """Dense 0-based index following the partition order, then the row order
    inside each partition.

    Partition id and in-partition position are computed in one pass and
    materialised (``cut_lineage``): the counts and the index are then derived
    from the same fixed table — evaluating ``spark_partition_id()`` twice could
    disagree (e.g. AQE coalescing a shuffle differently for two readers).
    Per-partition counts -> prefix offsets (one row per partition, broadcast)."""
    from ..session import cut_lineage
    d = cut_lineage(df.withColumn("_pid", F.spark_partition_id())
                      .withColumn("_mid", F.monotonically_increasing_id()), "row_index")
    per = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    per = per.withColumn("_off", F.coalesce(F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (d.join(F.broadcast(per.select("_pid", "_m0", "_off")), "_pid")
             .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_m0"))
             .drop("_pid", "_mid", "_m0", "_off"))


ID_ORDER = ["t0_date", "member_id", "t0_order_code"]


def assign_sample_ids(samples: DataFrame, partitions: int | None = None) -> DataFrame:
    """Dense 0-based ``sample_id`` ordered by (t0_date, member_id,
    t0_order_code).

    The table is range-partitioned on the whole key — a day holding a third
    of all samples is split by member across partitions, never gathered in
    one task — sorted inside each partition, and numbered with per-partition
    offsets (``row_index``)."""
    spark = samples.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = samples.repartitionByRange(n, *ID_ORDER).sortWithinPartitions(*ID_ORDER)
    return row_index(ranged, "sample_id")


def label_inputs(valid: DataFrame, cfg: RevivalConfig,
                 materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """The two inputs of the label rule, from one valid-order table: revival
    events and the R3-1 orders (so ``revival_labels(..., same_source=True)``
    applies).  ``materialize`` cuts both once, for callers that read them
    several times."""
    from ..session import cut_lineage
    events = revival_events(gaps_with_threshold(valid, cfg))
    orders1 = unique_orders(valid, LABEL_COLS)
    if materialize:
        events = cut_lineage(events, "events")
        orders1 = cut_lineage(orders1, "label_orders")
    return events, orders1


def samples(orders: DataFrame, cfg: RevivalConfig, with_ids: bool = True) -> DataFrame:
    """R2 -> R10: raw canonical orders -> labelled sample skeleton.

    Events and label orders come from the same valid table, so the label rule
    is one aggregation and one window (``same_source``); each input is read
    once and nothing is materialised before the sample ids."""
    from .timeline import valid_purchases
    events, orders1 = label_inputs(valid_purchases(orders, cfg), cfg)
    labelled = revival_labels(events, orders1, cfg.window_days, same_source=True)
    out = embargo_split(censor(labelled, cfg.censor_cutoff), cfg)
    if not with_ids:
        return out
    return assign_sample_ids(out).select(*SAMPLE_COLS, "t0_order_ts")


# --------------------------------------------------------------------------- A17-A20, J11
def split_summary(labelled: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Per split n, label rate, first and last t0 (embargo rows included
    as their own split so the dropped count is visible)."""
    return (labelled.withColumn("split", split_label(cfg))
                    .groupBy("split")
                    .agg(F.count(F.lit(1)).alias("n"),
                         F.avg(F.col("label").cast("double")).alias("label_rate"),
                         F.min("t0_date").alias("t0_min"), F.max("t0_date").alias("t0_max")))


def split_month_dist(samples_df: DataFrame) -> DataFrame:
    """Samples per split and t0 year-month."""
    return (samples_df.groupBy("split", F.date_format("t0_date", "yyyy-MM").alias("month"))
                      .agg(F.count(F.lit(1)).alias("n")))


def split_overlap(samples_df: DataFrame) -> DataFrame:
    """Members present in both train and test, share of each side.
    One group-by on member with two flags instead of materialised sets."""
    per = samples_df.groupBy("member_id").agg(
        F.max((F.col("split") == "train").cast("int")).alias("in_train"),
        F.max((F.col("split") == "test").cast("int")).alias("in_test"))
    return per.agg(
        F.count_if((F.col("in_train") == 1) & (F.col("in_test") == 1)).alias("overlap"),
        F.count_if(F.col("in_train") == 1).alias("train_members"),
        F.count_if(F.col("in_test") == 1).alias("test_members"),
    ).select("overlap", "train_members", "test_members",
             (F.col("overlap") * 100.0 / F.col("train_members")).alias("pct_train"),
             (F.col("overlap") * 100.0 / F.col("test_members")).alias("pct_test"))


def member_intersection(a: DataFrame, b: DataFrame, col: str = "member_id") -> DataFrame:
    """Distinct values present in both inputs."""
    return a.select(col).intersect(b.select(col))


def union_splits(*dfs: DataFrame) -> DataFrame:
    """Concatenate split tables by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def funnel(orders: DataFrame, cfg: RevivalConfig, materialize: bool = True) -> DataFrame:
    """Step counts raw -> valid -> unique -> member-days -> gaps -> events
    -> kept -> train/test, as (step, value) rows in one job (label inputs
    materialised once: the member-day table feeds the day count, the gap
    count and the event chain; the label orders feed their count and the
    label rule)."""
    from ..session import cut_lineage
    from .timeline import add_threshold, dynamic_ci, member_days, purchase_gaps, valid_purchases
    valid = valid_purchases(orders, cfg)
    days = member_days(valid, cfg)
    orders1 = unique_orders(valid, LABEL_COLS)
    if materialize:
        days = cut_lineage(days, "member_days")
        orders1 = cut_lineage(orders1, "label_orders")
    # same chain as gaps_with_threshold(valid), read from the materialised days
    events = revival_events(add_threshold(dynamic_ci(purchase_gaps(days), cfg.fallback_ci), cfg))
    labelled = revival_labels(events, orders1, cfg.window_days, same_source=True)
    keep = (F.col("t0_date") <= F.lit(cfg.censor_cutoff)) if cfg.censor_cutoff else F.lit(True)
    sp = split_label(cfg)
    parts = [
        orders.agg(F.count(F.lit(1)).alias("v")).select(F.lit("raw_rows").alias("step"), "v"),
        valid.agg(F.count(F.lit(1)).alias("v")).select(F.lit("valid_rows").alias("step"), "v"),
        orders1.agg(F.count(F.lit(1)).alias("v"))
                            .select(F.lit("unique_orders").alias("step"), "v"),
        days.agg(F.count(F.lit(1)).alias("v")).select(F.lit("member_days").alias("step"), "v"),
        purchase_gaps(days).agg(F.count(F.lit(1)).alias("v")).select(F.lit("gaps").alias("step"), "v"),
        labelled.agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("member_id").alias("event_members"),
            F.count_if(keep).alias("kept"),
            F.count_if(~keep).alias("censored"),
            F.count_if(keep & (sp == "train")).alias("train"),
            F.count_if(keep & (sp == "embargo")).alias("embargo"),
            F.count_if(keep & (sp == "test")).alias("test"),
        ).select(F.expr("stack(7, 'events', events, 'event_members', event_members, 'kept', kept,"
                        " 'censored', censored, 'train', train, 'embargo', embargo,"
                        " 'test', test) as (step, v)")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("step", F.col("v").cast("long").alias("value"))


def funnel_checks(samples_df: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Gates — overall label rate within bounds, train/test rate gap below
    the limit, both splits non-empty -> check, value, ok."""
    lo, hi = cfg.label_rate_bounds
    a = samples_df.agg(
        F.avg(F.col("label").cast("double")).alias("rate"),
        F.avg(F.when(F.col("split") == "train", F.col("label").cast("double"))).alias("tr"),
        F.avg(F.when(F.col("split") == "test", F.col("label").cast("double"))).alias("te"),
        F.count_if(F.col("split") == "train").alias("ntr"),
        F.count_if(F.col("split") == "test").alias("nte"))
    gap = F.abs(F.col("tr") - F.col("te"))
    return a.select(F.expr(
        "stack(3, 'label_rate', rate, 'split_rate_gap', abs(tr - te),"
        " 'min_split_n', cast(least(ntr, nte) as double)) as (check, value)"),
        "rate", "tr", "te", "ntr", "nte").select(
        "check", "value",
        F.when(F.col("check") == "label_rate", F.col("value").between(lo, hi))
         .when(F.col("check") == "split_rate_gap", F.col("value") < cfg.max_split_rate_gap)
         .otherwise(F.col("value") > 0).alias("ok"))
