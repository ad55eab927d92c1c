"""Evaluation operators over a scored table ``(id, label, score, split)``
(M4-M9, M12, M14, M16-M18, L1, U4).

AUC-ROC and average precision need, for every distinct score, the number of
rows below it — a prefix sum over a global order.  It is computed without a
single-partition window over rows:

1. aggregate to distinct (split, score) with positive / total counts
   (partial aggregation; a score shared by a third of all rows is one row);
2. range-partition the distinct scores on (split, score) into B partitions and
   take the partition id as an *order-preserving* bucket — the bounds are
   sampled quantiles, so however the scores cluster no bucket holds more than
   about 1/B of them (a fixed-width ``floor(score * B)`` bucket can hold a
   third of all distinct scores when a model's outputs are concentrated).
   The bucketed table is materialised once, so every reader sees the same
   bucket of a score;
3. totals per (split, bucket) form a table bounded by splits x B, whose prefix
   sums are broadcast back;
4. inside a bucket, a window ordered by score adds the local prefix.

Rows without a score are not ranked.

Formulas: AUC = (sum over positives of the tie-averaged rank - P(P+1)/2) / (P N);
AP = sum over distinct scores, descending, of (delta recall) x precision
(the step sum of scikit-learn, T19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div

BUCKETS = None   # default: spark.sql.shuffle.partitions range buckets


def score_prefix(scored: DataFrame, by: str = "split", buckets: int | None = BUCKETS) -> DataFrame:
    """Per (by, distinct score): cnt, pos, rows strictly below (below_cnt,
    below_pos) and the split totals (tot_cnt, tot_pos)."""
    d = (scored.filter(F.col("score").isNotNull()).groupBy(*([by] if by else []), "score")
               .agg(F.count(F.lit(1)).alias("cnt"),
                    F.sum(F.col("label").cast("long")).alias("pos")))
    return counted_prefix(d, by, buckets)


def counted_prefix(d: DataFrame, by: str = "split", buckets: int | None = BUCKETS) -> DataFrame:
    """:func:`score_prefix` of rows counted already: one row per (by, score) with cnt and pos."""
    from ..session import cut_lineage
    keys = [by] if by else []
    n = buckets or int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(d.repartitionByRange(n, *keys, "score")
                     .withColumn("bucket", F.spark_partition_id()), "score_buckets")
    bt = d.groupBy(*keys, "bucket").agg(F.sum("cnt").alias("b_cnt"), F.sum("pos").alias("b_pos"))
    wb = Window.partitionBy(*keys).orderBy("bucket")
    bt = bt.select(*keys, "bucket",
                   F.coalesce(F.sum("b_cnt").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)).alias("off_cnt"),
                   F.coalesce(F.sum("b_pos").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)).alias("off_pos"),
                   F.sum("b_cnt").over(Window.partitionBy(*keys)).alias("tot_cnt"),
                   F.sum("b_pos").over(Window.partitionBy(*keys)).alias("tot_pos"))
    # bt has at most (#splits x buckets) rows, buckets being a partition
    # count: a proven bound, safe to broadcast
    j = d.join(F.broadcast(bt), [*keys, "bucket"])
    wi = Window.partitionBy(*keys, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return j.select(*keys, "score", "cnt", "pos", "tot_cnt", "tot_pos",
                    (F.col("off_cnt") + F.coalesce(F.sum("cnt").over(wi), F.lit(0))).alias("below_cnt"),
                    (F.col("off_pos") + F.coalesce(F.sum("pos").over(wi), F.lit(0))).alias("below_pos"))


def auc_ap(scored: DataFrame, by: str = "split", buckets: int | None = BUCKETS) -> DataFrame:
    """M4 + M5 from one prefix table -> by, auc_roc, average_precision."""
    p = score_prefix(scored, by, buckets)
    keys = [by] if by else []
    rank_sum = F.col("pos").cast("double") * (F.col("below_cnt").cast("double")
                                              + (F.col("cnt").cast("double") + 1.0) / 2.0)
    at_or_above = (F.col("tot_cnt") - F.col("below_cnt")).cast("double")
    tp_above = (F.col("tot_pos") - F.col("below_pos")).cast("double")
    ap_term = F.col("pos").cast("double") * tp_above / at_or_above
    a = p.groupBy(*keys).agg(F.sum(rank_sum).alias("rs"), F.sum(ap_term).alias("apn"),
                             F.first("tot_cnt").alias("n"), F.first("tot_pos").alias("P"))
    P = F.col("P").cast("double")
    N = (F.col("n") - F.col("P")).cast("double")
    return a.select(*keys,
                    safe_div(F.col("rs") - P * (P + 1.0) / 2.0, P * N).alias("auc_roc"),
                    safe_div("apn", P).alias("average_precision"))


def auc_roc(scored: DataFrame, by: str = "split") -> DataFrame:
    """M4: tie-aware AUC-ROC per group."""
    keys = [by] if by else []
    return auc_ap(scored, by).select(*keys, "auc_roc")


def average_precision(scored: DataFrame, by: str = "split") -> DataFrame:
    """M5: step-sum average precision per group."""
    keys = [by] if by else []
    return auc_ap(scored, by).select(*keys, "average_precision")


def _point_metrics(scored: DataFrame, by: str, threshold: float) -> DataFrame:
    """Everything that needs no ranking, in one aggregate per group."""
    keys = [by] if by else []
    pred = F.col("score") >= threshold
    y = F.col("label") == 1
    label = F.col("label").cast("double")
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("label_rate"),
        F.avg(F.pow(F.col("score") - label, 2)).alias("brier"),
        F.count_if(~pred & ~y).alias("tn"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(pred & y).alias("tp"))


def _prf() -> list[Column]:
    prec = safe_div("tp", F.col("tp") + F.col("fp"))
    rec = safe_div("tp", F.col("tp") + F.col("fn"))
    f1 = safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return [F.coalesce(c, F.lit(0.0)).alias(n) for n, c in (("precision", prec), ("recall", rec), ("f1", f1))]


def brier(scored: DataFrame, by: str = "split") -> DataFrame:
    """M6: mean squared error of the probability."""
    keys = [by] if by else []
    return _point_metrics(scored, by, 0.5).select(*keys, "brier")


def confusion_metrics(scored: DataFrame, by: str = "split", threshold: float = 0.5) -> DataFrame:
    """M7: TN/FP/FN/TP with precision, recall and F1 at ``threshold`` (pred = score >= t)."""
    keys = [by] if by else []
    return _point_metrics(scored, by, threshold).select(*keys, "tn", "fp", "fn", "tp", *_prf())


def class_report(scored: DataFrame, by: str = "split", threshold: float = 0.5) -> DataFrame:
    """M8: per-class precision / recall / F1 / support plus accuracy, macro and
    weighted averages -> by, row, precision, recall, f1, support."""
    keys = [by] if by else []
    c = confusion_metrics(scored, by, threshold)
    z = F.lit(0.0)
    p1 = F.coalesce(safe_div("tp", F.col("tp") + F.col("fp")), z)
    r1 = F.coalesce(safe_div("tp", F.col("tp") + F.col("fn")), z)
    p0 = F.coalesce(safe_div("tn", F.col("tn") + F.col("fn")), z)
    r0 = F.coalesce(safe_div("tn", F.col("tn") + F.col("fp")), z)
    f = lambda p, r: F.coalesce(safe_div(2 * p * r, p + r), z)
    s1 = F.col("tp") + F.col("fn")
    s0 = F.col("tn") + F.col("fp")
    n = s0 + s1
    acc = safe_div(F.col("tp") + F.col("tn"), n)
    wavg = lambda a0, a1: (a0 * s0 + a1 * s1) / n
    rows = c.select(*keys, F.explode(F.array(
        F.struct(F.lit("0").alias("row"), p0.alias("precision"), r0.alias("recall"),
                 f(p0, r0).alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("row"), p1.alias("precision"), r1.alias("recall"),
                 f(p1, r1).alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f(p0, r0) + f(p1, r1)) / 2).alias("f1"),
                 n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), wavg(p0, p1).alias("precision"),
                 wavg(r0, r1).alias("recall"), wavg(f(p0, r0), f(p1, r1)).alias("f1"),
                 n.alias("support")),
    )).alias("r"))
    return rows.select(*keys, "r.*")


def metric_table(scored: DataFrame, by: str = "split", threshold: float = 0.5) -> DataFrame:
    """M9: one row per group with every headline metric (one aggregate, and the ranking)."""
    keys = [by] if by else []
    points = _point_metrics(scored, by, threshold).select(*keys, "n", "label_rate", "brier", *_prf())
    return (points.join(auc_ap(scored, by), keys)
            .select(*keys, "n", "label_rate", "auc_roc", "average_precision", "brier", "precision", "recall", "f1"))


def auc_gap(scored: DataFrame, by: str = "split", a: str = "train", b: str = "test",
            limit: float = 0.1) -> DataFrame:
    """M9 gate: AUC(a) - AUC(b) and whether it is below ``limit``."""
    t = auc_roc(scored, by)
    g = t.agg(F.max(F.when(F.col(by) == a, F.col("auc_roc"))).alias("auc_a"),
              F.max(F.when(F.col(by) == b, F.col("auc_roc"))).alias("auc_b"))
    return g.select("auc_a", "auc_b", (F.col("auc_a") - F.col("auc_b")).alias("gap"),
                    ((F.col("auc_a") - F.col("auc_b")) < limit).alias("ok"))


def tiers(scored: DataFrame, by: str = "split", lo: float = 0.4, hi: float = 0.6) -> DataFrame:
    """Low (< lo) / mid ([lo, hi]) / high (> hi) -> by, band, n, pct, actual_rate."""
    keys = [by] if by else []
    s = F.col("score")
    band = F.when(s < lo, F.lit("low")).when(s <= hi, F.lit("mid")).otherwise(F.lit("high"))
    g = scored.groupBy(*keys, band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("actual_rate"))
    total = F.sum("n").over(Window.partitionBy(*keys))  # over at most three bands a group
    return g.select(*keys, "band", "n", (F.col("n") * 100.0 / total).alias("pct"), "actual_rate")


# Calibration bin edges of the original study (right-closed,
# lowest edge included, last edge 0.60001).
CAL_EDGES = [0.40, 0.45, 0.50, 0.55, 0.60001]


def midband_calibration(scored: DataFrame, by: str = "split", edges=CAL_EDGES,
                        lo: float = 0.4, hi: float = 0.6) -> DataFrame:
    """0.05-wide bins inside the mid band -> by, bin, lo, hi, n, actual_rate, mid.
    The midpoint is taken from the bin itself (T17)."""
    keys = [by] if by else []
    s = F.col("score")
    b = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        b = F.when(s <= edges[i], F.lit(i)).otherwise(b)
    b = F.when(s.between(lo, hi), b)
    g = (scored.withColumn("bin", b).filter(F.col("bin").isNotNull())
               .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"),
                                          F.avg(F.col("label").cast("double")).alias("actual_rate")))
    lo_e = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("bin"))
    hi_e = F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("bin") + 1)
    return g.select(*keys, "bin", lo_e.alias("lo"), hi_e.alias("hi"), "n", "actual_rate",
                    (F.round(lo_e, 2) + F.lit(0.025)).alias("mid"))


def score_histogram(scored: DataFrame, bins: int = 50) -> DataFrame:
    """Probability histogram per label (equal width between the label's
    min and max score) -> label, bin, lo, hi, n."""
    from .study import histogram
    return histogram(scored, "score", bins, by="label")


def midband_share(scored: DataFrame, by: str = "split", lo: float = 0.4, hi: float = 0.6) -> DataFrame:
    """Count and share of scores in [lo, hi]."""
    keys = [by] if by else []
    mid = F.col("score").between(lo, hi)
    return scored.groupBy(*keys).agg(F.count_if(mid).alias("mid_n"),
                                     (F.count_if(mid) * 100.0 / F.count(F.lit(1))).alias("mid_pct"))


def smd_profile(df: DataFrame, cols: list[str], lo: float = 0.4, hi: float = 0.6,
                score: str = "score", label: str = "label") -> DataFrame:
    """Inside the mid band, per numeric feature: mean for y=1 and y=0 and
    SMD = (m1 - m0) / sqrt((v1 + v0) / 2) with population variances, NULL when
    the denominator is 0 (T8).  One wide aggregate, then ``stack``."""
    mid = df.filter(F.col(score).between(lo, hi))
    y1 = F.col(label) == 1
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(F.when(y1, x)).alias(f"m1_{i}"), F.avg(F.when(~y1, x)).alias(f"m0_{i}"),
                 F.var_pop(F.when(y1, x)).alias(f"v1_{i}"), F.var_pop(F.when(~y1, x)).alias(f"v0_{i}")]
    a = mid.agg(*aggs)
    rows = ", ".join(f"'{c}', m1_{i}, m0_{i}, v1_{i}, v0_{i}" for i, c in enumerate(cols))
    long = a.select(F.expr(f"stack({len(cols)}, {rows}) as (feature, mean1, mean0, v1, v0)"))
    den = F.sqrt((F.col("v1") + F.col("v0")) / 2)
    return long.select("feature", "mean1", "mean0",
                       F.when(den > 0, (F.col("mean1") - F.col("mean0")) / den).alias("smd"))


def corr_moments(x: Column, y: Column) -> list[Column]:
    """Aggregates from which :func:`corr_of` takes the correlation (the built-in one fails on a constant in ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    return [F.covar_pop(x, y), F.stddev_pop(F.when(both, x)), F.stddev_pop(F.when(both, y))]


def corr_of(cov: Column, sx: Column, sy: Column) -> Column:
    return F.when((sx > 0) & (sy > 0), cov / F.when((sx > 0) & (sy > 0), sx * sy))


def direction(df: DataFrame, cols: list[str], target: str = "score", min_rows: int = 10) -> DataFrame:
    """corr(feature, target) over rows where the feature is present, with
    guards (<= min_rows rows or zero variance -> n/a) -> feature, n, corr, sign."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n_{i}"), *[e.alias(f"{n}_{i}") for n, e in zip("csy", corr_moments(x, F.col(target)), strict=True)]]
    a = df.agg(*aggs)
    a = a.withColumns({f"c_{i}": corr_of(*[F.col(f"{n}_{i}") for n in "csy"]) for i in range(len(cols))})
    rows = ", ".join(f"'{c}', n_{i}, c_{i}, s_{i}" for i, c in enumerate(cols))
    long = a.select(F.expr(f"stack({len(cols)}, {rows}) as (feature, n, corr, sd)"))
    ok = (F.col("n") > min_rows) & (F.col("sd") > 0)
    return long.select("feature", "n", F.when(ok, F.col("corr")).alias("corr"),
                       F.when(ok & (F.col("corr") > 0), F.lit("up"))
                        .when(ok, F.lit("down")).otherwise(F.lit("n/a")).alias("sign"))


def topk(df: DataFrame, value: str, k: int, by_abs: bool = False, name: str = "feature") -> DataFrame:
    """Top-k rows by value (or |value|) with their rank (ties by name)."""
    key = F.abs(F.col(value)) if by_abs else F.col(value)
    order = [key.desc_nulls_last(), F.col(name)]
    # distributed top-k (each partition keeps its k best, then one merge of
    # k x partitions rows); the rank window then runs over k rows only
    top = df.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def topk_overlap(a: DataFrame, b: DataFrame, k: int = 10, name: str = "feature") -> DataFrame:
    """U4: size of the intersection of two top-k lists (ranked by 'rank')."""
    ta = a.filter(F.col("rank") <= k).select(name)
    tb = b.filter(F.col("rank") <= k).select(name)
    return ta.join(tb, name).agg(F.count(F.lit(1)).alias("overlap"))
