"""Parameter study of the dormancy rules.

The exploratory sweeps (4 multipliers x 4 windows x ...) are evaluated in a
single pass over the gap table with conditional aggregates, one per setting,
and turned into rows with ``stack`` — no settings cross join and no repeated
range joins.  ``window_stats`` needs only 0 / 1 / 2+ purchases after the
revival, so it reads the next two purchase days with ``lead`` over the
member-day timeline instead of joining events with future purchases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RevivalConfig
from .quality import exact_quantiles
from .timeline import _long, dedup_orders, on_timeline, valid_purchases

# Settings of the original study.
ADAPTIVE_KS = (1.5, 2.0, 2.5, 3.0)
FIXED_THRESHOLDS = (60, 90, 120, 180)
WINDOW_MS = (1.5, 2.0, 2.5, 3.0)
FIXED_WINDOWS = (60, 90, 120, 180)
GRID_KS = (2.0, 2.5, 3.0)


def study_gaps(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Timeline gaps with the static (whole-life) member cycle ``ci`` (T12), the
    next two purchase days after the gap end, and the last day of the data.

    -> member_id, t_last, t_revival, gap, ci, next1, next2, data_end
    """
    valid = valid_purchases(orders, cfg)
    tl = on_timeline(valid, "date").select("member_id", "date").distinct()
    w = Window.partitionBy("member_id").orderBy("date")
    data_end = tl.select(F.max("date")).scalar()
    g = (tl.select("member_id", F.lag("date").over(w).alias("t_last"),
                   F.col("date").alias("t_revival"),
                   F.lead("date", 1).over(w).alias("next1"),
                   F.lead("date", 2).over(w).alias("next2"))
           .filter(F.col("t_last").isNotNull())
           .withColumn("gap", F.datediff("t_revival", "t_last").cast("double")))
    return (g.withColumn("ci", F.percentile("gap", 0.5).over(Window.partitionBy("member_id")))
             .withColumn("data_end", data_end))


def _thr(k: float, cfg: RevivalConfig):
    return F.greatest(F.lit(float(cfg.clip_lo)), F.least(F.lit(float(cfg.clip_hi)), F.col("ci") * k))


def threshold_sweep(gaps: DataFrame, cfg: RevivalConfig,
                    ks=ADAPTIVE_KS, fixed=FIXED_THRESHOLDS) -> DataFrame:
    """Events, members with an event and dormant share per threshold setting
    -> type, setting, thr_median, events, members, dormant_pct."""
    settings = [("adaptive", f"{k}xCi", _thr(k, cfg)) for k in ks] + \
               [("fixed", f"{d}d", F.lit(float(d))) for d in fixed]
    # per member first (partial aggregation), then global
    per_m = gaps.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("gap") > t).alias(f"e{i}") for i, (_, _, t) in enumerate(settings)])
    tot = per_m.agg(F.sum("n").alias("n"),
                    *[F.sum(f"e{i}").alias(f"e{i}") for i in range(len(settings))],
                    *[F.count_if(F.col(f"e{i}") > 0).alias(f"m{i}") for i in range(len(settings))])
    med = gaps.agg(*[F.median(t).alias(f"t{i}") for i, (_, _, t) in enumerate(settings)])
    rows_t = ", ".join(f"'{s}', e{i}, m{i}" for i, (_, s, _) in enumerate(settings))
    a = tot.select("n", F.expr(f"stack({len(settings)}, {rows_t}) as (setting, events, members)"))
    rows_m = ", ".join(f"'{typ}', '{s}', t{i}" for i, (typ, s, _) in enumerate(settings))
    b = med.select(F.expr(f"stack({len(settings)}, {rows_m}) as (type, setting, thr_median)"))
    return (b.join(a, "setting")
             .select("type", "setting", "thr_median", F.col("events").cast("long"),
                     F.col("members").cast("long"),
                     (F.col("events") * 100.0 / F.col("n")).alias("dormant_pct")))


def _window_aggs(prefix: str, event, W):
    """Conditional aggregates of window_stats for one (event definition, window)."""
    ok = event & (F.datediff("data_end", "t_revival") >= W)
    c1 = F.coalesce(F.datediff("next1", "t_revival") <= W, F.lit(False))
    c2 = F.coalesce(F.datediff("next2", "t_revival") <= W, F.lit(False))
    return [F.count_if(ok).alias(f"{prefix}_n"),
            F.count_if(ok & ~c1).alias(f"{prefix}_0"),
            F.count_if(ok & c1 & ~c2).alias(f"{prefix}_1"),
            F.count_if(ok & c2).alias(f"{prefix}_2")]


def _window_rows(agg_row: DataFrame, keys: list[tuple[str, ...]], key_names: list[str]) -> DataFrame:
    parts = []
    for i, key in enumerate(keys):
        vals = ", ".join(f"'{v}'" for v in key)
        parts.append(f"{vals}, s{i}_n, s{i}_0, s{i}_1, s{i}_2")
    cols = ", ".join(key_names)
    long = agg_row.select(F.expr(
        f"stack({len(keys)}, {', '.join(parts)}) as ({cols}, n_events, c0, c1, c2)"))
    n = F.col("n_events")
    pct = lambda c: F.when(n > 0, F.col(c) * 100.0 / n)
    return long.select(*key_names, F.col("n_events").cast("long"),
                       pct("c0").alias("pct0"), pct("c1").alias("pct1"), pct("c2").alias("pct2plus"),
                       F.when(n > 0, (F.col("c1") + F.col("c2")) * 100.0 / n).alias("revival_pct"))


def window_stats(gaps: DataFrame, cfg: RevivalConfig, k: float, window, label: str) -> DataFrame:
    """A10: for events gap > clip(k*ci): keep those with t_revival + W <= data_end,
    share with 0 / 1 / 2+ purchase days in (t_revival, t_revival + W] (T11).
    ``window`` is a number of days or a Column (personalised)."""
    W = window if not isinstance(window, (int, float)) else F.lit(float(window))
    a = gaps.agg(*_window_aggs("s0", F.col("gap") > _thr(k, cfg), W))
    return _window_rows(a, [(label,)], ["window"])


def window_sweep(gaps: DataFrame, cfg: RevivalConfig, k: float = 3.0,
                 ms=WINDOW_MS, fixed=FIXED_WINDOWS, cap: int = 365) -> DataFrame:
    """window_stats for personalised windows min(m*ci, cap) and fixed
    windows, in one pass -> window, n_events, pct0, pct1, pct2plus, revival_pct."""
    ev = F.col("gap") > _thr(k, cfg)
    wins = [(f"{m}xCi", F.least(F.col("ci") * m, F.lit(float(cap)))) for m in ms] + \
           [(f"{d}d", F.lit(float(d))) for d in fixed]
    aggs = [a for i, (_, W) in enumerate(wins) for a in _window_aggs(f"s{i}", ev, W)]
    return _window_rows(gaps.agg(*aggs), [(lbl,) for lbl, _ in wins], ["window"])


def k_m_grid(gaps: DataFrame, cfg: RevivalConfig, ks=GRID_KS, ms=WINDOW_MS,
             cap: int = 365) -> DataFrame:
    """Revival % and usable events for every (k, m) -> k, m, n_events, revival_pct."""
    keys, aggs = [], []
    for k in ks:
        for m in ms:
            i = len(keys)
            keys.append((f"{k}xCi", f"{m}xCi"))
            aggs += _window_aggs(f"s{i}", F.col("gap") > _thr(k, cfg),
                                 F.least(F.col("ci") * m, F.lit(float(cap))))
    rows = _window_rows(gaps.agg(*aggs), keys, ["k", "m"])
    return rows.select("k", "m", "n_events", "revival_pct")


def k_m_pivot(grid: DataFrame) -> DataFrame:
    """A12 as the two-way table: one row per k, one column per m (revival %)."""
    return grid.groupBy("k").pivot("m").agg(F.first("revival_pct"))


def best_window(sweep: DataFrame, min_events: int = 1000) -> DataFrame:
    """Highest revival % among windows with >= min_events usable events
    (all windows if none qualifies); ties -> first listed."""
    s = sweep.withColumn("_o", F.monotonically_increasing_id())
    qualifies = (F.col("n_events") >= min_events).cast("int")
    # the sweep has one row per setting: a whole-table window on it is tiny
    s = s.withColumn("_any", F.max(qualifies).over(Window.partitionBy()))
    return (s.filter((qualifies == 1) | (F.col("_any") == 0))
             .orderBy(F.desc("revival_pct"), F.asc("_o")).limit(1).drop("_o", "_any"))


def dormancy_length_dist(gaps: DataFrame, cfg: RevivalConfig, k: float = 3.0) -> DataFrame:
    """Quantiles, mean and max of the dormant gap (gap > clip(k*ci))."""
    g = F.when(F.col("gap") > _thr(k, cfg), F.col("gap"))
    qs = [0.25, 0.5, 0.75, 0.9]
    a = gaps.agg(F.percentile(g, F.array(*[F.lit(q) for q in qs])).alias("p"),
                 F.avg(g).alias("mean"), F.max(g).alias("max"), F.count(g).alias("n"))
    a = a.select(*[F.col("p")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(qs)],
                 "mean", "max", "n")
    return _long(a, a.columns)


def return_rates(orders: DataFrame, cfg: RevivalConfig) -> DataFrame:
    """Order-level return rate (status Return or amount < 0, over all
    de-duplicated orders, T16), members with a return, returner quantiles."""
    all_ord = dedup_orders(orders)
    ret = F.coalesce(F.col("status") == cfg.status_return, F.lit(False)) | \
        F.coalesce(F.col("sales_amount") < 0, F.lit(False))
    per = all_ord.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"),
                                           F.count_if(ret).alias("r"))
    known = F.col("member_id").isNotNull()
    a = per.agg(
        (F.sum("r") * 100.0 / F.sum("n")).alias("order_return_pct"),
        F.count_if(known & (F.col("r") > 0)).alias("returning_members"),
        (F.count_if(known & (F.col("r") > 0)) * 100.0 / F.count_if(known)).alias("returning_members_pct"))
    # distinct rates grow with the data: no per-task percentile buffer
    rates = per.filter(known & (F.col("r") > 0)).select((F.col("r") / F.col("n")).alias("rate"))
    qs = [0.25, 0.5, 0.75, 0.9]
    wide = exact_quantiles(rates, ["rate"], qs).agg(*[
        F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"returner_rate_p{int(q * 100)}") for q in qs])
    return _long(a, a.columns).unionByName(_long(wide, wide.columns))


# Promotion calendar of the original study, by calendar month.
PROMO_BY_MONTH = {10: "Anniversary", 11: "Double11", 12: "Xmas"}


def monthly_volume(orders: DataFrame, cfg: RevivalConfig, promos: dict | None = None) -> DataFrame:
    """Valid unique orders per year-month, tagged with the promo calendar."""
    promos = PROMO_BY_MONTH if promos is None else promos
    u = dedup_orders(valid_purchases(orders, cfg))
    m = F.month("order_ts")
    tag = F.lit(None).cast("string")
    for mm, name in sorted(promos.items(), reverse=True):
        tag = F.when(m == mm, F.lit(name)).otherwise(tag)
    return (u.groupBy(F.date_format("order_ts", "yyyy-MM").alias("month"), tag.alias("promo"))
             .agg(F.count(F.lit(1)).alias("n")))


def window_range_join(gaps: DataFrame, window_days: int) -> DataFrame:
    """J10 (fixed window): purchase days of the member in (t_revival, t_revival + W]
    for every gap end, as a RANGE frame over the member-day timeline."""
    tl = gaps.select("member_id", F.col("t_revival").alias("date")).unionByName(
        gaps.groupBy("member_id").agg(F.min("t_last").alias("date")))
    w = Window.partitionBy("member_id").orderBy(F.unix_date("date")).rangeBetween(1, int(window_days))
    cnt = tl.withColumn("n_after", F.count(F.lit(1)).over(w))
    return gaps.select("member_id", "t_revival").join(
        cnt.select("member_id", F.col("date").alias("t_revival"), "n_after"),
        ["member_id", "t_revival"])


def window_range_join_personal(gaps: DataFrame, m: float, cap: int = 365) -> DataFrame:
    """J10 (personalised window W = min(m * ci, cap) days): purchase days in
    (t_revival, t_revival + W] for every gap end -> member_id, t_revival, window, n_after.

    No frame has a bound per row, so the member's timeline gets a probe row at
    each window's end: a running count at the probe minus the running count at
    the gap end is the number of days between them (linear in days + gaps)."""
    g = gaps.select("member_id", "t_revival", F.least(F.col("ci") * m, F.lit(float(cap))).alias("window"))
    day = g.select("member_id", F.unix_date("t_revival").cast("double").alias("at"), F.lit(1).alias("n"),
                   "t_revival", "window", F.lit("day").alias("kind"))
    probe = g.select("member_id", (F.unix_date("t_revival") + F.col("window")).alias("at"), F.lit(0).alias("n"),
                     "t_revival", "window", F.lit("probe").alias("kind"))
    w = Window.partitionBy("member_id").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    seen = day.unionByName(probe).withColumn("seen", F.sum("n").over(w))
    return (seen.groupBy("member_id", "t_revival")
            .agg(F.first("window").alias("window"),
                 (F.max(F.when(F.col("kind") == "probe", F.col("seen")))
                  - F.max(F.when(F.col("kind") == "day", F.col("seen")))).alias("n_after")))


def histogram(df: DataFrame, col: str, bins: int, kind: str = "linear",
              clip_upper: float | None = None, by: str | None = None,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Bin counts, empty bins included -> [by], bin, lo, hi, n.

    ``linear``: ``bins`` equal-width bins between min and max (last bin closed,
    as numpy); ``unit``: values clipped at ``clip_upper``, unit bins [0,1),
    [1,2) ... up to [clip_upper, clip_upper + 1]; ``log``: ``bins`` bins between
    log-spaced edges from 1 to max + 1.  Values outside the edges (below 1 for
    ``log``, below 0 for ``unit``) are in no bin.

    With ``by`` every group has edges of its own.  The edges are one aggregate,
    read as a scalar map (one entry a group), so the rows meet no join and only
    bin counts are exchanged; ``by`` is meant for a few groups."""
    x = F.col(col).cast("double")
    group = F.col(by) if by else F.lit(0)
    keys = [by] if by else []
    d = df.filter(x.isNotNull()).select(group.alias("_g"), x.alias("_x"))
    if by:
        d = d.filter(F.col("_g").isNotNull())
    if kind == "unit":
        bins = int(clip_upper) + 1
        d = d.withColumn("_x", F.least(F.col("_x"), F.lit(float(clip_upper))))
        low, high = F.lit(0.0), F.lit(float(bins))
    elif kind == "log":
        low, high = F.lit(0.0), F.log10(F.max("_x") + 1)
        d = d.filter(F.col("_x") >= 1)
    else:
        low = F.min("_x") if lo is None else F.lit(float(lo))
        high = F.max("_x") if hi is None else F.lit(float(hi))
    edges = d.groupBy("_g").agg(low.alias("lo"), high.alias("hi"))
    edges = edges.withColumn("step", (F.col("hi") - F.col("lo")) / bins)
    of = edges.agg(F.map_from_entries(F.collect_list(F.struct("_g", F.struct("lo", "hi", "step"))))).scalar()
    at = F.log10("_x") if kind == "log" else F.col("_x")
    e = d.withColumn("_e", of[F.col("_g")])
    inside = (at >= F.col("_e.lo")) & (at <= F.col("_e.hi"))
    b = F.when(F.col("_e.step") == 0, 0).otherwise(
        F.least(F.floor((at - F.col("_e.lo")) / F.col("_e.step")), F.lit(bins - 1))).cast("int")
    found = e.filter(inside).groupBy("_g", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = edges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = every.join(found, ["_g", "bin"], "left")  # bins a group on either side
    edge = lambda k: F.col("lo") + k * F.col("step")
    if kind == "log":
        edge = lambda k: F.pow(F.lit(10.0), k * F.col("step"))
    return out.select(*[F.col("_g").alias(k) for k in keys], "bin", edge(F.col("bin")).alias("lo"),
                      edge(F.col("bin") + 1).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))
