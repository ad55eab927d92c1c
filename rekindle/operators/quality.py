"""Feature sanity tables (A29-A31, A34): missing rates by group, quantiles,
extreme values and the before/after report of the range cleanup.

Each is one wide aggregate over the feature table (a single pass, partial
aggregation on every executor) turned into rows with ``stack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import FEATURE_GROUPS
from .metrics import counted_prefix


def numeric_columns(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
    names = cols if cols is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in names if isinstance(types[c], num)]


def missing_rates(features: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Missing % per feature with its group -> grp, feature, missing_pct."""
    groups = groups or FEATURE_GROUPS
    pairs = [(g, c) for g, cs in groups.items() for c in cs]
    a = features.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"m{i}")
                       for i, (_, c) in enumerate(pairs)])
    rows = ", ".join(f"'{g}', '{c}', m{i}" for i, (g, c) in enumerate(pairs))
    return a.select(F.expr(f"stack({len(pairs)}, {rows}) as (grp, feature, missing_pct)"))


def group_missing_median(missing: DataFrame) -> DataFrame:
    """Median missing % per feature group."""
    return missing.groupBy("grp").agg(F.median("missing_pct").alias("median_missing_pct"))


#: The first pass finds ranks to n / ACCURACY; a requested rank is searched among the ranks within WIDTH * n of it.
ACCURACY = 2000
WIDTH = 5 / ACCURACY


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float]) -> DataFrame:
    """The same quantiles ``qs`` of every column, see :func:`column_quantiles`."""
    return column_quantiles(df, {c: list(qs) for c in cols})


def column_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> DataFrame:
    """Exact interpolated quantiles (numpy 'linear', as ``percentile``) of each
    column in ``wanted`` -> feature, q, value; a column without values gets none.

    Two passes over the wide table and no row per (row, column): a mergeable
    quantile summary of every column gives, for each requested rank, a bracket
    of values that holds it (those few numbers reach the driver); the second
    pass counts the values below each bracket and emits only the values inside
    one, already counted per distinct value, and range-partitioned prefix sums
    find the two ranks around q * (n - 1), so that no task holds a bracket.  A
    value holding a third of the rows is one row with its count."""
    cols = list(wanted)
    x = {c: F.col(c).cast("double") for c in cols}
    aggs = []
    for i, c in enumerate(cols):
        probe = [p for q in wanted[c] for p in (max(0.0, q - WIDTH), min(1.0, q + WIDTH))]
        aggs += [F.count(x[c]).alias(f"n{i}"), F.min(x[c]).alias(f"lo{i}"), F.max(x[c]).alias(f"hi{i}"),
                 F.percentile_approx(x[c], F.array(*[F.lit(p) for p in probe]), ACCURACY).alias(f"p{i}")]
    first = df.agg(*aggs).first()
    brackets = []  # (bracket number, feature, q, lower rank, upper rank, share of the upper, lo, hi)
    for i, c in enumerate(cols):
        for j, q in enumerate(wanted[c]):
            if first[f"n{i}"]:
                pos = q * (first[f"n{i}"] - 1)
                few = first[f"n{i}"] < ACCURACY  # then the bracket would hold less than the ranks' neighbours
                lo = first[f"lo{i}"] if few or q <= WIDTH else first[f"p{i}"][2 * j]
                hi = first[f"hi{i}"] if few or q >= 1 - WIDTH else first[f"p{i}"][2 * j + 1]
                brackets.append((len(brackets), c, float(q), int(pos), -int(-pos // 1), pos - int(pos), lo, hi))
    spark = df.sparkSession
    table = spark.createDataFrame(brackets, "b int, feature string, q double, r0 long, r1 long, part double, "
                                            "lo double, hi double")
    if not brackets:
        return table.select("feature", "q", F.col("lo").alias("value"))
    # per bracket: values below it, and each value inside it with its count (rank r is the (r - below)-th of these)
    below = df.agg(*[F.count_if(x[c] < lo).alias(f"b{k}") for k, c, _, _, _, _, lo, _ in brackets])
    below = below.select(F.posexplode(F.array(*[F.col(f"b{k}") for k in range(len(brackets))])).alias("b", "below"))
    inside = F.array_compact(F.array(*[F.when(x[c].between(lo, hi), F.struct(F.lit(k).alias("b"), x[c].alias("x")))
                                       for k, c, _, _, _, _, lo, hi in brackets]))
    values = df.select(F.explode(inside).alias("s")).groupBy("s.b", F.col("s.x").alias("score")).agg(F.count(F.lit(1)).alias("cnt"))
    values = (counted_prefix(values.withColumn("pos", F.lit(0).cast("long")), "b")
              .join(F.broadcast(table), "b").join(F.broadcast(below), "b"))  # a row per bracket
    upto = F.col("below") + F.col("below_cnt") + F.col("cnt")
    at = lambda r: F.min(F.when(upto > F.col(r), F.col("score")))
    g = values.groupBy("b", "feature", "q", "part").agg(at("r0").alias("x0"), at("r1").alias("x1"))
    value = F.when(F.col("part") == 0, F.col("x0")).otherwise((1 - F.col("part")) * F.col("x0") + F.col("part") * F.col("x1"))
    return g.select("feature", "q", value.alias("value"))


def approximate_quantiles(df: DataFrame, wanted: dict[str, list[float]], accuracy: int) -> DataFrame:
    """As :func:`column_quantiles`, but to n / accuracy ranks: one pass of mergeable summaries."""
    asked = {c: [float(q) for q in qs] for c, qs in wanted.items() if qs}
    if not asked:
        return df.sparkSession.createDataFrame([], "feature string, q double, value double")
    a = df.agg(*[F.percentile_approx(F.col(c).cast("double"), F.array(*[F.lit(q) for q in qs]), accuracy).alias(f"p{i}")
                 for i, (c, qs) in enumerate(asked.items())])
    # a struct a column, its quantiles in arrays: the plan stays as small as the list of columns
    each = [F.struct(F.lit(c).alias("feature"), F.lit(qs).cast("array<double>").alias("q"), F.col(f"p{i}").alias("value"))
            for i, (c, qs) in enumerate(asked.items())]
    cells = a.select(F.explode(F.array(*each)).alias("s")).filter(F.col("s.value").isNotNull())
    return cells.select("s.feature", F.explode(F.arrays_zip("s.q", "s.value")).alias("z")).select("feature", "z.q", "z.value")


def _wide(qv: DataFrame, cols: list[str], qs: list[float], names: list[str]) -> DataFrame:
    wide = qv.groupBy("feature").agg(*[
        F.max(F.when(F.col("q") == F.lit(float(q)), F.col("value"))).alias(n) for q, n in zip(qs, names, strict=True)])
    base = qv.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return base.join(wide, "feature", "left")


def quantile_tables(features: DataFrame, cols: list[str], extreme_cols: list[str],
                    cap_limit: float = 20.0, accuracy: int | None = None) -> tuple[DataFrame, DataFrame]:
    """A30 and A31 from one computation of all the quantiles (exact, or to n / ``accuracy`` ranks)."""
    quart, ends = [0.25, 0.5, 0.75], [0.95, 0.99]
    wanted = {c: (quart if c in cols else []) + (ends if c in extreme_cols else [])
              for c in dict.fromkeys([*cols, *extreme_cols])}
    qv = approximate_quantiles(features, wanted, accuracy) if accuracy else column_quantiles(features, wanted)
    names = list(wanted)
    a = features.agg(*[f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(names)
                       for k, f in (("mn", F.min), ("mx", F.max))])
    rows = ", ".join(f"'{c}', mn{i}, mx{i}" for i, c in enumerate(names))
    ext = a.select(F.expr(f"stack({len(names)}, {rows}) as (feature, min, max)"))
    quantiles = (ext.join(_wide(qv, cols, quart, ["p25", "p50", "p75"]), "feature")
                 .select("feature", "min", "p25", "p50", "p75", "max"))
    extremes = (ext.join(_wide(qv, extreme_cols, ends, ["p95", "p99"]), "feature")
                .select("feature", "p95", "p99", "max")
                .withColumn("cap", F.least(F.col("p99") * 2, F.lit(cap_limit))))
    return quantiles, extremes


def feature_quantiles(features: DataFrame, cols: list[str], accuracy: int | None = None) -> DataFrame:
    """Min / P25 / P50 / P75 / max per numeric feature (NULLs ignored)."""
    return quantile_tables(features, cols, [], accuracy=accuracy)[0]


def extreme_values(features: DataFrame, cols: list[str], cap_limit: float = 20.0,
                   accuracy: int | None = None) -> DataFrame:
    """P95, P99, max and the suggested cap min(2 * P99, cap_limit)."""
    return quantile_tables(features, [], cols, cap_limit, accuracy)[1]


def clean_report(before: DataFrame, after: DataFrame,
                 cols=("age_at_t0", "days_since_register")) -> DataFrame:
    """Min, max and missing % of the cleaned columns before and after."""
    def one(df, stage):
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                     (F.avg(x.isNull().cast("double")) * 100).alias(f"ms{i}")]
        rows = ", ".join(f"'{stage}', '{c}', mn{i}, mx{i}, ms{i}" for i, c in enumerate(cols))
        return df.agg(*aggs).select(F.expr(
            f"stack({len(cols)}, {rows}) as (stage, feature, min, max, missing_pct)"))
    return one(before, "before").unionByName(one(after, "after"))
