"""Next steps of the study: univariate tests, encodings, winsorising,
calibration, baseline models, subgroup metrics (redundancy: ``correlation.py``).

Each is an aggregate or a small join over tables that exist already.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div
from ..session import cut_lineage
from .metrics import metric_table, score_prefix
from .model import evaluate, fit_encoding, most_categories, score_split, split_types
from .quality import extreme_values


def upper_gamma(s: Column, x: Column) -> Column:
    """Q(s, x), the regularised upper incomplete gamma function, for s a multiple of one half.

    A series below s + 1 and a continued fraction above, each over a number of terms that grows with sqrt(s)."""
    whole = F.pmod(s, F.lit(1.0)) == 0
    start = F.when(whole, F.lit(0.0)).otherwise(F.lit(0.5 * math.log(math.pi)))
    factors = F.floor(s - F.when(whole, 1.0).otherwise(0.5)).cast("int")
    first = F.when(whole, 1.0).otherwise(0.5)
    log_gamma = F.aggregate(F.filter(F.sequence(F.lit(0), F.greatest(factors, F.lit(0))), lambda i: i < factors), start,
                            lambda acc, i: acc + F.log(i + first))
    front = F.exp(s * F.log(x) - x - log_gamma)
    steps = F.sequence(F.lit(1), F.ceil(60 + 30 * F.sqrt(s)).cast("int"))
    series = F.aggregate(steps, F.struct((1 / s).alias("t"), (1 / s).alias("v")), lambda a, k: F.struct(
        (a["t"] * x / (s + k)).alias("t"), (a["v"] + a["t"] * x / (s + k)).alias("v")))["v"]
    tail = F.aggregate(F.reverse(steps), x + 0.0, lambda a, k: x + (k - s) / (1 + k / a))  # x + (1-s)/(1 + 1/(x + ...
    return F.when(x <= 0, 1.0).when(x < s + 1, F.greatest(1 - front * series, F.lit(0.0))).otherwise(front / tail)


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a standard normal z."""
    return upper_gamma(F.lit(0.5), z * z / 2)


def chi_square_p(chi2: Column, dof: Column) -> Column:
    return F.when(dof > 0, upper_gamma(F.greatest(dof, F.lit(1)) / 2.0, chi2.cast("double") / 2))


def with_adjusted(tests: DataFrame, p: str = "p_value") -> DataFrame:
    """``p_adjusted`` by Benjamini and Hochberg's step-up over all rows with a p-value (a row a feature)."""
    up = Window.orderBy(F.col(p).desc_nulls_last(), "feature").rowsBetween(Window.unboundedPreceding, 0)
    m = F.count(p).over(Window.partitionBy())
    rank = m - F.row_number().over(Window.orderBy(F.col(p).desc_nulls_last(), "feature")) + 1
    return (tests.withColumn("_r", F.when(F.col(p).isNotNull(), F.col(p) * m / F.greatest(rank, F.lit(1))))
            .withColumn("p_adjusted", F.when(F.col(p).isNotNull(), F.least(F.min("_r").over(up), F.lit(1.0)))).drop("_r"))


def _stacked(df: DataFrame, cols: list[str], kind: str, label: str) -> DataFrame:
    cells = ", ".join(f"'{c}', cast(`{c}` as {kind})" for c in cols)
    return df.select(F.expr(f"stack({len(cols)}, {cells}) as (feature, x)"), F.col(label).cast("int").alias("label"))


def mann_whitney(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """U of label 1 against 0 per numeric feature (NULLs left out; ties share ranks)
    -> feature, n1, n0, u, effect (= u / (n1 n0)), z (normal, tie-corrected), p_value,
    p_adjusted (over the features)."""
    cells = F.array(*[F.col(c).cast("double") for c in cols])
    long = df.select(F.col(label).cast("int").alias("label"), F.posexplode(cells).alias("f", "score"))
    p = score_prefix(long, by="f")  # counted per (column number, value) before any exchange
    rank = F.col("below_cnt") + (F.col("cnt") + 1) / 2.0
    a = p.groupBy("f").agg(F.sum(F.col("pos") * rank).alias("rs"), F.first("tot_cnt").cast("double").alias("n"),
                           F.first("tot_pos").alias("n1"),
                           F.sum(F.pow(F.col("cnt").cast("double"), 3) - F.col("cnt")).alias("ties"))
    a = a.withColumn("feature", F.get(F.array(*[F.lit(c) for c in cols]), F.col("f")))
    n, n1 = F.col("n"), F.col("n1").cast("double")
    n0 = n - n1
    u = F.col("rs") - n1 * (n1 + 1) / 2
    var = n1 * n0 / 12 * (n + 1 - F.col("ties") / F.greatest(n * (n - 1), F.lit(1.0)))
    return a.select("feature", "n1", n0.cast("long").alias("n0"), u.alias("u"), safe_div(u, n1 * n0).alias("effect"),
                    F.when(var > 0, (u - n1 * n0 / 2) / F.sqrt(var)).alias("z")).transform(
        lambda t: with_adjusted(t.withColumn("p_value", normal_p(F.col("z")))))


def chi_square(df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """Chi-square of category against label (NULL is a category) -> feature, categories, chi2, dof,
    p_value, p_adjusted (over the features)."""
    c = (_stacked(df, cols, "string", label).groupBy("feature", "x")
         .agg(F.count_if(F.col("label") == 1).alias("o1"), F.count_if(F.col("label") == 0).alias("o0")))
    t = c.groupBy("feature").agg(F.sum("o1").cast("double").alias("t1"), F.sum("o0").cast("double").alias("t0"))
    row, n = F.col("o1") + F.col("o0"), F.col("t1") + F.col("t0")
    term = lambda o, t: F.coalesce(F.pow(F.col(o) - row * F.col(t) / n, 2) / F.when(F.col(t) > 0, row * F.col(t) / n),
                                   F.lit(0.0))
    return (c.join(t, "feature").groupBy("feature")
            .agg(F.count(F.lit(1)).alias("categories"), F.sum(term("o1", "t1") + term("o0", "t0")).alias("chi2"))
            .withColumn("dof", F.col("categories") - 1).withColumn("p_value", chi_square_p(F.col("chi2"), F.col("dof")))
            .transform(with_adjusted))


def fold_of(id_: Column, folds: int, seed: int) -> Column:
    """Fold number of a row, from an MD5 of its id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(folds)).cast("int")


def target_encode(df: DataFrame, cols: list[str], smoothing: float = 20.0, label: str = "label", *,
                  fit: Column | None = None, id_col: str = "sample_id", folds: int = 5, seed: int = 42) -> DataFrame:
    """``df`` with ``<col>_te`` for each category column: the smoothed label rate of its category.

    Rates come from the rows ``fit`` (split 'train' by default).  Such a row gets
    the rate without its own fold, total minus fold of one aggregate, so it never
    sees its own label; any other row the rate of all.  NULL counts as
    'unknown'; a category not met there has the overall rate."""
    fit = F.coalesce(F.col("split") == "train" if fit is None else fit, F.lit(False))
    known = df.filter(fit & F.col(label).isNotNull())
    prior = F.coalesce(known.agg(F.avg(F.col(label).cast("double"))).scalar(), F.lit(0.0))
    df = df.withColumn("_fold", F.when(fit, fold_of(F.col(id_col), folds, seed)).otherwise(-1))
    for c in cols:
        key = F.coalesce(F.col(c), F.lit("unknown"))
        part = (known.groupBy(key.alias("_k"), fold_of(F.col(id_col), folds, seed).alias("_f"))
                .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("double")).alias("_s")))
        sums = part.groupBy("_k").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"),
                                      F.map_from_entries(F.collect_list(F.struct("_f", F.struct("_n", "_s")))).alias("_m"))
        own = F.element_at("_m", F.col("_fold"))  # a category's folds: ``folds`` entries at most
        n = F.col("_n") - F.coalesce(own["_n"], F.lit(0))
        rate = (F.col("_s") - F.coalesce(own["_s"], F.lit(0.0)) + smoothing * prior) / (n + smoothing)
        df = (df.withColumn("_k", key).join(sums, "_k", "left")
              .withColumn(f"{c}_te", F.coalesce(rate, prior)).drop("_k", "_n", "_s", "_m"))
    return df.drop("_fold")


def winsorise(df: DataFrame, cols: list[str], cap_limit: float = 20.0) -> DataFrame:
    """Each column cut at its suggested cap min(2 * P99, cap_limit) (one row of caps)."""
    caps = extreme_values(df, cols, cap_limit).agg(F.map_from_entries(F.collect_list(F.struct("feature", "cap")))).scalar()
    return df.withColumns({c: F.when(F.col(c) > caps[c], caps[c]).otherwise(F.col(c).cast("double")) for c in cols})


def calibrate(scored: DataFrame, on: str = "train") -> IsotonicRegressionModel:
    """Isotonic map from score to label rate, fitted on one split."""
    data = scored.filter(F.col("split") == on).select("score", F.col("label").cast("double").alias("label"))
    return IsotonicRegression(featuresCol="score", labelCol="label").fit(data)


def calibrated(model: IsotonicRegressionModel, scored: DataFrame) -> DataFrame:
    """``scored`` with the calibrated score in place (for re-tiering); the old one as ``raw_score``."""
    out = model.transform(scored.withColumn("label", F.col("label").cast("double")))
    return (out.withColumn("raw_score", F.col("score")).withColumn("score", F.col("prediction"))
            .withColumn("label", F.col("label").cast("int")).drop("prediction"))


def train_baseline(train: DataFrame, cols: list[str], kind: str = "logistic", seed: int = 42) -> PipelineModel:
    """Logistic regression or random forest on the same encoding as the boosted trees."""
    cats, nums = split_types(train, cols)
    data, encode = fit_encoding(train, cats, nums)
    most = most_categories(encode)
    learner = (LogisticRegression(featuresCol="features_vec", labelCol="label", maxIter=50, regParam=1e-3)
               if kind == "logistic" else
               RandomForestClassifier(featuresCol="features_vec", labelCol="label", seed=seed, numTrees=50, maxDepth=8,
                                      maxBins=max(64, most)))
    return PipelineModel([*encode.stages, learner.fit(encode.transform(data).select("label", "features_vec"))])


def baseline_comparison(features: DataFrame, cols: list[str], boosted: PipelineModel, seed: int = 42) -> DataFrame:
    """M9's numbers of the boosted trees beside logistic regression and a random forest on the same
    encoding and splits -> model, split, auc_roc, auc_pr, brier, precision, recall, f1, auc_lead.

    ``auc_lead`` is the boosted trees' AUC minus the row's on the same split."""
    train = features.filter("split = 'train'")
    models = {"gbt": boosted, "logistic": train_baseline(train, cols, "logistic", seed),
              "forest": train_baseline(train, cols, "forest", seed)}
    table = cut_lineage(reduce(DataFrame.union, [evaluate(score_split(m, features), name) for name, m in models.items()]))
    lead = table.filter("model = 'gbt'").select("split", F.col("auc_roc").alias("_top"))
    return table.join(lead, "split").withColumn("auc_lead", F.col("_top") - F.col("auc_roc")).drop("_top").select(
        *table.columns, "auc_lead")


def subgroup_metrics(scored: DataFrame, group: str, threshold: float = 0.5) -> DataFrame:
    """Headline metrics (M4-M7) per subgroup, e.g. ``was_sealed``; rows without a group are left out."""
    return metric_table(scored.filter(F.col(group).isNotNull()), by=group, threshold=threshold)
