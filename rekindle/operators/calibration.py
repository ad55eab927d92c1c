"""Calibration of scores and what follows from it: a logistic fit by
aggregates, Platt scaling, isotonic regression, reliability, tiers on calibrated scores.

A fit reads its rows once a Newton step, as one aggregate of gradient and Hessian
sums; the driver sees (k + 1)^2 numbers for k columns.  The isotonic map is Spark's
own pool-adjacent-violators.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import metrics as M
from .stats import calibrate, calibrated

#: The maps of a score, in the order of the tables below.
MAPS = ("raw", "platt", "isotonic")
#: The least probability of a label in the log loss.
EPS = 1e-15


def linear(coefs: list[float], xs: list[Column]) -> Column:
    eta = F.lit(float(coefs[0]))
    for c, x in zip(coefs[1:], xs):
        eta = eta + F.lit(float(c)) * x
    return eta


def sigmoid(eta: Column) -> Column:
    e = F.exp(-F.abs(eta))
    return F.when(eta >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def fit_logistic(df: DataFrame, cols: list[str], target: str = "label", *, l2: float = 0.0,
                 steps: int = 50, tol: float = 1e-10) -> list[float]:
    """Intercept and coefficients of the least mean log loss plus ``l2`` / 2 times the squared
    coefficients (the intercept is free); the target may be any share from 0 to 1.

    Newton's method from zero; a step that raises the loss is halved, so it goes
    down to the optimum, which is unique for ``l2`` > 0 (without it, classes that a
    plane parts have none, and the last step stands).  Rows with a NULL are left
    out; without rows every coefficient is 0."""
    x = cut_lineage(df.select(F.col(target).cast("double").alias("y"),
                              *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).dropna())
    k = len(cols) + 1
    xs = [F.lit(1.0), *[F.col(f"x{i}") for i in range(len(cols))]]
    ridge = np.diag([0.0] + [l2] * len(cols))
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(w):
        eta = F.col("eta")
        part = x.withColumn("eta", linear(list(w), xs[1:])).withColumn("p", sigmoid(eta))
        r = part.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta))) - F.col("y") * eta).alias("loss"),
                     *[F.sum((F.col("p") - F.col("y")) * c).alias(f"g{i}") for i, c in enumerate(xs)],
                     *[F.sum(F.col("p") * (1 - F.col("p")) * xs[i] * xs[j]).alias(f"h{i}_{j}") for i, j in upper]).first()
        if not r["n"]:
            return None
        h = np.zeros((k, k))
        for i, j in upper:
            h[i, j] = h[j, i] = r[f"h{i}_{j}"] / r["n"]
        g = np.array([r[f"g{i}"] for i in range(k)]) / r["n"]
        return r["loss"] / r["n"] + w @ ridge @ w / 2, g + ridge @ w, h + ridge

    w = np.zeros(k)
    at = sums(w)
    if at is None:
        return [0.0] * k
    step = np.linalg.lstsq(at[2], at[1], rcond=None)[0]  # a constant column has no curvature of its own
    for _ in range(steps):
        if np.max(np.abs(step)) < tol:
            break
        new = sums(w - step)
        if new[0] > at[0] + 1e-12 * (1 + abs(at[0])):
            step = step / 2
            continue
        w, at = w - step, new
        step = np.linalg.lstsq(at[2], at[1], rcond=None)[0]
    return w.tolist()


def fit_platt(scored: DataFrame, on: str = "train") -> list[float]:
    """Platt's (intercept, slope) for one split: the targets are (P + 1) / (P + 2) for label 1 and
    1 / (N + 2) for label 0, P and N being the numbers of their rows, so that classes that a
    score parts have an optimum too."""
    rows = scored.filter((F.col("split") == on) & F.col("score").isNotNull() & F.col("label").isNotNull())
    y = F.col("label") == 1
    n = rows.agg(F.count_if(y).alias("p"), F.count_if(~y).alias("n")).first()
    target = F.when(y, (n["p"] + 1.0) / (n["p"] + 2.0)).otherwise(1.0 / (n["n"] + 2.0))
    return fit_logistic(rows.withColumn("target", target), ["score"], "target")


def calibrated_maps(scored: DataFrame, on: str = "train") -> DataFrame:
    """``scored`` with the columns raw, platt and isotonic: the score and its two calibrations.

    Both are fitted on split ``on``.  Rows without a score or a label have nothing
    to be compared and are left out; if ``on`` has no other rows, platt and isotonic
    are NULL."""
    rows = cut_lineage(scored.filter(F.col("score").isNotNull() & F.col("label").isNotNull()))
    if not rows.filter(F.col("split") == on).head(1):
        none = F.lit(None).cast("double")
        return rows.withColumns({"raw": F.col("score"), "platt": none, "isotonic": none})
    coefs = fit_platt(rows, on)
    return (calibrated(calibrate(rows, on), rows).withColumnsRenamed({"score": "isotonic", "raw_score": "score"})
            .withColumns({"raw": F.col("score"), "platt": sigmoid(linear(coefs, [F.col("score")]))}))


def _by_map(maps: DataFrame, by: str) -> DataFrame:
    """A row a map: map, by, label, score."""
    each = F.array(*[F.struct(F.lit(m).alias("map"), F.col(m).alias("score")) for m in MAPS])
    return maps.select(by, "label", F.explode(each).alias("m")).select("m.map", by, "label", "m.score")


def calibration_table(maps: DataFrame, by: str = "split") -> DataFrame:
    """What calibration changes -> by, map, n, mean_score, label_rate, brier, log_loss (one aggregate)."""
    y = F.col("label").cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("label_rate")]
    for m in MAPS:
        told = F.when(y == 1, F.col(m)).otherwise(1 - F.col(m))  # the probability of the row's own label
        aggs += [F.avg(m).alias(f"s_{m}"), F.avg(F.pow(F.col(m) - y, 2)).alias(f"b_{m}"),
                 F.avg(-F.log(F.greatest(told, F.lit(EPS)))).alias(f"l_{m}")]
    rows = ", ".join(f"'{m}', s_{m}, b_{m}, l_{m}" for m in MAPS)
    return maps.groupBy(by).agg(*aggs).select(
        by, "n", "label_rate", F.expr(f"stack({len(MAPS)}, {rows}) as (map, mean_score, brier, log_loss)"))


def reliability(maps: DataFrame, by: str = "split", bins: int = 10) -> DataFrame:
    """Equal-width bins of each map -> map, by, bin (1 to ``bins``), n, mean_score, actual_rate, gap
    (mean score minus rate).  A score on an edge belongs to the upper bin, 1 to the last."""
    b = F.least(F.floor(F.col("score") * bins) + 1, F.lit(bins)).cast("int")
    return (_by_map(maps, by).filter(F.col("score").isNotNull()).groupBy("map", by, b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"),
                 F.avg(F.col("label").cast("double")).alias("actual_rate"))
            .withColumn("gap", F.col("mean_score") - F.col("actual_rate")))


def calibrated_tiers(maps: DataFrame, by: str = "split", lo: float = 0.4, hi: float = 0.6) -> DataFrame:
    """The tiers of M16 on each map -> map, by, band, n, pct, actual_rate."""
    key = F.struct("map", by).alias("key")
    rows = _by_map(maps, by).filter(F.col("score").isNotNull()).select(key, "label", "score")
    return M.tiers(rows, by="key", lo=lo, hi=hi).select("key.*", "band", "n", "pct", "actual_rate")
