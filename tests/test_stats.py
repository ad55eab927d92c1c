"""Tests of the univariate statistics and the out-of-fold encoding."""
import math
import random

import pytest
from pyspark.sql import functions as F

from rekindle.operators import metrics as M
from rekindle.operators import stats as SS

# Fixed values: (dof, chi2, upper tail probability), from closed forms of the chi-square distribution.
EVEN = [(dof, x, sum(math.exp(-x / 2 + k * math.log(x / 2) - math.lgamma(k + 1)) for k in range(dof // 2)))
        for dof in (2, 4, 10, 60, 400) for x in (0.01, 1.0, 9.5, 55.0, 380.0, 470.0)]


def test_tails_equal_closed_forms(spark):
    rows = spark.createDataFrame(EVEN, "dof int, chi2 double, want double")
    for r in rows.withColumn("p", SS.chi_square_p(F.col("chi2"), F.col("dof"))).collect():
        assert r["p"] == pytest.approx(r["want"], abs=1e-10)
    zs = [0.0, 1e-9, 0.1, -0.7, 1.0, 1.5, -1.96, 2.0, 3.3, 8.0, -20.0, 60.0]
    for r in spark.createDataFrame([(z,) for z in zs], "z double").withColumn("p", SS.normal_p(F.col("z"))).collect():
        assert r["p"] == pytest.approx(math.erfc(abs(r["z"]) / math.sqrt(2)), rel=1e-9, abs=1e-300)
    odd = spark.createDataFrame([(d, x) for d in (1, 3, 7) for x in (0.3, 4.0, 30.0)], "dof int, chi2 double")
    for r in odd.withColumn("p", SS.chi_square_p(F.col("chi2"), F.col("dof"))).collect():
        # Q(s + 1, x) = Q(s, x) + x^s e^-x / Gamma(s + 1), from Q(1/2, x) = erfc(sqrt(x))
        x = r["chi2"] / 2
        want = math.erfc(math.sqrt(x)) + sum(math.exp((k + 0.5) * math.log(x) - x - math.lgamma(k + 1.5))
                                             for k in range(r["dof"] // 2))
        assert r["p"] == pytest.approx(want, abs=1e-10)


def test_adjusted_p_values(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.5, None, 0.03]
    df = spark.createDataFrame([(f"f{i}", x) for i, x in enumerate(p)], "feature string, p_value double")
    got = {r["feature"]: r["p_adjusted"] for r in SS.with_adjusted(df).collect()}
    order = sorted((x, i) for i, x in enumerate(p) if x is not None)
    want, least = {}, 1.0
    for rank, (x, i) in reversed(list(enumerate(order, 1))):
        least = min(least, x * len(order) / rank)
        want[f"f{i}"] = least
    assert got.pop("f5") is None and got == pytest.approx(want)


def test_random_labels_do_not_leak_into_the_encoding(spark):
    rng = random.Random(11)
    rows = [(i, "train" if i % 4 else "test", rng.randint(0, 1), f"c{rng.randint(0, 1500)}" if i % 9 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "sample_id long, split string, label int, c string")
    out = SS.target_encode(df, ["c"], smoothing=1.0)
    assert out.count() == 6000 and out.columns == [*df.columns, "c_te"]
    auc = {r["split"]: r["auc_roc"] for r in M.auc_ap(out.withColumnRenamed("c_te", "score"), by="split").collect()}
    assert abs(auc["train"] - 0.5) < 0.04 and abs(auc["test"] - 0.5) < 0.06
    unseen = SS.target_encode(df.filter("split = 'test'"), ["c"]).select("c_te").distinct().collect()
    assert [r["c_te"] for r in unseen] == [0.0]  # nothing to learn from
