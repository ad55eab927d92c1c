"""Exact distributed quantiles against numpy (linear interpolation)."""
import numpy as np
from pyspark.sql import functions as F

from rekindle.operators import quality as Q


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(7)
    n = 3000
    a = rng.normal(50, 20, n)
    a[: n // 3] = 42.0                     # one value holds a third of the rows
    b = rng.integers(0, 5, n).astype(float)
    rows = [(float(a[i]), float(b[i]) if i % 7 else None, 3.5 if i == 0 else None, None)
            for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, one double, empty double").repartition(4)
    qs = [0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = {(r.feature, r.q): r.value
           for r in Q.exact_quantiles(df, ["a", "b", "one", "empty"], qs).collect()}
    bv = np.array([x[1] for x in rows if x[1] is not None])
    for q in qs:
        assert abs(got[("a", q)] - np.percentile(a, q * 100)) < 1e-9
        assert abs(got[("b", q)] - np.percentile(bv, q * 100)) < 1e-9
        assert got[("one", q)] == 3.5
        assert ("empty", q) not in got


def test_feature_quantiles_exact_and_approx_shapes(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(101)], "x double, y double")
    ex = {r.feature: r for r in Q.feature_quantiles(df, ["x", "y"]).collect()}
    assert (ex["x"].min, ex["x"].p25, ex["x"].p50, ex["x"].p75, ex["x"].max) == (0, 25, 50, 75, 100)
    assert ex["y"].p50 is None and ex["y"].min is None
    ap = {r.feature: r for r in Q.feature_quantiles(df, ["x", "y"], accuracy=10000).collect()}
    assert ap["x"].p50 == 50 and ap["y"].p50 is None


def test_no_task_holds_a_whole_bracket(spark, monkeypatch):
    from rekindle.operators import metrics as M
    seen = []
    plain = M.counted_prefix

    def counted(d, by, buckets=None):
        out = plain(d, by, buckets)
        spread = d.repartitionByRange(4, by, "score").groupBy(F.spark_partition_id(), by).count()
        seen.append(max(r["count"] for r in spread.collect()) / max(d.count(), 1))
        return out
    monkeypatch.setattr(Q, "counted_prefix", counted)
    n = 1999  # under ACCURACY: the one bracket is the whole column
    df = spark.range(n).select((F.col("id") * 3.5).alias("x"))
    got = Q.exact_quantiles(df, ["x"], [0.37]).collect()
    assert abs(got[0].value - np.percentile(np.arange(n) * 3.5, 37)) < 1e-9
    assert seen and seen[0] < 0.6  # four ranges


def test_ranks_without_rows_or_values(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert Q.exact_quantiles(df, ["x", "y"], [0.5]).collect() == []
    one = spark.createDataFrame([(1.0, None)], "x double, y double")
    assert [tuple(r) for r in Q.exact_quantiles(one, ["x", "y"], [0.5]).collect()] == [("x", 0.5, 1.0)]
