"""Missing-aware boosting and contributions against brute force."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rekindle.operators import boost as B
from rekindle.operators import metrics as M


def brute_contributions(model, bins: list[int]) :
    """Shapley values of one row by all coalitions, for tests: features outside one go both ways, by cover."""
    def expected(tree, at, inside):
        n = tree[at]
        if isinstance(n, B.Leaf):
            return n.value
        b = bins[n.feature]
        left = b <= n.bin and (b > 0 or n.missing_left)
        if n.feature in inside:
            return expected(tree, 2 * at + (1 if left else 2), inside)
        return sum(tree[c].cover / n.cover * expected(tree, c, inside) for c in (2 * at + 1, 2 * at + 2))
    m = len(model.cols)
    out = []
    for i in range(m):
        rest = [f for f in range(m) if f != i]
        out.append(sum(math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m)
                       * (expected(t, 0, {*c, i}) - expected(t, 0, set(c)))
                       for s in range(m) for c in itertools.combinations(rest, s) for t in model.trees))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        a, b, c = rng.random(), rng.randint(0, 5), rng.gauss(0, 1)
        lost = rng.random() < 0.3
        y = int(rng.random() < (0.85 if lost else 0.35 + 0.3 * (a > 0.5)))
        rows.append((i, "train" if i % 3 else "test", y, a, None if lost else b, c if i % 4 else float("nan"), 1.0))
    df = spark.createDataFrame(rows, "sample_id long, split string, label int, a double, b int, c double, d double").cache()
    cols = ["a", "b", "c", "d"]
    return df, cols, B.train_boosted(df.filter("split = 'train'"), cols, rounds=6, depth=3, cut=2)


def test_missing_means_yes_is_learned_without_an_indicator(fitted):
    df, cols, model = fitted
    root = model.trees[0][0]
    assert cols[root.feature] == "b" and root.bin >= 1
    auc = M.auc_roc(B.score_boosted(model, df.filter("split = 'test'"))).first()["auc_roc"]
    assert auc > 0.65
    only = B.train_boosted(df.filter("split = 'train'"), ["b"], rounds=3)
    got = {r["lost"]: r["s"] for r in B.score_boosted(only, df, keep=("b",)).groupBy(F.col("b").isNull().alias("lost"))
           .agg(F.avg("score").alias("s")).collect()}
    assert got[True] > 0.6 > got[False]


def test_contributions_equal_all_coalitions_and_sum_to_the_margin(fitted):
    df, cols, model = fitted
    x = B.binned(df, cols, model.edges).select("sample_id", "bins")
    got = {r["sample_id"]: r for r in B.contributions(model, df).collect()}
    base = B.base_value(model)
    for r in x.limit(60).collect():
        phi = got[r["sample_id"]]["phi"]
        assert phi == pytest.approx(brute_contributions(model, r["bins"]), abs=1e-9)
    for r in got.values():
        assert sum(r["phi"]) + base == pytest.approx(r["margin"], abs=1e-9)
    assert all(r["phi"][3] == 0 for r in got.values())  # a constant column


def test_direction_guards(fitted, spark):
    df, cols, model = fitted
    ex = B.contributions(model, df)
    rows = {r["feature"]: r for r in B.contribution_direction(ex, cols, {"c"}, k=4).collect()}
    assert rows["a"]["sign"] == "up" and rows["c"]["sign"] == "category" and rows["d"]["sign"] == "n/a"
    assert {r["sign"] for r in B.contribution_direction(ex.limit(10), cols, k=4).collect()} == {"n/a"}
    ranks = [r["feature"] for r in B.attribution(ex, cols).orderBy("rank").collect()]
    assert ranks[:3] == [r["feature"] for r in sorted(rows.values(), key=lambda r: r["rank"])][:3]


def test_gains_of_one_level_equal_loops(fitted):
    df, cols, model = fitted
    rows = B.binned(df, cols, model.edges).select("bins", F.col("label").cast("double").alias("y")).collect()
    graded = B.binned(df, cols, model.edges).select(F.lit(0).alias("node"), "bins", (F.lit(0.5) - F.col("label")).alias("g"),
                                                    F.lit(0.25).alias("h"))
    got = {(r["f"], r["bin"], r["missing_left"]): r["gain"] for r in B.split_gains(B.histogram(graded)).collect()}
    for (f, b, left), gain in got.items():
        side = [(r["bins"][f] == 0 and left) or 0 < r["bins"][f] <= b for r in rows]
        g = lambda want: sum(0.5 - r["y"] for r, s in zip(rows, side) if s in want)
        h = lambda want: 0.25 * sum(s in want for s in side)
        want = sum(g(w) ** 2 / (h(w) + 1) for w in ([True], [False])) / 2 - g([True, False]) ** 2 / (h([True, False]) + 1) / 2
        assert gain == pytest.approx(want, abs=1e-9)
    assert (1, 6, False) in got or any(k[0] == 1 and not k[2] for k in got)


def test_saved_and_edge_cases(fitted, spark):
    df, cols, model = fitted
    again = B.Boosted.from_json(model.to_json())
    assert B.score_boosted(again, df).orderBy("sample_id").collect() == B.score_boosted(model, df).orderBy("sample_id").collect()
    empty = df.limit(0)
    assert B.train_boosted(empty, cols).trees == []
    one = B.train_boosted(df.filter("label = 1"), cols)
    assert one.trees == [] and one.prior == 30.0
    assert B.contributions(one, df).first()["phi"] == [0.0] * 4
    blank = df.withColumn("a", F.lit(None).cast("double")).withColumn("label", F.when(F.col("sample_id") % 7 > 0, F.col("label")))
    assert len(B.train_boosted(blank, ["a"], rounds=2).trees) == 0
    assert math.isfinite(B.base_value(model))


def test_training_exchanges_a_row_a_partition_not_a_row_a_feature(fitted, spark):
    from rekindle.operators import model as MD
    from rekindle.session import in_few_partitions
    df, cols, model = fitted
    many = df.repartition(40)
    graded = B.binned(many, cols, model.edges).select((F.col("sample_id") % 3).cast("int").alias("node"), "bins",
                                                      F.col("label").cast("double").alias("g"), F.lit(0.25).alias("h"))
    hist = B.histogram(graded)
    plan = hist._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    got = {(r["node"], r["f"], r["bin"]): (r["g"], r["h"]) for r in hist.collect()}
    want = {}
    for r in graded.collect():
        for f, b in enumerate(r["bins"]):
            g, h = want.get((r["node"], f, b), (0.0, 0.0))
            want[r["node"], f, b] = g + r["g"], h + r["h"]
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    data, encode = MD.fit_encoding(many, [], cols)
    assert data.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert in_few_partitions(many, 40 << 19).rdd.getNumPartitions() == 40


def test_trees_are_walked_in_arrays_not_in_the_plan(spark):
    tree = {0: B.Split(0, 1, True, 4.0), 1: B.Leaf(-1.0, 2.0), 2: B.Split(1, 2, False, 2.0), 5: B.Leaf(0.5, 1.0), 6: B.Leaf(2.0, 1.0)}
    bins = np.array([[0, 1], [1, 0], [2, 2], [2, 0], [3, 3]], np.int32)
    assert B.node_of(tree, bins).tolist() == [1, 1, 5, 6, 6]  # a missing value (0) goes left, then right
    assert B.add_values(np.full(5, 0.25), [tree, tree], bins).tolist() == [-1.75, -1.75, 1.25, 4.25, 4.25]
    m = B.Boosted(["a", "b"], [[1.0, 2.0], [1.0, 2.0]], 0.25, [tree, tree])
    df = spark.createDataFrame([(1, None, 0.5), (2, 0.5, None), (3, 1.5, 1.5), (4, 1.5, None), (5, 9.0, 9.0)], "sample_id long, a double, b double")
    s = B.score_boosted(m, df, keep=("sample_id",))
    assert "CASE WHEN" not in s._jdf.queryExecution().executedPlan().toString()
    got = [r["score"] for r in s.orderBy("sample_id").collect()]
    assert got == pytest.approx([1 / (1 + np.exp(-x)) for x in (-1.75, -1.75, 1.25, 4.25, 4.25)])
