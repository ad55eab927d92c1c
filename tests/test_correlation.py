"""Rank correlation over pairs of columns with missing values against a loop over all pairs."""
import random

import numpy as np
import pandas as pd
import pytest

from rekindle.operators import correlation as CO


def loop(data: pd.DataFrame) -> dict:
    """Pairwise complete rows, average ranks, Pearson's formula."""
    out = {}
    for i, a in enumerate(data.columns):
        for b in data.columns[i + 1:]:
            two = data[[a, b]].dropna()
            x, y = (two[c].rank().to_numpy() for c in (a, b))
            x, y = x - x.mean() if len(x) else x, y - y.mean() if len(y) else y
            den = np.sqrt((x * x).sum() * (y * y).sum())
            out[a, b] = len(two), (x * y).sum() / den if len(two) > 1 and den > 0 else None
    return out


def frame(n=400):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        base, late = rnd.random(), rnd.random() < 0.4  # two columns miss together, one alone, one more is half of them
        rows.append((base, base ** 3 + 1, None if late else base + rnd.random(), None if late else float(rnd.randint(0, 3)),
                     rnd.random() if rnd.random() < 0.7 else None, 5.0 if late else float("nan"), None, 0.0 if i % 3 else base))
    return pd.DataFrame(rows, columns=["x", "cube", "pa", "pb", "alone", "const", "nothing", "zeros"], dtype="float64")


def test_equal_to_a_loop_over_pairs(spark):
    data = frame()
    df = spark.createDataFrame([tuple(None if v != v and c != "const" else float(v) for c, v in zip(data.columns, r))
                                for r in data.to_numpy()], ", ".join(f"{c} double" for c in data.columns)).repartition(7)
    got = {(r["a"], r["b"]): (r["n"], r["rho"]) for r in CO.spearman(df, list(data.columns)).collect()}
    want = loop(data)
    assert got.keys() == want.keys()
    for k, (n, rho) in want.items():
        assert got[k][0] == n
        assert got[k][1] == (None if rho is None else pytest.approx(rho, abs=1e-12)), k
    assert got["x", "cube"][1] == pytest.approx(1.0) and got["pa", "const"] == (0, None)


def test_no_complete_row_no_row_and_one_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, None), (None, 3.0, 1.0), (None, 4.0, 2.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): (r["n"], r["rho"]) for r in CO.spearman(df, ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): (2, pytest.approx(-1.0)), ("a", "c"): (0, None), ("b", "c"): (2, pytest.approx(1.0))}
    empty = CO.spearman(df.limit(0), ["a", "b", "c"]).collect()
    assert [(r["n"], r["rho"]) for r in empty] == [(0, None)] * 3
    assert CO.spearman(df, ["a"]).count() == 0


def test_a_value_that_holds_most_rows(spark):
    df = spark.range(3000).selectExpr("cast(if(id % 10 < 8, 0, id) as double) as a",
                                      "cast(if(id % 3 = 0, 1, id % 50) as double) as b")
    r = CO.spearman(df, ["a", "b"]).first()
    assert (r["n"], r["rho"]) == (3000, pytest.approx(loop(df.toPandas())["a", "b"][1], abs=1e-12))


def test_pruning_says_why(spark):
    data = frame()[["x", "cube", "alone", "zeros"]]
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in data.to_numpy()],
                               ", ".join(f"{c} double" for c in data.columns))
    got = [tuple(r)[:4] for r in CO.pruning(df, list(data.columns)).orderBy("rank").collect()]
    assert got == [(1, "x", True, None), (2, "cube", False, "x"), (3, "alone", True, None), (4, "zeros", True, None)]
    assert CO.prune_correlated(df, ["cube", "x", "alone"]) == ["cube", "alone"]


def test_blocks_and_ranges_meet_without_a_row_a_cell(spark, monkeypatch):
    monkeypatch.setattr(CO, "BLOCK_BITS", 5)
    monkeypatch.setattr(CO, "RANGE_ROWS", 60)
    data = frame(700)
    data["whole"] = (np.arange(700) * 37 % 701).astype("float64")
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in data.to_numpy()],
                               ", ".join(f"{c} double" for c in data.columns)).repartition(3)
    r = CO.spearman(df, list(data.columns))
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan
    got, want = {(x["a"], x["b"]): (x["n"], x["rho"]) for x in r.collect()}, loop(data)
    assert got == {k: (n, None if rho is None else pytest.approx(rho, abs=1e-12)) for k, (n, rho) in want.items()}
