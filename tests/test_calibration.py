"""Logistic fit, Platt and isotonic maps, reliability and tiers on calibrated scores."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rekindle.operators import calibration as CA

SCHEMA = "id long, label int, split string, score double"


def scores(n=3000, seed=4):
    """Overconfident scores: the rate is 0.35 + 0.3 * score."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s = round(rnd.random(), 2)
        out.append((i, int(rnd.random() < 0.35 + 0.3 * s), "train" if i % 3 else "test", s))
    return out


def test_fit_is_the_optimum_of_the_loss(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(800, 2)) * [1, 30]
    y = (rnd.random(800) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - 0.05 * x[:, 1])))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)] + [(None, 1.0, 1)], "a double, b double, label int")
    w = CA.fit_logistic(df, ["a", "b"], l2=0.1)
    full = np.column_stack([np.ones(800), x])
    p = 1 / (1 + np.exp(-full @ w))
    slope = full.T @ (p - y) / 800 + 0.1 * np.array([0, *w[1:]])
    assert np.max(np.abs(slope)) < 1e-9  # strictly convex: a zero gradient is the one optimum
    assert CA.fit_logistic(df.limit(0), ["a", "b"]) == [0.0, 0.0, 0.0]


def test_constant_column_and_far_start_do_not_break_the_fit(spark):
    rows = [(float(i), 7.0, int(i > 40 or i % 5 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, c double, label int")
    w = CA.fit_logistic(df, ["a", "c"])
    alone = CA.fit_logistic(df, ["a"])
    assert all(math.isfinite(v) for v in w)
    assert w[1] == pytest.approx(alone[1], rel=1e-6) and w[0] + 7 * w[2] == pytest.approx(alone[0], rel=1e-6)


def test_platt_has_an_optimum_for_parted_classes(spark):
    rows = [(i, int(i >= 20), "train", i / 40) for i in range(40)]
    a, b = CA.fit_platt(spark.createDataFrame(rows, SCHEMA))
    assert b > 0 and math.isfinite(a)
    p = [1 / (1 + math.exp(-a - b * r[3])) for r in rows]
    want = [(21 / 22 if r[1] else 1 / 22) for r in rows]
    assert sum(p) == pytest.approx(sum(want), abs=1e-6)


def test_calibration_lowers_the_loss_and_moves_the_tiers(spark):
    maps = CA.calibrated_maps(spark.createDataFrame(scores() + [(-1, 1, "test", None), (-2, None, "test", 0.5)], SCHEMA))
    assert maps.count() == 3000 and {"raw", "platt", "isotonic", "score"} <= set(maps.columns)
    t = {(r["split"], r["map"]): r for r in CA.calibration_table(maps).collect()}
    for split in ("train", "test"):
        for m in ("platt", "isotonic"):
            assert t[split, m]["brier"] < t[split, "raw"]["brier"] and t[split, m]["log_loss"] < t[split, "raw"]["log_loss"]
    assert t["train", "isotonic"]["mean_score"] == pytest.approx(t["train", "isotonic"]["label_rate"], abs=1e-9)
    iso = [r["isotonic"] for r in maps.orderBy("score").select("isotonic").collect()]
    assert iso == sorted(iso)
    gap = {r["map"]: r["g"] for r in CA.reliability(maps).filter("split = 'test'").groupBy("map")
           .agg((F.sum(F.abs("gap") * F.col("n")) / F.sum("n")).alias("g")).collect()}
    assert gap["platt"] < gap["raw"] / 2
    high = {(r["map"], r["band"]): r["n"] for r in CA.calibrated_tiers(maps).filter("split = 'test'").collect()}
    assert high["platt", "high"] < high["raw", "high"]
    assert sum(n for (m, _), n in high.items() if m == "platt") == 1000


def test_bin_edges_and_a_split_without_rows(spark):
    rows = [(0, 1, "test", 0.0), (1, 0, "test", 0.1), (2, 1, "test", 0.999), (3, 1, "test", 1.0)]
    maps = CA.calibrated_maps(spark.createDataFrame(rows, SCHEMA))  # nothing to fit on
    assert maps.filter("platt is not null or isotonic is not null").count() == 0
    got = {(r["map"], r["bin"]): r["n"] for r in CA.reliability(maps).collect()}
    assert got == {("raw", 1): 1, ("raw", 2): 1, ("raw", 10): 2}
    assert {r["map"] for r in CA.calibrated_tiers(maps).collect()} == {"raw"}
    assert CA.calibrated_maps(spark.createDataFrame([], SCHEMA)).count() == 0
