"""Metric operators against brute force; calibration / tier edges; model properties."""
import random

import pytest

from rekindle.operators import metrics as M


def brute_auc_ap(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, prev_r = 0.0, 0.0
    for s in sorted({s for s, _ in rows}, reverse=True):
        sel = [y for x, y in rows if x >= s]
        tp = sum(sel)
        r = tp / len(pos)
        ap += (r - prev_r) * tp / len(sel)
        prev_r = r
    return auc, ap


def test_auc_ap_match_brute_force_with_ties(spark):
    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), 1 if rnd.random() < 0.4 else 0) for _ in range(400)]
    df = spark.createDataFrame([(s, y, "t") for s, y in rows], "score double, label int, split string")
    got = M.auc_ap(df, buckets=8).first()
    auc, ap = brute_auc_ap(rows)
    assert abs(got.auc_roc - auc) < 1e-12 and abs(got.average_precision - ap) < 1e-12


def test_auc_ap_with_clustered_scores_keep_buckets_small(spark):
    """A third of the rows have distinct scores packed into one 1/4096-wide
    interval: results equal brute force and no range bucket is hot."""
    from pyspark.sql import functions as F
    rnd = random.Random(11)
    rows = []
    for i in range(900):
        s = 0.6 + i * 1e-8 if i % 3 == 0 else round(rnd.random(), 3)
        rows.append((s, 1 if rnd.random() < (0.3 + 0.5 * s) else 0))
    df = spark.createDataFrame([(s, y, "t") for s, y in rows], "score double, label int, split string")
    got = M.auc_ap(df, buckets=16).first()
    auc, ap = brute_auc_ap(rows)
    assert abs(got.auc_roc - auc) < 1e-12 and abs(got.average_precision - ap) < 1e-12
    sizes = [r[0] for r in M.score_prefix(df, buckets=16).groupBy("tot_cnt").count()
             .select("count").collect()]
    assert sum(sizes) == len({s for s, _ in rows})
    per_bucket = (df.groupBy("split", "score").count()
                    .repartitionByRange(16, "split", "score")
                    .groupBy(F.spark_partition_id()).count().collect())
    assert max(r[1] for r in per_bucket) < len({s for s, _ in rows}) / 4


def test_scored_fixture_reference_values(spark):
    from helpers import SF
    from rekindle.sources import adapters as A
    got = {r.split: r for r in M.auc_ap(A.scored_fixture(spark, SF.replace("0.001", "0.01"))).collect()}
    assert abs(got["test"].auc_roc - 0.7028318930) < 1e-9
    assert abs(got["train"].average_precision - 0.6830769485) < 1e-9


def test_calibration_and_tier_edges(spark):
    df = spark.createDataFrame([(0.40, 1, "t"), (0.45, 0, "t"), (0.4500001, 1, "t"), (0.60, 1, "t"),
                                (0.3999, 0, "t"), (0.6001, 1, "t")], "score double, label int, split string")
    bins = sorted((r.bin, r.n) for r in M.midband_calibration(df).collect())
    assert bins == [(1, 2), (2, 1), (4, 1)]
    tiers = {r.band: r.n for r in M.tiers(df).collect()}
    assert tiers == {"low": 1, "mid": 4, "high": 1}


def test_smd_zero_variance_is_null(spark):
    df = spark.createDataFrame([(0.5, 1, 3.0), (0.5, 0, 3.0), (0.45, 1, 3.0)], "score double, label int, c double")
    assert M.smd_profile(df, ["c"]).first().smd is None


@pytest.mark.slow
def test_model_learns_planted_signal_and_handles_unseen_category(spark):
    from pyspark.sql import functions as F

    from rekindle.operators import model as MD
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        x = rnd.random()
        y = 1 if rnd.random() < 0.2 + 0.6 * x else 0
        rows.append((i, y, "train" if i < 450 else "test", x, None if i % 7 == 0 else rnd.random(),
                     "a" if i % 2 else "b"))
    df = spark.createDataFrame(rows, "sample_id long, label int, split string, x double, noise double, cat string")
    df = df.withColumn("cat", F.when(F.col("split") == "test", F.lit("unseen")).otherwise(F.col("cat")))
    cols = ["x", "noise", "cat"]
    m = MD.train_gbt(df.filter("split = 'train'"), cols, max_iter=10)
    scored = MD.score_split(m, df.filter("split = 'test'"))
    assert M.auc_roc(scored).first().auc_roc > 0.6
    imp = {r.feature: r.gain for r in MD.gain_importance(m, cols, df).collect()}
    assert imp["x"] > imp["cat"]


@pytest.mark.slow
def test_next_step_models_and_pruning(spark):
    from pyspark.sql import functions as F

    from rekindle.operators import stats as SS
    rnd = random.Random(5)
    rows = []
    for i in range(500):
        x = rnd.random()
        rows.append((i, int(rnd.random() < x), "train" if i < 350 else "test", x, 2 * x + 1, rnd.random(), "ab"[i % 2], None))
    from rekindle.operators import model as MD
    df = spark.createDataFrame(rows, "sample_id long, label int, split string, x double, twin double, noise double, "
                                     "cat string, nothing double")
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    cols = ["x", "noise", "cat", "nothing"]
    for kind in ("logistic", "forest"):
        m = SS.train_baseline(train, cols, kind)
        assert M.auc_roc(MD.score_split(m, test)).first().auc_roc > 0.65
    scored = MD.score_split(m, df)
    cal = SS.calibrated(SS.calibrate(scored), scored)
    got = cal.filter("split = 'train'").agg(F.avg("score"), F.avg("label"), F.min("score"), F.max("score")).first()
    assert abs(got[0] - got[1]) < 1e-6 and 0 <= got[2] <= got[3] <= 1
    from rekindle.operators import correlation as CO
    assert CO.prune_correlated(df, ["x", "twin", "noise"]) == ["x", "noise"]
