"""NULL and odd timestamps, NULL and duplicate members, wide categories, empty columns, histograms."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rekindle.config import ADAPTER_A, RevivalConfig
from rekindle.operators import events as EV
from rekindle.operators import features as FE
from rekindle.operators import metrics as M
from rekindle.operators import model as MD
from rekindle.operators import study as ST
from rekindle.operators import timeline as TL
from rekindle.sources import adapters as A
from rekindle.sources import io
from helpers import SF, order

CFG = RevivalConfig()


@pytest.mark.parametrize(("text", "want"), [
    ("2023-01-05 10:20", dt.datetime(2023, 1, 5, 10, 20)),
    ("2023-01-05 10:20:30.1234567", dt.datetime(2023, 1, 5, 10, 20, 30, 123456)),
    ("2023-01-05T10:20:30.123", dt.datetime(2023, 1, 5, 10, 20, 30, 123000)),
    ("2023-01-05T10:20:30Z", dt.datetime(2023, 1, 5, 10, 20, 30)),
    ("2023/1/5 10:20", dt.datetime(2023, 1, 5, 10, 20)),
    ("2023-01-05 10:20:30+08:00", dt.datetime(2023, 1, 5, 10, 20, 30)),
    ("2023-01-05 10:20:30", dt.datetime(2023, 1, 5, 10, 20, 30)),
    (" 2023/01/05 ", dt.datetime(2023, 1, 5)),
    ("2023-01-05", dt.datetime(2023, 1, 5)),
    ("", None), ("no date", None), (None, None)])
def test_timestamp_layouts(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(io.parse_ts("t")).first()[0] == want


def test_text_that_is_no_timestamp_is_reported_or_fails(spark, tmp_path):
    df = spark.createDataFrame([("2023-01-05",), ("x",), ("",), (None,), ("5 May",)], "t string")
    assert tuple(io.unparsed_timestamps(df, ["t"]).first()) == ("t", 3, 2)
    with pytest.raises(Exception, match="not a timestamp"):
        df.select(io.parse_ts("t", "error")).collect()
    (tmp_path / "o.csv").write_text("ShopMemberId,TradesGroupCode,OrderDateTime\nm,c,yesterday\n")
    cols = {k: io.ORDER_COLUMN_MAP[k] for k in ("ShopMemberId", "TradesGroupCode", "OrderDateTime")}
    with pytest.raises(Exception, match="not a timestamp"):
        io.scan_orders(spark, str(tmp_path / "o.csv"), colmap=cols).collect()
    assert io.scan_orders(spark, str(tmp_path / "o.csv"), colmap=cols, on_bad_ts="null").first()["order_ts"] is None


def test_dated_copy_of_an_order_is_kept(orders_df):
    df = orders_df([order(1, "c", None), order(1, "c", "2022-01-03"), order(1, "d", None)])
    got = {r["order_code"]: r["order_ts"] for r in TL.dedup_orders(df).collect()}
    assert got == {"c": dt.datetime(2022, 1, 3), "d": None}


def test_undated_orders_are_no_history(spark, orders_df):
    rows = [order(1, "a", "2022-01-01"), order(1, "b", "2022-02-01"), order(1, "c", "2022-12-01")]
    extra = [order(1, "u1", None), order(1, "u2", None, status="Return")]
    s = EV.samples(orders_df(rows), CFG)
    plain = FE.history_features(s, TL.scan_orders_flagged(orders_df(rows), CFG), CFG).collect()
    with_undated = FE.history_features(s, TL.scan_orders_flagged(orders_df(rows + extra), CFG), CFG).collect()
    assert plain == with_undated and plain[0]["hist_n_orders"] == 2
    assert EV.samples(orders_df(rows + extra), CFG).collect() == s.collect()


def test_orders_without_a_member_make_no_event(orders_df):
    rows = [order(None, f"n{i}", w) for i, w in enumerate(["2022-01-01", "2022-12-01", "2022-12-05"])]
    rows += [order(7, f"m{i}", w) for i, w in enumerate(["2022-01-01", "2022-12-01"])]
    df = orders_df(rows)
    assert {r["member_id"] for r in EV.samples(df, CFG).collect()} == {7}
    assert {r["member_id"] for r in ST.study_gaps(df, CFG).collect()} == {7}
    counts = {r["metric"]: r["value"] for r in TL.purchase_count_dist(TL.unique_orders(TL.valid_purchases(df, CFG))).collect()}
    assert counts["max"] == 2


def members(spark, ids):
    return spark.createDataFrame([(i, "src", None, None, None, 10.0, True, True, True, True, "X") for i in ids],
                                 "member_id long, register_source string, register_date date, gender string, "
                                 "birthday date, card_level double, is_app_installed boolean, optin_email boolean, "
                                 "optin_push boolean, optin_sms boolean, country string")


def test_a_member_with_two_rows_is_refused(spark):
    s = spark.createDataFrame([(0, 5, dt.date(2023, 1, 1))], "sample_id long, member_id long, t0_date date")
    assert FE.member_dim_join(s, members(spark, [5, 6, None, None])).count() == 1
    with pytest.raises(Exception, match="several rows for member 5"):
        FE.member_dim_join(s, members(spark, [5, 5, 6])).collect()


def test_many_categories_and_an_empty_column_train(spark, tmp_path):
    rows = [(i, i % 2, "train" if i % 5 else "test", f"cat{i % 130}", None, float(i % 2) + (i % 7) / 10) for i in range(650)]
    df = spark.createDataFrame(rows, "sample_id long, label int, split string, c string, nothing double, x double")
    cols = MD.feature_columns(df)
    m = MD.train_gbt(df.filter("split = 'train'"), cols, max_iter=3)
    scored = MD.score_split(m, df)
    MD.save_model(m, str(tmp_path / "m"))
    again = MD.score_split(MD.load_model(str(tmp_path / "m")), df)
    assert sorted(scored.collect()) == sorted(again.collect())
    imp = MD.permutation_importance(m, df.filter("split = 'test'"), cols).collect()
    assert {r["feature"]: r["delta_auc"] for r in imp}["nothing"] == 0.0 and len(imp) == 3


def test_label_like_and_dated_columns_are_refused(spark):
    base = "sample_id long, label int, split string, member_id long, t0_date date, t0_order_code string, x double"
    assert MD.feature_columns(spark.createDataFrame([], base)) == ["x"]
    for more in (", t1_date date", ", seen timestamp", ", next_label double"):
        with pytest.raises(ValueError):
            MD.feature_columns(spark.createDataFrame([], base + more))


def test_attribution_covers_all_rows(spark):
    rows = [(i, int(i % 3 == 0), "test", float(i % 3 == 0) + (i * 7919 % 100) / 150) for i in range(3000)]
    df = spark.createDataFrame(rows, "sample_id long, label int, split string, x double")
    m = MD.train_gbt(df, ["x"], max_iter=2)
    got = MD.permutation_importance(m, df, ["x"]).first()
    base = M.auc_roc(MD.score_split(m, df)).first()["auc_roc"]
    assert got["auc_base"] == pytest.approx(base) and abs(got["auc_perm"] - 0.5) < 0.06


@pytest.mark.parametrize("kind", ["linear", "log", "unit"])
def test_histograms_equal_numpy(spark, kind):
    x = [0.2, 0.9, 1.0, 1.0, 1.5, 3.0, 7.9, 30.0, 55.5, 0.0]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)], "v double")
    edges = {"linear": np.linspace(0.0, 55.5, 11), "log": np.logspace(0, math.log10(56.5), 13),
             "unit": np.arange(0, 22)}[kind]
    got = ST.histogram(df, "v", len(edges) - 1, kind=kind, clip_upper=20).orderBy("bin").collect()
    want = np.histogram(np.minimum(x, 20) if kind == "unit" else x, bins=edges)[0]
    assert [r["n"] for r in got] == want.tolist()
    assert np.allclose([r["lo"] for r in got], edges[:-1]) and np.allclose([r["hi"] for r in got], edges[1:])


def test_grouped_histogram_exchanges_counts_only(spark):
    """No exchange on the group carries the rows: both counting and edges are aggregated before it."""
    df = ST.histogram(A.scored_fixture(spark, SF), "score", 50, by="label")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in p.split("Subquery")[0] or "partial_count" in p
    assert df.count() == 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = ST.histogram(A.scored_fixture(spark, SF), "score", 50, by="label")
        plan = p._jdf.queryExecution().executedPlan().toString()
        for block in plan.split("Exchange hashpartitioning(")[1:]:
            assert "partial_" in block.split("\n")[1] or "Generate" in block.split("Exchange")[0] or "HashAggregate" in block
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_personal_window_equals_the_fixed_one(spark):
    g = ST.study_gaps(A.orders_a(spark, SF), ADAPTER_A)
    fixed = {(r["member_id"], r["t_revival"]): r["n_after"] for r in ST.window_range_join(g, 90).collect()}
    same = ST.window_range_join_personal(g.withColumn("ci", F.lit(45.0)), 2.0).collect()
    assert {(r["member_id"], r["t_revival"]): r["n_after"] for r in same} == fixed


def test_quantiles_of_many_columns_need_no_row_per_column(spark):
    from rekindle.operators import quality as Q
    rng = np.random.default_rng(0)
    v = rng.normal(0, 1, (6000, 3))
    v[:2500, 1] = 0.25
    df = spark.createDataFrame([tuple(map(float, r)) for r in v], "a double, b double, c double")
    got = {(r["feature"], r["q"]): r["value"] for r in Q.exact_quantiles(df, ["a", "b", "c"], [0.01, 0.25, 0.5, 0.95]).collect()}
    for k, c in enumerate("abc"):
        for q in (0.01, 0.25, 0.5, 0.95):
            assert got[c, q] == pytest.approx(np.quantile(v[:, k], q), abs=1e-12)
