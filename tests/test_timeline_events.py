"""R2-R10 rules on hand-made rows (FIXTURES §4)."""
import datetime as dt

from helpers import order, ts

from rekindle.config import RevivalConfig
from rekindle.operators import events as EV
from rekindle.operators import timeline as TL

CFG = RevivalConfig(fallback_ci=67, k=3.0, clip_lo=30, clip_hi=365, window_days=120)


def gaps_ci(spark, orders_df, days):
    rows = [order(1, f"c{i}", f"{d} 10:00:00") for i, d in enumerate(days)]
    valid = TL.valid_purchases(orders_df(rows), CFG)
    g = TL.gaps_with_threshold(valid, CFG)
    return [(r.gap_days, r.ci_days, r.ci_branch, r.threshold_days)
            for r in g.orderBy("date_to").collect()]


def test_single_purchase_has_no_gap(spark, orders_df):
    assert gaps_ci(spark, orders_df, ["2023-01-01"]) == []


def test_cycle_branches_and_truncation(spark, orders_df):
    # gaps 10, 20, 31, 40 -> cycle fallback, 10, int(15), int(median(10,20,31)=20)
    base = dt.date(2023, 1, 1)
    days, d = [base], base
    for g in (10, 20, 31, 40):
        d = d + dt.timedelta(days=g)
        days.append(d)
    got = gaps_ci(spark, orders_df, [x.isoformat() for x in days])
    assert [(g, c, b) for g, c, b, _ in got] == [(10, 67, "fallback"), (20, 10, "single"),
                                                 (31, 15, "median"), (40, 20, "median")]


def test_median_is_truncated(spark, orders_df):
    # prior gaps 10, 21 -> median 15.5 -> 15
    got = gaps_ci(spark, orders_df, ["2023-01-01", "2023-01-11", "2023-02-01", "2023-02-10"])
    assert got[-1][1] == 15


def test_cycle_ignores_future_purchases(spark, orders_df):
    a = gaps_ci(spark, orders_df, ["2023-01-01", "2023-01-11", "2023-02-01"])
    b = gaps_ci(spark, orders_df, ["2023-01-01", "2023-01-11", "2023-02-01", "2023-02-02", "2023-09-01"])
    assert b[:len(a)] == a


def events_for(spark, orders_df, rows, cfg=CFG):
    valid = TL.valid_purchases(orders_df(rows), cfg)
    ev = EV.revival_events(TL.gaps_with_threshold(valid, cfg))
    return ev.orderBy("t0_date").collect()


def test_threshold_is_strict(spark, orders_df):
    # first gap uses fallback 67 -> threshold clip(201) = 201
    eq = [order(1, "a", "2023-01-01 10:00:00"), order(1, "b", ts("2023-01-01 10:00:00") + dt.timedelta(days=201))]
    gt = [order(2, "a", "2023-01-01 10:00:00"), order(2, "b", ts("2023-01-01 10:00:00") + dt.timedelta(days=202))]
    assert events_for(spark, orders_df, eq) == []
    assert len(events_for(spark, orders_df, gt)) == 1


def test_finish_preferred_over_larger_amount(spark, orders_df):
    rows = [order(1, "a", "2023-01-01 10:00:00"),
            order(1, "s", "2023-12-01 09:00:00", status="Shipping", amount=900.0),
            order(1, "f", "2023-12-01 15:00:00", status="Finish", amount=100.0)]
    ev = events_for(spark, orders_df, rows)
    assert [(e.t0_order_code, e.t0_order_ts) for e in ev] == [("f", ts("2023-12-01 15:00:00"))]


def test_fallback_when_no_finish(spark, orders_df):
    rows = [order(1, "a", "2023-01-01 10:00:00"),
            order(1, "s1", "2023-12-01 09:00:00", status="Shipping", amount=50.0),
            order(1, "s2", "2023-12-01 11:00:00", status="Overdue", amount=70.0)]
    assert [e.t0_order_code for e in events_for(spark, orders_df, rows)] == ["s2"]


def label_of(spark, orders_df, extra):
    t0 = ts("2023-12-01 12:00:00")
    rows = [order(1, "a", "2023-01-01 10:00:00"), order(1, "t0", t0)] + extra(t0)
    valid = TL.valid_purchases(orders_df(rows), CFG)
    ev = EV.revival_events(TL.gaps_with_threshold(valid, CFG)).filter("t0_order_code = 't0'")
    o1 = TL.unique_orders(valid, TL.LABEL_COLS)
    lab = [r.label for r in EV.revival_labels(ev, o1, CFG.window_days).collect()]
    fast = [r.label for r in EV.revival_labels(ev, o1, CFG.window_days, same_source=True).collect()]
    assert lab == fast
    return lab


def test_label_edges(spark, orders_df):
    D = dt.timedelta
    assert label_of(spark, orders_df, lambda t0: [order(1, "x", t0)]) == [0]               # +0 s other code
    assert label_of(spark, orders_df, lambda t0: [order(1, "x", t0 + D(seconds=1))]) == [1]
    assert label_of(spark, orders_df, lambda t0: [order(1, "x", t0 + D(days=120))]) == [1]
    assert label_of(spark, orders_df, lambda t0: [order(1, "x", t0 + D(days=120, seconds=1))]) == [0]
    assert label_of(spark, orders_df, lambda t0: [order(1, "x", t0 + D(days=60))]) == [1]  # inner day
    assert label_of(spark, orders_df, lambda t0: [order(2, "x", t0 + D(days=60))]) == [0]  # other member


def test_label_same_code_later_row_not_counted(spark, orders_df):
    D = dt.timedelta
    # a second row of the t0 order code one hour later is the same order
    assert label_of(spark, orders_df, lambda t0: [order(1, "t0", t0 + D(hours=1))]) == [0]


def test_split_edges(spark):
    cfg = RevivalConfig(train_end=dt.date(2023, 3, 31), embargo_days=120, censor_cutoff=dt.date(2023, 11, 1))
    days = [dt.date(2023, 3, 31), dt.date(2023, 4, 1), dt.date(2023, 7, 28), dt.date(2023, 7, 29),
            dt.date(2023, 11, 1), dt.date(2023, 11, 2)]
    df = spark.createDataFrame([(1, d) for d in days], "member_id long, t0_date date")
    out = EV.embargo_split(EV.censor(df, cfg.censor_cutoff), cfg, keep_embargo=True)
    got = {r.t0_date: r.split for r in out.collect()}
    assert got == {days[0]: "train", days[1]: "embargo", days[2]: "embargo", days[3]: "test",
                   days[4]: "test"}


def test_sample_ids_dense_and_ordered(spark):
    rows = [(3, dt.date(2023, 1, 2), "c"), (1, dt.date(2023, 1, 2), "a"), (2, dt.date(2023, 1, 1), "b"),
            (5, dt.date(2023, 1, 5), "e"), (4, dt.date(2023, 1, 2), "d")]
    df = spark.createDataFrame(rows, "member_id long, t0_date date, t0_order_code string")
    got = [(r.sample_id, r.member_id) for r in EV.assign_sample_ids(df).orderBy("sample_id").collect()]
    assert got == [(0, 2), (1, 1), (2, 3), (3, 4), (4, 5)]


def test_funnel_matches_fixture_counts(spark):
    from helpers import SF
    from rekindle.config import ADAPTER_A
    from rekindle.sources import adapters as A
    f = {r.step: r.value for r in EV.funnel(A.orders_a(spark, SF), ADAPTER_A).collect()}
    assert (f["valid_rows"], f["member_days"], f["gaps"], f["events"], f["event_members"]) == \
        (1007, 1007, 857, 327, 147)
    assert (f["train"], f["embargo"], f["test"], f["censored"]) == (233, 16, 56, 22)


def test_same_source_labels_equal_general_path_on_fixtures(spark):
    """The day-aggregate label path equals the join path on both adapters."""
    from rekindle.config import ADAPTER_A, ADAPTER_B
    from rekindle.sources import adapters as A
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        for orders, cfg in ((A.orders_a(spark, sf), ADAPTER_A), (A.orders_b(spark, sf), ADAPTER_B)):
            ev, o1 = EV.label_inputs(TL.valid_purchases(orders, cfg), cfg)
            a = EV.revival_labels(ev, o1, cfg.window_days)
            b = EV.revival_labels(ev, o1, cfg.window_days, same_source=True)
            assert a.count() == b.count() > 0
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
