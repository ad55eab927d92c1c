"""F1-F6 semantics on hand-made rows (FIXTURES §4)."""
import datetime as dt

from helpers import order, ts

from rekindle.config import RevivalConfig
from rekindle.operators import features as FE
from rekindle.operators import timeline as TL

CFG = RevivalConfig()
SAMPLE_SCHEMA = "sample_id long, label int, member_id long, t0_date date, t0_order_code string, split string"


def samples(spark, rows):
    return spark.createDataFrame([(i, 0, m, d, c, "train") for i, (m, d, c) in enumerate(rows)], SAMPLE_SCHEMA)


def hist(spark, orders_df, order_rows, sample_rows, cfg=CFG):
    ofl = TL.scan_orders_flagged(orders_df(order_rows), cfg)
    s = samples(spark, sample_rows)
    return {r.sample_id: r for r in FE.f1_history(s, ofl, cfg).join(
        FE.f6_recent(s, ofl, cfg), "sample_id").collect()}


def test_same_day_orders_before_t0_are_not_history(spark, orders_df):
    rows = [order(1, "old", "2023-01-01 10:00:00"), order(1, "am", "2023-06-01 08:00:00"),
            order(1, "t0", "2023-06-01 12:00:00")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 6, 1), "t0")])[0]
    assert r.hist_n_orders == 1 and r.prior_once_only == 1


def test_sleep_days_floor(spark, orders_df):
    rows = [order(1, "a", "2023-01-01 17:55:00"), order(1, "t0", "2023-01-11 09:00:00")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 1, 11), "t0")])[0]
    assert r.sleep_days == 9 and r.member_tenure_days == 9


def test_no_history_defaults(spark, orders_df):
    rows = [order(1, "t0", "2023-01-11 09:00:00")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 1, 11), "t0")])[0]
    assert r.hist_n_orders is None and r.sleep_days is None
    assert r.was_sealed == 0 and r.prior_once_only == 0
    assert r.hist_main_channel == "unknown" and r.recent_90d_n_orders == 0
    assert r.pre_dormancy_90d_n_orders == 0 and r.pre_dormancy_90d_amount == 0.0


def test_fewer_than_two_gaps_is_null(spark, orders_df):
    rows = [order(1, "a", "2023-01-01 10:00:00"), order(1, "b", "2023-01-05 10:00:00"),
            order(1, "t0", "2023-03-01 10:00:00")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 3, 1), "t0")])[0]
    assert r.personal_ci is None and r.gap_std is None and r.gap_cv is None
    rows.append(order(1, "c", "2023-01-15 10:00:00"))
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 3, 1), "t0")])[0]
    assert r.personal_ci == 7.0 and abs(r.gap_std - 4.242640687) < 1e-6


def test_zero_denominator_and_null_coupon(spark, orders_df):
    rows = [order(1, "a", "2023-01-01 10:00:00", total_price=0.0, total_discount=5.0,
                  total_coupon_discount=None),
            order(1, "t0", "2023-03-01 10:00:00")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 3, 1), "t0")])[0]
    assert r.hist_discount_ratio is None and r.hist_coupon_order_ratio == 1.0


def test_mode_ties_by_value(spark, orders_df):
    rows = [order(1, "a", "2023-01-01 10:00:00", channel="Web"),
            order(1, "b", "2023-01-02 10:00:00", channel="App"),
            order(1, "c", "2023-01-03 10:00:00", channel="Web"),
            order(1, "d", "2023-01-04 10:00:00", channel="App"),
            order(1, "t0", "2023-03-01 10:00:00", channel="Web")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 3, 1), "t0")])[0]
    assert r.hist_main_channel == "App"


def test_pre_dormancy_lower_edge(spark, orders_df):
    # last purchase D 17:55 -> last_purchase_date = D+1 midnight; window ((D+1)-90d, D+1]
    last = ts("2023-05-10 17:55:00")
    edge = dt.datetime(2023, 5, 11) - dt.timedelta(days=90)
    rows = [order(1, "out", edge), order(1, "in", edge + dt.timedelta(seconds=1)),
            order(1, "last", last), order(1, "t0", "2023-12-01 10:00:00")]
    r = hist(spark, orders_df, rows, [(1, dt.date(2023, 12, 1), "t0")])[0]
    assert r.pre_dormancy_90d_n_orders == 2


def test_recent_window_is_open(spark, orders_df):
    t0 = dt.date(2023, 12, 1)
    lo = dt.datetime(2023, 12, 1) - dt.timedelta(days=90)
    rows = [order(1, "out", lo), order(1, "in", lo + dt.timedelta(seconds=1)),
            order(1, "t0", "2023-12-01 10:00:00")]
    r = hist(spark, orders_df, rows, [(1, t0, "t0")])[0]
    assert r.recent_90d_n_orders == 1 and r.recent_180d_n_orders == 2


def test_duplicate_code_first_row_fail_is_invalid_in_stage_two(spark, orders_df):
    rows = [order(1, "dup", "2023-01-01 08:00:00", status="Fail"),
            order(1, "dup", "2023-01-01 09:00:00", status="Finish")]
    df = orders_df(rows)
    assert TL.unique_orders(TL.valid_purchases(df, CFG)).count() == 1          # stage 1 keeps it
    fl = TL.scan_orders_flagged(df, CFG).collect()
    assert len(fl) == 1 and fl[0].is_valid == 0                                  # stage 2 flags it


LINE_SCHEMA = "member_id long, order_code string, order_ts timestamp_ntz, sale_page_id string, qty int, unit_price double"


def f3(spark, lines, sample_rows, cfg=CFG):
    l = spark.createDataFrame(lines, LINE_SCHEMA)
    return {r.sample_id: r for r in FE.f3_products(samples(spark, sample_rows), l, cfg).collect()}


def test_pages_familiar_and_repeat(spark):
    h = ts("2023-01-01 10:00:00")
    t = ts("2023-03-01 10:00:00")
    lines = [(1, "h1", h, "A", 1, 10.0), (1, "h1", h, "A", 1, 10.0), (1, "h2", h, "B", 1, 5.0),
             (1, "t0", t, "A", 1, 8.0), (1, "t0", t, None, 1, 4.0),
             (2, "h3", h, None, 1, 3.0), (2, "t2", t, None, 1, 6.0)]
    s = [(1, dt.date(2023, 3, 1), "t0"), (2, dt.date(2023, 3, 1), "t2")]
    r = f3(spark, lines, s)
    assert r[0].hist_distinct_salepages == 2 and r[0].hist_repeat_sku_ratio == 0.5
    assert r[0].t0_buys_familiar_product == 1 and r[0].t0_n_distinct_salepages == 1
    assert r[0].t0_avg_unit_price == 6.0 and r[0].t0_min_unit_price == 4.0
    assert r[1].hist_distinct_salepages == 0 and r[1].hist_repeat_sku_ratio is None
    assert r[1].t0_buys_familiar_product == 0
    r = f3(spark, lines, s, CFG.with_(null_safe_pages=True))
    assert r[1].t0_buys_familiar_product == 1


def test_member_features_and_cleanup(spark):
    s = samples(spark, [(1, dt.date(2023, 1, 1), "t"), (2, dt.date(2023, 1, 1), "t"),
                        (3, dt.date(2023, 1, 1), "t")])
    m = spark.createDataFrame([
        (1, None, dt.date(1900, 1, 1), "F", dt.date(1900, 1, 1), 0, True, True, None, False, None),
        (2, "web", dt.date(2023, 1, 1), None, dt.date(2013, 1, 2), 20, None, None, True, True, "TW"),
        (3, "app", dt.date(2022, 1, 1), "M", dt.date(1980, 1, 1), 10, False, True, True, True, "JP")],
        "member_id long, register_source string, register_date date, gender string, birthday date, "
        "card_level int, is_app_installed boolean, optin_email boolean, optin_push boolean, "
        "optin_sms boolean, country string")
    f = FE.f4_member(s, FE.scan_members(m))
    r = {x.sample_id: x for x in FE.clean_ranges(f, CFG).collect()}
    assert r[0].age_at_t0 is None and r[0].member_card_level is None and r[0].register_source == "unknown"
    assert r[0].marketing_optin_count == 1 and r[0].country_code == "unknown"
    assert r[1].age_at_t0 is None        # 9.99 years -> outside [10, 100]
    assert r[1].days_since_register == 0 and r[1].marketing_optin_count == 2
    assert abs(r[2].age_at_t0 - 43.0) < 0.01 and r[2].is_app_installed == 0


def test_assembled_features_on_fixture(spark):
    from helpers import SF
    from rekindle.config import ADAPTER_A
    from rekindle.operators import events as EV
    from rekindle.sources import adapters as A
    o = A.orders_a(spark, SF)
    s = EV.samples(o, ADAPTER_A)
    f = FE.assemble_features(s, TL.scan_orders_flagged(o, ADAPTER_A),
                             FE.scan_lines_valid(A.lines_a(spark, SF), ADAPTER_A),
                             FE.scan_members(A.members_a(spark, SF)), ADAPTER_A)
    assert len(FE.FEATURE_COLS) == 57 and f.columns[6:] == FE.FEATURE_COLS
    FE.check_unique_ids(f)
    assert f.count() == s.count() == 289
    audit = FE.leakage_audit(s, TL.scan_orders_flagged(o, ADAPTER_A), ADAPTER_A)
    assert audit.filter("not ok").count() == 0
