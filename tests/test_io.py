"""Scans and sinks: declared-schema CSV with mixed timestamps, coerce, writers."""
import datetime as dt
import os
import tempfile

from rekindle.operators import events as EV
from rekindle.sources import io


def test_scan_orders_csv_mixed_timestamps_and_shop_filter(spark):
    d = tempfile.mkdtemp(prefix="rekindle-test-")
    p = os.path.join(d, "Order_TG.csv")
    with open(p, "w") as f:
        f.write("ShopId,ShopMemberId,TradesGroupCode,OrderDateTime,StatusDef,TotalSalesAmount,TsCount\n")
        f.write("s3,m1,c1,2023-01-02 10:11:12.345,Finish,100.5,2\n")
        f.write("s3,m1,c2,2023/01/05 08:00:00,Fail,abc,1\n")
        f.write("s3,m2,c3,2023-02-01,Return,-3,1\n")
        f.write("s9,m9,c9,2023-02-01,Finish,1,1\n")
    colmap = {k: v for k, v in io.ORDER_COLUMN_MAP.items()
              if k in ("ShopId", "ShopMemberId", "TradesGroupCode", "OrderDateTime", "StatusDef",
                       "TotalSalesAmount", "TsCount")}
    df = io.scan_orders(spark, p, shop_id="s3", colmap=colmap)
    rows = {r.order_code: r for r in df.collect()}
    assert set(rows) == {"c1", "c2", "c3"}
    assert rows["c1"].order_ts == dt.datetime(2023, 1, 2, 10, 11, 12, 345000)
    assert rows["c2"].order_ts == dt.datetime(2023, 1, 5, 8, 0) and rows["c2"].sales_amount is None
    assert rows["c3"].order_ts == dt.datetime(2023, 2, 1) and rows["c3"].sales_amount == -3.0


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "q string")
    assert [r.q for r in io.coerce_numeric(df, ["q"]).collect()] == [1.5, None, None]


def test_write_and_scan_samples_and_features(spark):
    d = tempfile.mkdtemp(prefix="rekindle-test-")
    s = spark.createDataFrame([(0, 1, 5, dt.date(2023, 1, 1), "c", "train"),
                               (1, 0, 6, dt.date(2023, 9, 1), "d", "test")],
                              "sample_id long, label int, member_id long, t0_date date, "
                              "t0_order_code string, split string")
    io.write_samples(s, os.path.join(d, "samples"))
    back = io.scan_samples(spark, os.path.join(d, "samples"))
    assert sorted(back.collect()) == sorted(s.select(*EV.SAMPLE_COLS).collect())
    f = s.withColumn("sleep_days", s.sample_id * 10)
    io.write_split_features(f, os.path.join(d, "features"))
    df, cols = io.scan_features(spark, os.path.join(d, "features"))
    assert cols == ["sleep_days"] and df.count() == 2
    io.write_metric_tables({"m": s.groupBy("split").count()}, os.path.join(d, "metrics"))
    assert spark.read.option("header", True).csv(os.path.join(d, "metrics", "m")).count() == 2


def test_scan_pages_keeps_one_shop_and_all_columns(spark):
    p = os.path.join(tempfile.mkdtemp(), "pages.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('ShopId,PageId,Title\ns1,1,"a, b"\ns3,2,"quoted ""c"""\ns3,3,\n')
    df = io.scan_pages(spark, p, shop_id="s3")
    assert df.columns == ["ShopId", "PageId", "Title"]
    assert sorted(map(tuple, df.collect())) == [("s3", "2", 'quoted "c"'), ("s3", "3", None)]
    assert io.scan_pages(spark, p).count() == 3


def test_bad_records_are_kept_aside(spark):
    d = tempfile.mkdtemp(prefix="rekindle-test-")
    p = os.path.join(d, "orders.csv")
    colmap = {"ShopId": "shop_id", "ShopMemberId": "member_id", "TradesGroupCode": "order_code", "OrderDateTime": "order_ts",
              "TotalSalesAmount": "sales_amount"}
    head = "ShopId,ShopMemberId,TradesGroupCode,OrderDateTime,TotalSalesAmount\n"
    right = ["s3,m1,c1,2023-01-02 10:11:12,1.5", "s3,m2,c2,,abc", "s9,m3,c3,2023-01-02,1", 's3,"m,4",c4,2023/1/5 8:00:00,2', "s3,m5,c5,2023-02-30x,3"]
    torn = ["s3,m6", "s9,m7,c7,2023-01-02,1,extra", "s3,m8,c8,not a day,1,2,3", "broken"]
    with open(p, "w") as f:
        f.write(head + "\n".join(right + torn) + "\n")
    good, bad = io.scan_checked(spark, p, colmap, shop_id="s3")
    rest = os.path.join(d, "rest.csv")  # the same file without its bad records
    with open(rest, "w") as f:
        f.write(head + "\n".join(right[:4]) + "\n")
    want = io.scan_orders(spark, rest, shop_id="s3", colmap=colmap)
    assert good.columns == want.columns and sorted(good.collect(), key=str) == sorted(want.collect(), key=str)
    assert good.select("order_code").count() == 3  # a pruned read finds the same rows
    assert sorted((r["record"], r["reason"]) for r in bad.collect()) == sorted(
        [(right[4], "order_ts")] + [(t, "fields") for t in torn])
    assert all(r["file"].endswith("orders.csv") for r in bad.collect())
    side = os.path.join(d, "bad")
    io.write_quarantine(bad, side)
    io.write_quarantine(bad, side)
    assert {(r["reason"], r["count"]) for r in spark.read.parquet(side).groupBy("reason").count().collect()} == {("order_ts", 2), ("fields", 8)}
    every, _ = io.scan_checked(spark, p, colmap)
    assert every.count() == 4
    with open(p, "w") as f:
        f.write(head)
    assert [t.count() for t in io.scan_checked(spark, p, colmap)] == [0, 0]
