"""Map the supplied star-schema tables onto the canonical purchase tables.

canonical ``orders``  : member_id, order_code, order_ts, status, sales_amount,
                        ts_count, qty, total_price, total_discount,
                        total_coupon_discount, channel, payment, shipping
canonical ``lines``   : member_id, order_code, order_ts, sale_page_id, qty,
                        unit_price, status
canonical ``members`` : member_id, register_source, register_date, gender,
                        birthday, card_level, is_app_installed, optin_email,
                        optin_push, optin_sms, country
``scored``            : id, score, label, split, f1, f2  (model-free metric input)

Each adapter is a plain DataFrame expression over the parquet tables, so
column pruning and filters reach the scan.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status_from_orderstatus(c):
    return (F.when(c == "F", F.lit("Finish"))
             .when(c == "O", F.lit("Return"))
             .otherwise(F.lit("Fail")))


def orders_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A: one order header per TPC-H order, money aggregated from lines."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    # money in whole cents and rates in whole hundredths: exact sums in any order, as longs
    cents, hundredths = (F.rint(F.col(c) * 100).cast("long") for c in ("l_extendedprice", "l_discount"))
    coupon = F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7), cents).otherwise(F.lit(0).cast("long"))
    # dealt by the order once: the distinct parts, the sums and the join below all find their rows there
    rows = li.select("l_orderkey", "l_partkey", "l_quantity", cents.alias("cents"), (cents * hundredths).alias("off"),
                     coupon.alias("coupon")).repartition("l_orderkey")
    agg = rows.groupBy("l_orderkey").agg(
        F.count_distinct("l_partkey").alias("ts_count"),
        F.sum("l_quantity").cast("int").alias("qty"),
        (F.sum("cents") / 100).alias("total_price"),
        (-F.sum("off") / 10000).alias("total_discount"),
        (-F.sum("coupon") / 100).alias("total_coupon_discount"),
    )
    key = F.col("o_orderkey")
    return (o.join(agg, o.o_orderkey == agg.l_orderkey, "left")
             .select(
                 F.col("o_custkey").alias("member_id"),
                 key.alias("order_code"),
                 F.col("o_orderdate").cast(T.TimestampNTZType()).alias("order_ts"),
                 _status_from_orderstatus(F.col("o_orderstatus")).alias("status"),
                 F.col("o_totalprice").alias("sales_amount"),
                 "ts_count", "qty", "total_price", "total_discount", "total_coupon_discount",
                 F.when(key % 3 == 0, F.lit("Web")).when(key % 3 == 1, F.lit("App"))
                  .otherwise(F.lit(None).cast("string")).alias("channel"),
                 F.col("o_orderpriority").alias("payment"),
                 F.when(key % 5 == 0, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("S"), (key % 5).cast("string"))).alias("shipping"),
             ))


def lines_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A order lines; 97 sale pages, every 11th part has no page."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    pk = F.col("l_partkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
              .select(
                  F.col("o_custkey").alias("member_id"),
                  F.col("l_orderkey").alias("order_code"),
                  F.col("o_orderdate").cast(T.TimestampNTZType()).alias("order_ts"),
                  F.when(pk % 11 == 0, F.lit(None).cast("long")).otherwise(pk % 97)
                   .alias("sale_page_id"),
                  F.col("l_quantity").cast("int").alias("qty"),
                  (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                  _status_from_orderstatus(F.col("o_orderstatus")).alias("status"),
              ))


def members_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter A member snapshot, with 1900-01-01 sentinels and level 0 = missing."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    ck = F.col("c_custkey")
    sentinel = F.lit(dt.date(1900, 1, 1))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .select(
                 ck.alias("member_id"),
                 F.col("c_mktsegment").alias("register_source"),
                 F.when(ck % 10 == 0, sentinel)
                  .otherwise(F.date_add(F.lit(dt.date(1994, 6, 1)), ((ck * 13) % 1500).cast("int")))
                  .alias("register_date"),
                 F.when(ck % 4 == 0, F.lit(None).cast("string"))
                  .when(ck % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
                 F.when(ck % 8 == 0, sentinel)
                  .when(ck % 50 == 1, F.lit(dt.date(2020, 1, 1)))
                  .otherwise(F.date_add(F.lit(dt.date(1945, 1, 1)), ((ck * 37) % 15000).cast("int")))
                  .alias("birthday"),
                 F.when(F.col("c_acctbal") < 0, F.lit(0))
                  .when(F.col("c_acctbal") < 5000, F.lit(10)).otherwise(F.lit(20)).alias("card_level"),
                 (ck % 3 == 0).alias("is_app_installed"),
                 (ck % 2 == 0).alias("optin_email"),
                 (ck % 5 != 0).alias("optin_push"),
                 F.when(ck % 7 == 0, F.lit(None).cast("boolean")).otherwise(F.lit(True))
                  .alias("optin_sms"),
                 F.col("n_name").alias("country"),
             ))


def orders_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: exact-timestamp events as orders (T1, T9, T10, W3 exercise)."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    null_d = F.lit(None).cast("double")
    null_s = F.lit(None).cast("string")
    return e.select(
        F.col("user_id").alias("member_id"),
        F.col("event_id").alias("order_code"),
        F.col("ts").cast(T.TimestampNTZType()).alias("order_ts"),
        F.when(et == "purchase", F.lit("Finish")).when(et == "click", F.lit("Shipping"))
         .otherwise(F.lit("Fail")).alias("status"),
        F.col("value").alias("sales_amount"),
        F.lit(None).cast("long").alias("ts_count"), F.lit(None).cast("int").alias("qty"),
        null_d.alias("total_price"), null_d.alias("total_discount"),
        null_d.alias("total_coupon_discount"),
        null_s.alias("channel"), null_s.alias("payment"), null_s.alias("shipping"),
    )


def scored_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic scored table with heavy ties (101 distinct scores)."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    s = (k * 37) % 101
    return o.select(
        k.alias("id"),
        (s.cast("double") / 100).alias("score"),
        F.when((k * 7919) % 100 < F.lit(20) + s * F.lit(Decimal("0.6")), F.lit(1))
         .otherwise(F.lit(0)).alias("label"),
        F.when(k % 3 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"),
        F.col("o_totalprice").alias("f1"),
        F.when(k % 9 == 0, F.lit(None).cast("long")).otherwise(k % 50).alias("f2"),
    )
