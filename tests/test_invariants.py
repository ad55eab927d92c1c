"""Invariants of SURVEY §5(c) on the supplied fixture: labels do not depend on
orders after the label window; features do not depend on any order at or
after t0_date (same day later in the day included)."""
import datetime as dt

from helpers import SF
from pyspark.sql import functions as F

from rekindle.config import ADAPTER_A
from rekindle.operators import events as EV
from rekindle.operators import features as FE
from rekindle.operators import timeline as TL
from rekindle.sources import adapters as A


def _as_orders(df, template):
    """Columns of ``df`` cast to the template schema; absent ones NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in template.schema.fields])


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_labels_ignore_orders_after_the_window(spark):
    cfg = ADAPTER_A
    o = A.orders_a(spark, SF)
    last = o.agg(F.max("order_ts")).first()[0]
    late_ts = last + dt.timedelta(days=cfg.window_days + 2)
    late = _as_orders(o.select("member_id").distinct().select(
        "member_id", (-F.col("member_id") - 1).alias("order_code"),
        F.lit(late_ts).alias("order_ts"), F.lit("Finish").alias("status"),
        F.lit(100.0).alias("sales_amount")), o)

    def labels(orders):
        ev, o1 = EV.label_inputs(TL.valid_purchases(orders, cfg), cfg, materialize=False)
        return EV.revival_labels(ev, o1, cfg.window_days)
    base = labels(o)
    more = labels(o.unionByName(late))
    # every original event keeps its t0 order and label; only events at the new day are added
    assert base.exceptAll(more).count() == 0
    assert more.exceptAll(base).filter(F.col("t0_date") != F.lit(late_ts.date())).count() == 0


def test_features_ignore_orders_from_t0_on(spark):
    cfg = ADAPTER_A
    o = A.orders_a(spark, SF)
    lines = A.lines_a(spark, SF)
    members = FE.scan_members(A.members_a(spark, SF))
    s = EV.samples(o, cfg).cache()
    # from each member's last t0 on (an order after an earlier t0 is rightly
    # history of the member's later samples)
    t0 = F.col("t0_date").cast("timestamp_ntz")
    last = s.groupBy("member_id").agg(F.max("t0_date").alias("t0_date"),
                                      F.max("sample_id").alias("sample_id"))
    fut = last.select("member_id", "sample_id", F.explode(F.array(
        F.struct(F.lit(1).alias("k"), (t0 + F.expr("INTERVAL 23 HOURS")).alias("ts")),
        F.struct(F.lit(2).alias("k"), (t0 + F.expr("INTERVAL 5 DAYS")).alias("ts")))).alias("e"))
    fut = fut.select("member_id", (-(F.col("sample_id") * 2 + F.col("e.k"))).alias("order_code"),
                     F.col("e.ts").alias("order_ts"), F.lit("Finish").alias("status"),
                     F.lit(999.0).alias("sales_amount"), F.lit(3).alias("qty"),
                     F.lit("Web").alias("channel"), F.lit("CARD").alias("payment"))
    o2 = o.unionByName(_as_orders(fut, o))
    fut_lines = _as_orders(fut.select("member_id", "order_code", "order_ts",
                                      F.lit(1).alias("sale_page_id"), "qty",
                                      F.lit(10.0).alias("unit_price"), "status"), lines)
    lines2 = lines.unionByName(fut_lines)

    def feats(orders, ls):
        return FE.assemble_features(s, TL.scan_orders_flagged(orders, cfg),
                                    FE.scan_lines_valid(ls, cfg), members, cfg)
    base = feats(o, lines)
    assert _same(base, feats(o2, lines2))
    # control: the same orders one day before the last t0 are history and show up
    early = _as_orders(fut.withColumn("order_ts", F.col("order_ts") - F.expr("INTERVAL 6 DAYS")), o)
    assert not _same(base, feats(o.unionByName(early), lines))
    s.unpersist()
