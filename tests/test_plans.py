"""Plan-shape guards: no cartesian products / nested-loop joins, pushed filters."""
import datetime as dt

from helpers import SF

from rekindle.config import ADAPTER_A
from rekindle.operators import events as EV
from rekindle.operators import features as FE
from rekindle.operators import study as ST
from rekindle.operators import timeline as TL
from rekindle.plans import catalog
from rekindle.sources import adapters as A


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop(spark):
    o = A.orders_a(spark, SF)
    s = EV.samples(o, ADAPTER_A)
    f = FE.assemble_features(s, TL.scan_orders_flagged(o, ADAPTER_A),
                             FE.scan_lines_valid(A.lines_a(spark, SF), ADAPTER_A),
                             FE.scan_members(A.members_a(spark, SF)), ADAPTER_A)
    g = ST.study_gaps(o, ADAPTER_A)
    for df in (s, f, ST.window_sweep(g, ADAPTER_A), ST.threshold_sweep(g, ADAPTER_A)):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_filter_and_columns_pushed_to_scan(spark):
    df = TL.shop_filter(A.orders_a(spark, SF), "payment", "1-URGENT").select("member_id", "order_ts")
    p = plan(df)
    assert "EqualTo(o_orderpriority,1-URGENT)" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p


def test_f3_reads_lines_twice_at_most(spark):
    """F3 is one pass over the lines (page-day counts) plus the t0-lines join;
    the (member, page, day) aggregation is never recomputed per branch."""
    import re
    o = A.orders_a(spark, SF)
    s = EV.samples(o, ADAPTER_A).cache()
    f3 = FE.f3_products(s, FE.scan_lines_valid(A.lines_a(spark, SF), ADAPTER_A), ADAPTER_A)
    p = plan(f3)
    assert len(re.findall(r"FileScan parquet [^\[]*\[l_orderkey", p)) <= 2
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    s.unpersist()


def test_value_share_and_topk_have_no_single_partition_window(spark):
    import re
    from rekindle.operators import metrics as M
    o = A.orders_a(spark, SF)
    vs = TL.value_share(o, "member_id")
    p = plan(vs.select("value", "rank"))
    # the only single-partition step is the per-partition offset table
    assert "row_number()" not in p
    for m in re.finditer(r"Exchange SinglePartition[^\n]*\n[^\n]*", p):
        assert "keys=[_pid" in m.group(0)
    top = M.topk(o.select(o.member_id.cast("string").alias("feature"), "sales_amount"),
                 "sales_amount", 5)
    p = plan(top)
    assert "TakeOrderedAndProject" in p
    assert top.count() == 5 and [r.rank for r in top.orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_sample_plan_has_no_join(spark):
    """R2-R9 from one valid table: the label rule is an aggregation and a
    window on the member-day timeline, so the lazy sample plan joins nothing
    and reads the orders twice (event chain, label orders)."""
    import re
    s = EV.samples(A.orders_a(spark, SF), ADAPTER_A, with_ids=False)
    p = plan(s)
    assert "Join" not in p
    assert len(re.findall(r"FileScan parquet [^\[]*\[o_orderkey", p)) <= 2


def test_feature_windows_run_over_three_member_timelines(spark):
    """F1 and F6 share one member timeline, the modes and F3 have one each: every
    Window partitioned by member alone runs over one of three shuffled inputs."""
    import re
    o = A.orders_a(spark, SF)
    s = EV.samples(o, ADAPTER_A).cache()
    f = FE.assemble_features(s, TL.scan_orders_flagged(o, ADAPTER_A),
                             FE.scan_lines_valid(A.lines_a(spark, SF), ADAPTER_A),
                             FE.scan_members(A.members_a(spark, SF)), ADAPTER_A)
    specs = re.findall(r"Window \[.*?\], \[(member_id#\d+L)\], \[", plan(f))
    assert len(specs) >= 3 and len(set(specs)) <= 3
    s.unpersist()


def test_a_study_runs_nothing_before_it_is_asked(spark):
    from rekindle.config import ADAPTER_A
    from rekindle.plans import pipeline as PL
    from rekindle.sources import adapters as A
    orders = A.orders_a(spark, SF)
    sc = spark.sparkContext
    sc.setJobGroup("study", "building")
    st = PL.parameter_study(orders, ADAPTER_A)
    assert len(st) == 18 and "best_window" in st
    assert list(sc.statusTracker().getJobIdsForGroup("study")) == []
    assert st["k_m_table"].count() > 0 and st["threshold_sweep"].count() > 0
    assert set(st._found) == {"gaps"}  # stored once, and only what was needed
    sc.setJobGroup("rest", "")
    assert all(st[name].columns for name in st)


def _exchanges_above_scan(df, table_column):
    """Exchanges between the scan that reads a column and the plan's first join."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and table_column in x)
    depth = [len(x) - len(x.lstrip(" :+-*(0123456789)")) for x in lines]
    found, level = 0, depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            level = depth[i]
            if "Join" in lines[i]:
                return found
            found += "Exchange" in lines[i]
    raise AssertionError(text)


def test_bucketed_orders_are_looked_up_without_an_exchange(spark):
    from rekindle.session import bucketed, release
    t = catalog.Tables(spark, SF)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        stored = bucketed(t.orders_fl, ["order_code"], "orders_fl")
        assert sorted(map(str, stored.collect())) == sorted(map(str, t.orders_fl.collect()))
        look = FE.t0_order_lookup(t.samples, stored)
        assert _exchanges_above_scan(look, "sales_amount") == 0
        plain = spark.read.parquet(*[f.rsplit("/", 1)[0] for f in stored.inputFiles()[:1]])
        assert _exchanges_above_scan(FE.t0_order_lookup(t.samples, plain), "sales_amount") == 1
        want = FE.t0_order_lookup(t.samples, t.orders_fl).collect()
        assert sorted(look.collect(), key=str) == sorted(want, key=str)
        name = spark.catalog.listTables()[0].name
        release()
        assert not spark.catalog.tableExists(name)
    finally:
        spark.conf.set(key, before)


def test_release_deletes_shared_folders(spark):
    import os
    from rekindle.session import release, shared_folder
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    spark.range(3).write.parquet(a)
    assert a != b and os.path.isdir(a.removeprefix("file:"))
    release()
    assert not os.path.exists(a.removeprefix("file:"))


def test_readers_of_a_cut_table_decode_only_their_columns(spark):
    import datetime as dt
    from rekindle.session import cut_lineage
    rows = [(1, float("nan"), None, dt.datetime(2020, 1, 2, 3), [1, None]), (1, -0.0, "", None, []), (None, None, "a", None, None)]
    df = spark.createDataFrame(rows * 2, "a long, b double, c string, d timestamp_ntz, e array<int>")
    cut = cut_lineage(df)
    assert cut.dtypes == df.dtypes and sorted(map(str, cut.collect())) == sorted(map(str, df.collect()))
    assert "ReadSchema: struct<b:double>" in plan(cut.select("b"))
    assert cut_lineage(df.filter("a = 7")).count() == 0


def test_order_lines_are_exchanged_once(spark, tmp_path):
    """Distinct parts, sums and the join with the orders share one exchange of the lines, by the order code."""
    at = dt.datetime(2000, 1, 1)
    spark.createDataFrame([(1, 7, "F", 10.0, at, "a"), (2, 7, "O", 5.0, at, "b"), (3, None, "P", None, None, None)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(1, 4, 7, 2.0, 10.10, 0.05, "A"), (1, 4, 2, 3.0, 0.20, 0.10, "A"), (1, None, 3, 1.0, 5.0, 0.0, "N"),
             (1, 5, 7, 1.0, 1.0, 0.0, "A"), (1, 5, 7, 1.0, 1.0, 0.0, "A"), (2, None, 1, None, None, None, None),
             (None, 4, 7, 9.0, 9.0, 0.5, "A")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = A.orders_a(spark, str(tmp_path)).select("order_code", "ts_count", "qty", "total_price", "total_discount", "total_coupon_discount")
    assert sorted(map(tuple, df.collect())) == [(1, 2, 8, 17.3, -0.525, -12.1), (2, 0, None, None, None, 0.0),
                                                (3, None, None, None, None, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = A.orders_a(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len([x for x in dealt if "l_orderkey" in x]) == 1 and not [x for x in dealt if "l_partkey" in x]
