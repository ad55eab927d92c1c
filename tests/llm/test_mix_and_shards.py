import collections
import zlib

from pyspark.sql import functions as F

from rekindle.llm import mixing as M
from rekindle.llm import sharding as S


def rows_of(n=600):
    """A third of all rows in one source, a NULL source, empty and NULL texts, a very long text, repeated rows."""
    rows = []
    for i in range(n):
        src = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"s{i % 7}"
        rows.append((i, None if i % 50 == 7 else "" if i % 50 == 8 else f"w{i} " * (i % 23), "en", src))
    return rows + [(n, "long " * 20_000, "en", "s1"), rows[5], rows[5], (None, "no id " * 5, "en", "hot")]


def targets_brute(sizes):
    """Water filling in rounds."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, t = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not over:
            return t | {s: level * w[s] for s in open_}
        for s in over:
            t[s] = 2.0 * sizes[s]
            left -= t[s]
        open_ -= over
    return t


def test_targets_and_takes(docs_df):
    rows = rows_of()
    df = docs_df(rows, ", key string, w int, target int", ("k", 1, 2))
    out = M.mix(df)
    got = out.collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in rows}
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        src = by_id[r["doc_id"]][3]
        assert r["size"] == len((by_id[r["doc_id"]][1] or "").split())
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] in (0, 1, 2)
        sizes[src] += r["size"]
        taken[src] += r["taken"]
        target[src] = r["target"]
    want = targets_brute(sizes)
    largest = collections.defaultdict(int)
    for r in got:
        largest[by_id[r["doc_id"]][3]] = max(largest[by_id[r["doc_id"]][3]], r["size"])
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * (1 + want[s])
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, M.mix(df.repartition(7)).collect()))


def test_better_documents_first(docs_df):
    """Keys scaled by quality weight: weight 4 is taken far more often than weight 0.25."""
    rows = [(i, "one two three", "en", "a" if i < 400 else "b") for i in range(1200)]
    w = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(0.25)
    got = M.mix(docs_df(rows), quality_weight=w, cycle=(1, 2), budget_share=0.2).filter("source_size > 0").collect()
    part = [r for r in got if 0 < r["target"] / r["source_size"] < 1]
    good = sum(r["copies"] for r in part if r["doc_id"] % 2 == 0)
    assert part and good > 0.6 * sum(r["copies"] for r in part)


def test_repeat_documents(docs_df):
    df = docs_df(rows_of(300), ", _copies long", (9,))
    n = collections.Counter()
    for r in M.mix(df).collect():
        n[r["doc_id"]] += r["copies"]
    out = M.repeat_documents(df)
    assert out.columns == df.columns
    assert collections.Counter(r["doc_id"] for r in out.collect()) == +n
    assert M.repeat_documents(docs_df([])).collect() == [] and M.mix(docs_df([])).collect() == []
    assert [r["taken"] for r in M.mix(docs_df([(1, None, None, None), (2, "", "en", "x")])).collect()] == [0, 0]


def test_shards_match_the_mixture(docs_df):
    rows = rows_of()
    got = S.interleave(docs_df(rows, ", shard string, r int, stretch int", ("x", 1, 2))).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) == set(range(8))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    share = collections.Counter(r["source"] for r in got)
    for shard in by.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
        here = collections.Counter(r["source"] for r in shard)
        assert all(abs(here[s] - n / 8) <= 2 for s, n in share.items())
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["size"] == len(text[r["doc_id"]].encode()) + 1
    again = S.interleave(docs_df(rows).repartition(9)).collect()
    key = lambda x: sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in x)
    assert key(got) == key(again)


def test_few_rows_and_many_sources(docs_df):
    assert S.interleave(docs_df([])).collect() == []
    assert sorted(r["shard"] for r in S.interleave(docs_df([(i, "t", "en", "s") for i in range(3)])).collect()) == [0, 2, 5]
    many = S.interleave(docs_df([(i, "t", "en", f"src{i}") for i in range(400)])).collect()
    assert len({r["frac_rank"] for r in many}) == 400


def test_rows_that_differ_by_null_only_are_kept(docs_df):
    """NULL against a value in another column, and the same id: documents of their own."""
    rows = [(None, "alpha beta gamma", "en", None), (None, "alpha beta gamma", None, "en"),
            (7, "one two three", "en", None), (7, "one two three", None, "en")]
    out = M.repeat_documents(docs_df(rows), max_epochs=2, budget_share=2.0)
    got = collections.Counter(tuple(r)[:4] for r in out.collect())
    assert got == {r: 2 for r in rows}


def test_spread_join_meets_heavy_and_null_keys(spark):
    from rekindle.llm.common import identity, spread_join
    rows = spark.createDataFrame([(None if i % 5 == 0 else 1 if i % 5 < 4 else i, i) for i in range(3000)], "k long, v long")
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("m"))
    per_key = per_key.filter("k is null or k <> 4")
    got = {(r.k, r.v): r.m for r in spread_join(rows, per_key, ["k"], "n").collect()}
    least = {}
    for k, v in got:
        least[k] = min(least.get(k, v), v)
    assert len(got) == 3000 and got == {(k, v): None if k == 4 else least[k] for k, v in got}
    a = spark.createDataFrame([(None, "x"), ("x", None), ("", "x"), ("x", "")], "a string, b string")
    assert a.select(identity(F.col("a"), F.col("b")).alias("i")).distinct().count() == 4
