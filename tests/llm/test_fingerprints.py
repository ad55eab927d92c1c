import hashlib
import random

from pyspark.sql import functions as F

from rekindle.llm import fingerprints as FP

WORDS = "alpha bèta gamma δέλτα epsilon zeta 漢字 theta iota kappa".split()


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def rows_of():
    rng = random.Random(1)
    rows = [(i * 7, text_of(rng, n), "en", "s") for i, n in enumerate([200, 1, 0, 3, 40, 2, 700, 12, 5])]
    rows += [(5, None, None, None), (8, "", "en", "s"), (9, "abc", "en", None), (10, "a" * 5000, "en", "s")]
    rows += [(700, rows[0][1], "de", "t"), (701, rows[0][1], "de", "t"), (None, "no id here, none at all", "en", "s")]
    return rows


def edited_brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in order]
    out = {}
    for k, t in enumerate(texts):
        m = len(t) // 4
        out[order[k][0]] = (t[:len(t) - m] + texts[(k + 1) % len(texts)][:m], len(t))
    return out


def test_edited_texts_and_lengths(docs_df):
    rows = rows_of()
    want = edited_brute(rows)
    got = {r["doc_id"]: r for r in FP.edited_fingerprints(docs_df(rows, ", id long, rng string", (1, "x"))).collect()}
    assert len(got) == len(rows)
    for i, (text, n) in want.items():
        assert got[i]["n_chars"] == n
        assert got[i]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_spliced_equals_direct_and_equal_texts_agree(spark, docs_df):
    rows = rows_of()
    texts = edited_brute(rows)
    direct = FP.fingerprint(spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string"))
    direct = {r["doc_id"]: r["fingerprint"] for r in direct.collect()}
    got = {r["doc_id"]: r for r in FP.edited_fingerprints(docs_df(rows)).collect()}
    assert {i: r["edited_fingerprint"] for i, r in got.items()} == direct
    assert got[700]["fingerprint"] == got[701]["fingerprint"] == got[0]["fingerprint"] != ""
    assert got[700]["near_next"] == 1.0 and got[8]["fingerprint"] == got[5]["fingerprint"] == ""
    assert got[0]["near_edited"] > 0.5 > got[0]["near_next"]


def test_anchors_are_closed_syncmers(spark):
    """Against a loop over all k-mers; the engine supplies the s-mers' hashes."""
    text = text_of(random.Random(3), 60)
    data = text.encode()
    df = spark.createDataFrame([(text,)], "text string")
    pos = [a & 0xFFFFFFFF for a in df.select(FP.anchors(FP.text_bytes(F.col("text")))).first()[0]]
    inner = spark.createDataFrame([(i, bytearray(data[i:i + FP.S])) for i in range(len(data) - FP.S + 1)], "i int, b binary")
    h = dict(inner.select("i", F.xxhash64("b")).collect())
    want = [p for p in range(len(data) - FP.K + 1)
            if min(h[p + j] for j in range(FP.INNER)) in (h[p], h[p + FP.INNER - 1])]
    assert pos == want


def test_blocks_of_a_long_text(spark, monkeypatch):
    text = text_of(random.Random(8), 400)
    df = spark.createDataFrame([(text,)], "text string")
    whole = df.select(FP.anchors(FP.text_bytes(F.col("text")))).first()[0]
    monkeypatch.setattr(FP, "BLOCK", 37)
    assert df.select(FP.anchors(FP.text_bytes(F.col("text")))).first()[0] == whole
    assert len(whole) > 400


def test_context_free_shift(spark):
    rng = random.Random(4)
    a = text_of(rng, 80)
    df = spark.createDataFrame([(a,), ("moved by this " + a,)], "text string")
    x, y = (set(r[0]) for r in df.select(FP.anchors(FP.text_bytes(F.col("text")))).collect())
    assert {v + len(b"moved by this ") for v in x} <= y


def test_render_parse_round_trip(spark):
    df = spark.createDataFrame([(text_of(random.Random(5), 90),), ("",), (None,)], "text string")
    sk = FP.sketch(FP.anchors(FP.text_bytes(F.col("text"))))
    for a, b in df.select(sk, FP.parse(FP.render(sk))).collect():
        assert a == b


def test_empty_table(docs_df):
    assert FP.edited_fingerprints(docs_df([])).collect() == []
    assert FP.edited_fingerprints(docs_df([(1, "only one document, its own next", "en", "s")])).count() == 1


def test_range_numbers(spark):
    df = spark.range(0, 50).select(FP._range_of(F.col("id"), [3, 10, 11, 40]).alias("r"), "id")
    for r, i in df.collect():
        assert r == sum(b <= i for b in [3, 10, 11, 40])


def test_in_place_counts_the_most_frequent_offset(spark):
    """Bytes put in at the start move all anchors alike; unrelated texts and empty ones have none in common."""
    text = " ".join(f"word{i * i}" for i in range(400))
    rows = [(text, "#" + text), (text, text), (text, "of other words " * 30), ("", text), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = (FP.sketch(FP.anchors(F.col(x).cast("binary"))) for x in "ab")
    got = [tuple(r) for r in df.select(FP.in_place(a, b), F.size(F.array_intersect(FP.hashes(a), FP.hashes(b)))).collect()]
    assert got[0][0] == got[0][1] >= 60 and got[1] == (64, 64)
    assert [g[0] for g in got[2:]] == [0, 0, 0]


def test_equal_hashes_at_both_ends(spark):
    """Texts of period INNER - 1 and 1: the first and the last of the inner hashes are equal."""
    texts = ["abcdefg" * 9, "a" * 40, "abcdefg" * 2 + "xyz" * 5 + "abcdefg" * 3, "ab" * 20]
    smers = sorted({t[i:i + FP.S] for t in texts for i in range(len(t) - FP.S + 1)})
    h = dict(spark.createDataFrame([(x,) for x in smers], "s string").select("s", F.xxhash64(F.col("s").cast("binary"))).collect())
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for t, found in df.select("text", FP.anchors(FP.text_bytes(F.col("text")))).collect():
        inner = [h[t[i:i + FP.S]] for i in range(len(t) - FP.S + 1)]
        assert [a & 0xFFFFFFFF for a in found] == [
            p for p in range(len(t) - FP.K + 1)
            if min(inner[p:p + FP.INNER]) in (inner[p], inner[p + FP.INNER - 1])]


def spliced(df):
    col = lambda c: F.col(c).cast("binary")
    return df.select(FP.spliced_sketch(F.col("own"), col("text"), F.col("cut"), F.col("next_own"), col("tail")).alias("got"),
                     FP.sketch(FP.anchors(F.concat(F.substring(col("text"), F.lit(1), F.col("cut")), col("tail")))).alias("want"))


def test_spliced_sketch_equals_direct_at_every_cut(spark):
    rng = random.Random(9)
    long, other = (text_of(rng, 60).encode().decode("ascii", "ignore") for _ in "ab")
    pairs = [(long, other), (long, "x" * 300), ("x" * 300, "x" * 200), ("abcdefg" * 30, "efgabcd" * 30), ("short", other), ("", "abc")]
    rows = [(a, b, min(cut, len(a)), b[:end]) for a, b in pairs for cut in (0, 1, 5, 11, 12, 13, 40, 200) for end in (0, 1, 7, 11, 12, 30, 150)]
    df = spark.createDataFrame(rows, "text string, next string, cut int, tail string")
    for c, name in (("text", "own"), ("next", "next_own")):
        df = df.withColumn(name, FP.first_anchors(FP.anchors(F.col(c).cast("binary"))))
    for got, want in spliced(df).collect():
        assert got == want


def test_only_bytes_across_the_cut_are_read_again(spark):
    """Both parts' anchors are taken as given; with none given, what is left lies across the cut."""
    text, tail = text_of(random.Random(11), 300)[:4000], "tail " * 400
    rows = [(text, len(text.encode()), tail, [(7 << 32) + 3], [(5 << 32) + 20]), (text, len(text.encode()), tail, [], [])]
    df = spark.createDataFrame(rows, "text string, cut int, tail string, own array<bigint>, next_own array<bigint>")
    given, none = (r["got"] for r in spliced(df).collect())
    cut = rows[0][1]
    assert set(given) - set(none) == {(7 << 32) + 3, (5 << 32) + 20 + cut}
    assert 0 <= len(none) < FP.K and all(cut - FP.K < (a & 0xFFFFFFFF) < cut for a in none)
