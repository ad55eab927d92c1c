"""Quality rules and line chunks against the direct way of computing them."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rekindle.llm import line_chunks as LC
from rekindle.llm import quality as Q
from rekindle.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, " ", "\n\n", "one", "a b\nc d\n\na b\n", "x " * 40, "é漢😀 ## | <b> 100%\r\nlast line no newline",
         "the cat sat on the mat by the door " * 3 + "and then left", "\tq w e r t y u i o p\n" * 5, "word",
         "a" * 30_000, "lorem ipsum dolor sit amet " * 2000, "a\x0bb\x0cc\xa0d", "\n lead\ntrail \n"]


def counts(t):
    t = t or ""
    w = WORD.findall(t)
    win = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = [False] * len(w)
    for i in range(len(w) - 7):
        if win[tuple(w[i:i + 8])] > 1:
            cover[i:i + 8] = [True] * 8
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(cover),
            len(lines), sum(a == b for a, b in zip(w, w[1:], strict=False)))


def test_counts_equal_the_loop():
    got = Q.measures.func(pa.array(TEXTS, pa.string())).to_pylist()
    assert [tuple(g[c] for c in Q.COUNTS) for g in got] == [counts(t) for t in TEXTS]


def test_words_over_part_bounds(monkeypatch):
    monkeypatch.setattr(W, "_BLOCK", 64)
    parts = list(W.parts(pa.array(TEXTS, pa.string()), 50))
    assert len(parts) > 4
    got = [c for p in parts for c in np.diff(p.woffs).tolist()]
    assert got == [counts(t)[0] for t in TEXTS]
    text = " ".join(f"w{i % 90}" for i in range(3000))
    p = next(W.parts(pa.array([text])))
    h = p.hashes()
    assert len(set(h.tolist())) == 90 and (h[:90] == h[90:180]).all()


def test_verdicts_follow_the_group(docs_df):
    """A measure usual in one source is an outlier in another; junk goes, the rest stays."""
    words = [f"wo{'abcdefghij'[i % 10]}rd{i}" for i in range(400)]
    rows = []
    for i in range(120):
        plain = " ".join(words[(i * 7 + j) % 400] for j in range(40))
        coded = " | ".join(words[(i * 11 + j) % 400] for j in range(40))
        rows += [(i, plain, "en", "prose"), (1000 + i, coded, "en", "tables")]
    rows += [(5000, " | ".join(words[:40]), "en", "prose"), (5001, "x y " * 30, "en", "prose"), (5002, "few words", "en", "prose"),
             (5003, None, None, None), (5004, "", "en", None), (None, " ".join(words[:50]), None, "prose")]
    df = docs_df(rows + rows[:1], ", _quality string, rule int, n long", ("z", 1, 2))
    got = {(r["doc_id"]): r for r in Q.judge(df, keep_columns=["doc_id"]).collect()}
    assert all(got[i]["_quality"]["kept"] for i in range(120))
    assert all(got[1000 + i]["_quality"]["kept"] for i in range(120))
    assert not any(got[i]["_quality"]["kept"] for i in (5000, 5001, 5002, 5003, 5004))
    assert got[5000]["_quality"]["base_failed"] is False and got[5001]["_quality"]["base_failed"] is True
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 240 + 1 + got[None]["_quality"]["kept"]
    assert Q.keep_good(docs_df([])).collect() == []


def test_sketches_merge(spark):
    """Sketch of all equals the sum of the sketches of parts, and quartiles are within the accuracy."""
    rng = np.random.default_rng(1)
    v = np.exp(rng.normal(0, 1.5, 4000))
    df = spark.createDataFrame([(float(x), int(k % 3)) for k, x in enumerate(v)], "v double, part int")
    s = df.select("part", F.lit(0).alias("rule"), Q.bucket_of(F.col("v")).alias("bucket")).groupBy("part", "rule", "bucket") \
        .agg(F.count("*").alias("n"))
    one = Q.quartiles(Q.merged(s, []), []).first()
    assert one["n_docs"] == 4000
    for q, name in ((0.25, "q25"), (0.75, "q75")):
        exact = np.sort(v)[int(q * 3999)]
        assert abs(one[name] - exact) <= 1.01 * Q.ACCURACY * exact


def chunk_brute(t, divisor=2):
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in t.split("\n")]
    out, now = [], []
    for i, line in enumerate(t.split("\n")):
        now.append(line)
        if ((h[i - 1] if i else 0) * 31 + h[i]) % divisor == 0:
            out.append(now)
            now = []
    return out + ([now] if now else [])


def dedup_brute(rows):
    seen, out = {}, {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        kept = []
        for c in chunk_brute(t):
            body = "\n".join(c)
            if len(c) >= 2 and WORD.search(body) and body in seen:
                continue
            if len(c) >= 2:
                seen.setdefault(body, i)
            kept.append(body)
        out[i] = "\n".join(kept)
    return out


def test_chunks_are_removed_but_for_the_first(docs_df):
    passage = "\n".join(f"shared line {i} of the passage" for i in range(12))
    rows = [(i, f"head {i}\nmore {i}\n" + (passage if i % 3 else "own text") + f"\ntail {i}", "en", "s") for i in range(60)]
    rows += [(100, passage, "en", "s"), (101, passage, "en", "s"), (102, "", "en", "s"), (103, "\n\n\n\n\n\n", "en", "s"),
             (104, "\n\n\n\n\n\n", "en", "s"), (105, None, "en", "s"), (106, "single", "en", "s"), (107, "single", None, None)]
    df = docs_df(rows, ", h long, k int, first string", (1, 2, "x"))
    out = LC.dedup(df)
    assert out.columns == [*df.columns, "_chunks_removed", "_lines_removed"]
    got = {r["doc_id"]: r for r in out.collect()}
    want = dedup_brute(rows)
    assert {i: r["text"] or "" for i, r in got.items()} == want
    assert got[105]["text"] is None and got[103]["text"] == rows[63][1]
    assert sum(r["_chunks_removed"] > 0 for r in got.values()) >= 40
    kept = LC.drop_repeated_chunks(df)
    assert kept.columns == df.columns
    left = {r["doc_id"]: r for r in kept.collect()}
    assert {i for i in got if i not in left} == {i for i in got if got[i]["_chunks_removed"] and not WORD.search(want[i])}
    assert all(r["n_chars"] == len(r["text"]) for r in left.values() if r["text"] is not None)
    assert LC.dedup(docs_df([])).collect() == []


def test_boundaries_move_with_the_lines(spark):
    """An inserted line changes chunks next to it only."""
    lines = [f"line number {i * i}" for i in range(200)]
    a, b = "\n".join(lines), "\n".join([*lines[:50], "something new", *lines[50:]])
    df = spark.createDataFrame([(a,), (b,)], "t string")
    x, y = ({c["body"] for c in r[0]} for r in df.select(LC.chunks(F.col("t"))).collect())
    assert len(x - y) <= 2 and len(x) > 60


def test_same_hash_but_other_bytes_stays(docs_df, monkeypatch):
    """Chunks that share a hash are kept when their bytes differ."""
    monkeypatch.setattr(LC, "body_hash", lambda body: F.lit(7).cast("bigint"))
    rows = [(i, f"alpha {i}\nbeta {i}\ngamma {i}\ndelta {i}", "en", "s") for i in range(6)]
    got = {r["doc_id"]: r["text"] for r in LC.dedup(docs_df(rows)).collect()}
    assert got == {r[0]: r[1] for r in rows}


def whole_brute(rows):
    """Chunks by local minima; matches go on over equal lines of the neighbouring chunks."""
    def cut(t):
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        ends = [i for i in range(2, len(h) - 1) if h[i - 1] > h[i] <= h[i + 1]] + [len(h)]
        return [lines[a:b] for a, b in zip([0, *ends], ends)]

    def common(x, y):
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return n
    seen, out = {}, {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows}):
        c = cut(t)
        gone, start = set(), 0
        for k, b in enumerate(c):
            if len(b) >= 2 and WORD.search("\n".join(b)):
                if tuple(b) in seen:
                    f, j = seen[tuple(b)]
                    before = common(c[k - 1][::-1], f[j - 1][::-1]) if k and j else 0
                    after = common(c[k + 1], f[j + 1]) if k + 1 < len(c) and j + 1 < len(f) else 0
                    gone |= set(range(start - before, start + len(b) + after))
                else:
                    seen[tuple(b)] = (c, k)
            start += len(b)
        out[i] = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
    return out


def test_whole_copies_and_passages_go(docs_df):
    """With ``whole``, copies of texts with several lines leave no scrap and a passage goes to its last whole line."""
    texts = ["\n".join(f"text {i} line {j}" for j in range(2 + i % 7)) for i in range(40)]
    passage = [f"shared line {i} of the passage" for i in range(14)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(100 + i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(200 + i, "\n".join([f"head {i}", f"more {i}", *passage, f"tail {i}", f"end {i}"]), "en", "s") for i in range(20)]
    rows += [(300, "", "en", "s"), (301, None, "en", "s"), (302, "single", "en", "s"), (303, "single", "en", "s"),
             (304, "\n\n\n\n", "en", "s"), (305, "\n\n\n\n", "en", "s"), (306, "\n".join(passage * 3), "en", "s")]
    got = {r["doc_id"]: r for r in LC.dedup(docs_df(rows), whole=True).collect()}
    assert {i: r["text"] or "" for i, r in got.items()} == whole_brute(rows)
    assert all(got[i]["text"] == texts[i] and got[100 + i]["text"] == "" for i in range(40))
    assert all(got[200 + i]["text"] == f"head {i}\nmore {i}\ntail {i}\nend {i}" for i in range(1, 20))
    left = {r["doc_id"] for r in LC.drop_repeated_chunks(docs_df(rows), whole=True).collect()}
    assert not left & set(range(100, 140)) and left >= set(range(40))


def test_columns_named_like_the_marks_stay(docs_df):
    text = "\n".join(" ".join(f"word{7 * k + j}" for j in range(7)) for k in range(6))
    rows = [(k, text, "en", "s") for k in range(3)]
    df = docs_df(rows, ", _quality string, _lines_removed string, _chunks_removed int", ("mine", "mine", 7))
    from rekindle.llm import line_chunks, quality
    for out in (quality.keep_good(df), line_chunks.drop_repeated_chunks(df), line_chunks.drop_repeated_chunks(df, whole=True)):
        assert out.columns == df.columns
        got = out.collect()
        assert got and all((r["_quality"], r["_lines_removed"], r["_chunks_removed"]) == ("mine", "mine", 7) for r in got)
