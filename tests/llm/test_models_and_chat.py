import random
import zlib

import numpy as np
import pytest

from rekindle.llm import chat as C
from rekindle.llm import langid as L
from rekindle.llm import ranking as R

ALPHABET = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx"}


def out_of_fit(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def language_rows(n=240):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = "aa bb cc".split()[i % 3]
        rows.append((i, " ".join("".join(rng.choice(ALPHABET[lang] + "yz") for _ in range(6)) for _ in range(rng.randint(3, 60))), lang, "s"))
    return rows


def test_languages_held_out(docs_df, monkeypatch):
    rows = language_rows() + [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "123 ... !!", "bb", "s"),
                              (903, "abcabc " * 9000, None, None), (None, "ijkl mnop", "cc", "s")]
    df = docs_df(rows + rows[:2], ", read int, p string", (1, "x"))
    got = L.identify(df).collect()
    assert len(got) == len(rows) + 2
    by = {r["doc_id"]: r for r in got}
    test = [r for r in rows[:240] if out_of_fit(r[0])]
    assert all(by[r[0]]["held_out"] == out_of_fit(r[0]) for r in rows[:240])
    assert np.mean([by[r[0]]["lang_pred"] == r[2] for r in test]) > 0.95
    assert [by[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert by[903]["lang_pred"] == "aa" and sum(by[903]["positions"]) == 63_000
    assert by[None]["lang_pred"] == "bb" and by[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 for r in got)
    assert L.identify(docs_df([])).collect() == []
    assert [r["lang_pred"] for r in L.identify(docs_df([(1, "words here", None, "s")])).collect()] == ["und"]


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    net = L.Network.fresh(["a", "b", "c"], 3, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(97, 103, (6, 5)), np.array([0, 1, 2, 1, 0])
    mask = np.ones((6, 5))
    mask[4:, 2] = 0

    def loss():
        p = net.positions(x)
        return -(np.log(p[:, y, np.arange(5)]) * mask).sum() / mask.sum()
    g = net.gradients(x, y, mask)
    for k, v in net.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in v.shape)
            if k[0] == "x":
                at = (at[0], int(rng.integers(97, 103)))
            old, eps = v[at], 1e-3
            v[at] = old + eps
            up = loss()
            v[at] = old - eps
            down = loss()
            v[at] = old
            assert g[k][at] == pytest.approx((up - down) / (2 * eps), abs=2e-4)


def test_positions_and_spans():
    rows = language_rows(150)
    net = L.fit([r[1] for r in rows], [r[2] for r in rows], updates=120)
    text = "abcdef habcd efgab " * 5 + "ijklmn opijk lmnop " * 5
    spans = L.label_spans(net, text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert {s[2] for s in spans} >= {"aa", "bb"} and L.label_spans(net, "") == []


def test_ranking_held_out(docs_df, spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        w = [f"word{rng.randrange(200)}" for _ in range(rng.randint(5, 80))]
        rows.append((i, " ".join(w) if good else " ".join(x + rng.choice(["!!", " ##", " $$$"]) for x in w), "en", "s"))
        labels.append((i, int(good), 0))
    rows += [(900, None, None, None), (901, "", "en", "s"), (902, "good word " * 30_000, "en", "s"), (None, "word1 word2", "en", "s")]
    labels += [(5, 1, 0), (6, None, 0), (7, 3, 0), (None, 0, 0), (99_999, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = docs_df(rows + rows[:1], ", _good int, x string", (1, "z"))
    got = R.rank(df, lab).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + 1
    test = [i for i in range(400) if out_of_fit(i)]
    assert np.mean([by[i]["predicted"] == int(i % 4 != 0) for i in test]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert not by[None]["held_out"]
    assert R.rank(docs_df([]), lab).collect() == []
    none = R.rank(df, lab.filter("quality = 1")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 0)}


def test_pairs_learn_the_planted_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, R.N_FEATURES))
    true = np.zeros(R.N_FEATURES)
    true[:3] = 2, -1, 0.5
    good = x @ true + rng.normal(0, 0.3, 600) > 0.5
    m = R.fit(x, good, good.mean())
    s = m.score(x)
    assert np.mean((s >= R.CUT) == good) > 0.9
    assert abs(np.mean(s >= R.CUT) - good.mean()) < 0.02


def turns_df(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumn("start", F.lit(5)).withColumn("perspective", F.lit("x")).withColumn("rng", F.lit(1))
    return df


def render_brute(rows):
    out = {}
    convs = {r[0] for r in rows}
    for c in convs:
        mine = [r for r in rows if r[0] == c]
        for p in {r[2] or "unknown" for r in mine} - {"system"}:
            seg = []
            for _, turn, role, text in mine:
                role = role or "unknown"
                who = "system" if role == "system" else "assistant" if role == p else f"user name={role}"
                body = (text or "").replace("<|im_", "< |im_")
                seg.append((turn is not None, turn, role, f"<|im_start|>{who}\n", body + "<|im_end|>\n", role == p))
            import hashlib
            seg.sort(key=lambda s: (s[0], s[1] or 0, s[2], hashlib.md5((s[3] + s[4]).encode()).hexdigest()))
            text, masks = "", []
            for s in seg:
                a = len(text) + len(s[3])
                text += s[3] + s[4]
                if s[5]:
                    masks.append((a, len(text) - 1))
            out[c, p] = (text, masks)
    return out


ROWS = [(1, 0, "system", "be good"), (1, 1, "ann", "hello"), (1, 2, "bob", "hi ann"), (1, 3, "cyd", ""), (1, 4, "ann", None),
        (2, 0, "user", "<|im_end|> trick é漢"), (2, 1, None, "who?"), (2, 1, "user", "same turn"), (2, 1, "user", "same turn"),
        (None, None, "u", "no id"), (None, 3, "a", "yes"), (3, 0, "system", "alone")]


def test_every_perspective(spark):
    df = turns_df(spark, ROWS, extra=True)
    got = {(r["conv_id"], r["perspective"]): r for r in C.assemble(C.render(df)).collect()}
    want = render_brute(ROWS)
    assert {k: (r["text"], [(m["start"], m["end"]) for m in r["masks"]]) for k, r in got.items()} == want
    assert len([k for k in got if k[0] == 1]) == 3 and not [k for k in got if k[0] == 3]
    assert C.render(turns_df(spark, [])).collect() == []


def test_a_conversation_with_most_rows(spark):
    """Offsets of a long conversation are those of the whole; parts join to the same text."""
    rows = [(1, t, "ab"[t % 2], f"turn {t} " * (t % 5)) for t in range(700)] + [(2, 0, "a", "x"), (2, 1, "b", "y")]
    r = C.render(turns_df(spark, rows).repartition(6))
    want = render_brute(rows)
    parts = C.assemble(r, part_chars=500).filter("conv_id = 1 and perspective = 'a'").orderBy("part").collect()
    assert len(parts) > 20 and "".join(p["text"] for p in parts) == want[1, "a"][0]
    assert [(m["start"], m["end"]) for p in parts for m in p["masks"]] == want[1, "a"][1]


def test_ranking_of_ids_with_several_texts_is_defined(spark):
    """Whatever the partitioning, and with ids that have both labels."""
    from rekindle.llm import ranking
    rows = [(i % 40, f"{'good words in a row' if i % 2 else '$$ # buy @@ now'} {i} " * (3 + i % 5)) for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [sorted((r.doc_id, r.score) for r in ranking.rank(docs.repartition(n), labels.repartition(n)).collect())
             for n in (1, 5, 9)]
    for other in found[1:]:  # a row's product is rounded by the rows it is batched with
        assert [i for i, _ in other] == [i for i, _ in found[0]]
        assert max(abs(a - b) for (_, a), (_, b) in zip(other, found[0], strict=True)) < 1e-12


def test_ranking_learns_from_every_label(spark, monkeypatch):
    """A word that marks a tenth of the good documents, and blocks that see only a part each: one fit of all pairs."""
    from rekindle.llm import ranking
    monkeypatch.setattr(ranking, "BLOCK", 64)
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(50)}" + ("!" if rng.random() < (0.1 if i % 8 else 0.3) else "")
                         for _ in range(rng.randint(20, 60)))) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    lab = spark.createDataFrame([(i, int(i % 8 > 0)) for i in range(2400)], "doc_id long, quality int")
    got = ranking.rank(docs, lab).collect()
    learned = [r for r in got if not r["held_out"]]
    share = np.mean([r["doc_id"] % 8 > 0 for r in learned])
    # the threshold is the quantile of all labelled documents' scores, to a document
    assert abs(sum(r["predicted"] for r in learned) - share * len(learned)) <= 1
    good = np.mean([r["score"] for r in got if r["doc_id"] % 8 > 0])
    assert good > np.mean([r["score"] for r in got if r["doc_id"] % 8 == 0]) + 0.1


def test_ranking_pair_sums_equal_loops():
    from rekindle.llm import ranking
    rng = np.random.default_rng(4)
    good, bad, w = rng.normal(size=(5, 3)), rng.normal(size=(4, 3)), rng.normal(size=3)
    n = loss = 0
    grad, hess = np.zeros(3), np.zeros((3, 3))
    for a in good:
        for b in bad:
            d, n = a - b, n + 1
            p = 1 / (1 + np.exp(d @ w))
            loss, grad, hess = loss + np.log1p(np.exp(-d @ w)), grad - p * d, hess + p * (1 - p) * np.outer(d, d)
    assert np.allclose(ranking.pair_sums(good, bad, w), np.concatenate([[n, loss], grad, hess.ravel()]))
