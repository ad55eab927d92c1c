import itertools
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rekindle.llm import pieces as P
from rekindle.llm import words as W

pytestmark = pytest.mark.skipif(not os.path.exists(P.MODEL), reason="no vocabulary file here")
TEXTS = ["Hello  world\nfoo\tbar é漢😀  x", "", None, " lead and trail ", "▁mark ▁▁ in text", "a\n\n\nb\n", "  ", "\n",
         "x" * 3000, "é漢" * 9000 + " end", "y" * 20_000, "thition onble " * 400, "\x00\x01 control", "ＡＢ ﬁ Å"]


def paths_of(text):
    """All segmentations of a short text with their probabilities, by recursion over the vocabulary."""
    v = P.vocabulary(P.MODEL, 1.0)
    table = {v.data[v.offs[i]:v.offs[i + 1]].tobytes(): i for i in range(len(v.logw))
             if v.offs[i + 1] > v.offs[i] and not v.is_byte[i]}
    data = b" " + text.encode()

    def rest(at):
        if at == len(data):
            return [()]
        out = []
        for end in range(at + 1, len(data) + 1):
            if data[at:end] in table:
                out += [(table[data[at:end]], *r) for r in rest(end)]
        return out
    found = rest(0)
    w = np.exp([sum(v.logw[list(p)]) for p in found])
    return dict(zip(found, w / w.sum(), strict=True))


def samples(text, n, k):
    v = P.vocabulary(P.MODEL, 1.0)
    out = []
    one = np.frombuffer(text.encode(), np.uint8)
    buf, offs = P.marked(np.tile(one, n), np.arange(n + 1) * len(one))
    for row in P.sample_part(buf, offs, W.mix64(np.arange(n, dtype=np.uint64)), k, v):
        out.append([(tuple(a.tolist()), lp, li) for a, lp, li in row])
    return out


def test_order_of_draws_is_sampling_without_replacement():
    text, n = "ab to", 30_000
    p = paths_of(text)
    got = samples(text, n, 3)
    assert all(len({s[0] for s in row}) == 3 for row in got)
    for row in got[:50]:
        for ids, lp, _ in row:
            assert np.isclose(lp, np.log(p[ids]))
    pairs = Counter((row[0][0], row[1][0]) for row in got)
    worst = 0
    for a, b in itertools.permutations(p, 2):
        want = p[a] * p[b] / (1 - p[a])
        if want > 1e-3:
            worst = max(worst, abs(pairs[a, b] / n - want) / np.sqrt(want / n))
    assert worst < 4.5
    third = Counter(row[2][0] for row in got)
    for c in p:
        want = sum(p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b])
                   for a, b in itertools.permutations([x for x in p if x != c], 2))
        if want > 1e-3:
            assert abs(third[c] / n - want) < 5 * np.sqrt(want / n)


def test_inclusion_scores_weigh_to_one():
    """Horvitz-Thompson: the mean of the sums of p / inclusion is 1."""
    total = [sum(np.exp(lp - li) for _, lp, li in row) for row in samples("ab to", 20_000, 3)]
    assert abs(np.mean(total) - 1) < 5 * np.std(total) / np.sqrt(len(total))


def test_all_paths_when_k_is_large():
    p = paths_of("to")
    for row in samples("to", 20, len(p) + 5):
        assert {s[0] for s in row} == set(p)
        assert np.isclose(sum(np.exp(s[1]) for s in row), 1)


def test_round_trip_distinct_and_repeatable(docs_df):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(None, "no id", None, None), (3, TEXTS[3], "en", "s")]
    df = docs_df(rows, ", sample long, ids string, key long", (1, "x", 2))
    run = lambda: (P.encode(df, k=3).withColumn("back", P.decoder()(F.col("ids")))
                   .orderBy("doc_id", "sample", "log_prob").collect())
    got = run()
    assert got == run()
    text = dict((r[0], r[1] or "") for r in rows)
    for r in got:
        assert r["back"] == text[r["doc_id"]]
    by = Counter((r["doc_id"], tuple(r["ids"])) for r in got)
    assert all(n == (2 if i == 3 else 1) for (i, _), n in by.items())
    assert [r for r in got if r["doc_id"] == 1][0]["ids"] == [] and len([r for r in got if r["doc_id"] == 1]) == 1
    assert len([r for r in got if r["doc_id"] == 11]) == 3


def test_empty_table(docs_df):
    assert P.encode(docs_df([])).collect() == []
