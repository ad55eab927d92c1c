"""The chain of stages on a small folder, each stage against brute force on its own input."""
import collections
import os
import random

import pytest
from test_mix_and_shards import targets_brute
from test_ngram_join import brute
from test_rules_and_lines import WORD, counts, dedup_brute

import corpus_pipeline as CP
from rekindle.llm import pieces as P
from rekindle.llm import queries as Q

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(11)
    vocab = [f"wo{a}rd{b}" for a in "abcdefgh" for b in range(60)]
    passage = "\n".join(" ".join(rng.choice(vocab) for _ in range(9)) for _ in range(10))
    rows = []
    for i in range(160):
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.randint(4, 12))) for _ in range(rng.randint(3, 9))]
        if i % 9 == 0:
            lines[1:1] = passage.split("\n")
        text = "\n".join(lines)
        if i % 8 == 1:  # a near copy of the document before
            w = rows[-1][1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        if i % 20 == 5:
            text = rows[-1][1]  # an exact copy
        if i % 16 == 3:
            text = " ".join(x + "###" for x in text.split())
        if i % 25 == 4:
            text = "short text"
        rows.append((i, text, "en" if i % 3 else None, ["a", "b", None][i % 3]))
    return rows + [(900, None, "en", "a"), (901, "", None, "b"), (902, " ".join(vocab[i % 480] for i in range(0, 90_000, 7)), "en", "a")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in corpus()],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{d}/documents.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in CP.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "encode_pieces"]
    before = docs.collect()
    for k, (name, stage) in enumerate(CP.STAGES):
        out = stage(spark, docs, folder)
        path = os.path.join(folder, f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if k < 4:
            assert docs.columns == COLUMNS
        if name == "quality_rules":
            kept = {r["doc_id"] for r in after}
            assert not kept & {900, 901} and not [r for r in after if "###" in r["text"]]
            assert kept >= {r["doc_id"] for r in before if r["text"] and "###" not in r["text"] and counts(r["text"])[0] >= 20
                            and counts(r["text"])[4] * 100 <= 30 * counts(r["text"])[0]}
        if name == "line_dedup":
            want = dedup_brute([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, t in want.items() if WORD.search(t)}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "near_duplicates":
            heads = {c for d, _, c in brute([(r["doc_id"], r["text"]) for r in before], 5, 8, 10) if c == d}
            assert {r["doc_id"] for r in after} == heads and len(after) < len(before)
        if name == "mix_sources":
            sizes, taken = collections.Counter(), collections.Counter()
            for r in before:
                sizes[r["source"]] += len(WORD.findall(r["text"]))
            for r in after:
                taken[r["source"]] += len(WORD.findall(r["text"]))
            want = targets_brute(sizes)
            assert all(abs(taken[s] - want[s]) <= max(len(WORD.findall(r["text"])) for r in before if r["source"] == s)
                       for s in sizes)
            assert max(collections.Counter(r["doc_id"] for r in after).values()) <= 2
        if name == "encode_pieces" and os.path.exists(P.MODEL):
            text = {r["doc_id"]: r["text"] for r in before}
            back = docs.select("doc_id", P.decoder()("ids").alias("t")).collect()
            assert len(back) >= 2 * len(before) - 2 and all(r["t"] == text[r["doc_id"]] for r in back)
        before = after


def test_run_equals_the_stages(spark, folder):
    a = CP.run(spark, folder).select("doc_id", "sample", "log_prob").collect()
    b = CP.run(spark, folder).select("doc_id", "sample", "log_prob").collect()
    assert sorted(a) == sorted(b) and a


def test_registered():
    import __spark_entry__ as E
    names = E.queries()
    for n in range(1, 11):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(Q.oracle_sql()) <= set(Q.queries())
