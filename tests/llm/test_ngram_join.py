import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rekindle.llm import ngram_join as J
from rekindle.llm import words as W
from rekindle.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {65 + i: 97 + i for i in range(26)}


def grams(t, width):
    w = WORD.findall((t or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, num, den):
    sets = [grams(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and den * i >= num * (len(sets[a]) + len(sets[b]) - i):
                root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted((r[0], len(sets[k]), least[find(k)]) for k, r in enumerate(rows))


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(25)]
    rows, i = [], 1000
    for base in range(25):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 9, 10, 11, 12, 20, 40, 150, 400]))]
        if base % 4 == 0:
            words[3:3] = passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, len(w) // 20])):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], [rng.choice(vocab)], [w[k], rng.choice(vocab)]]) or [w[k]]
            i -= 1
            rows.append((i, " ".join(w), "en", "s"))
    # sizes around the bound: 9 and 10 n-grams with 9 in common, and a chain of small steps
    chain = [f"c{j}" for j in range(60)]
    for j in range(12):
        rows.append((2000 - j, " ".join(chain[j:j + 45]), "en", "s"))
    rows += [(3000, " ".join(chain[:11]), "en", "s"), (3001, " ".join(chain[:12]), "en", "s"),
             (3002, " ".join(chain[:12]).upper(), "en", "s"), (3003, "Two Words", "en", "s"), (3004, "two\twords", "en", "s"),
             (3005, "", "en", "s"), (3006, None, None, None), (3007, " \n", "en", "s"), (3008, "two", "en", "s"),
             (3009, "x " * 20_000, "en", "s"), (3010, "x " * 30_000, "en", "s")]
    return rows


@pytest.mark.parametrize(("width", "t"), [(3, 0.9), (5, 0.8)])
def test_components_equal_all_pairs(docs_df, width, t):
    rows = corpus()
    num = round(t * 10)
    df = docs_df(rows + rows[:2], ", digest long, family int, k string, n long", (1, 2, "z", 3))
    got = J.join_components(df, width=width, threshold=t).collect()
    want = brute(rows + rows[:2], width, num, 10)
    assert sorted(map(tuple, got)) == want
    assert len({w[2] for w in want}) < len(want) - 20


def test_large_family_in_blocks(docs_df, monkeypatch):
    """A family over several row blocks, found by dense columns, against all pairs."""
    monkeypatch.setattr(J, "ROWS", 16)
    monkeypatch.setattr(J, "HOT", 4)
    monkeypatch.setattr(J, "SAMPLE", 2)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(words)
        for _ in range(i % 7):
            w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(w), "en", "s"))
    got = J.join_components(docs_df(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 9, 10)


def test_forest_over_column_stretches(monkeypatch):
    monkeypatch.setattr(J, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    base = rng.choice(10_000, 60, replace=False).astype(np.int64)
    sets = [np.unique(np.append(rng.choice(base, 60 - k % 9, replace=False), rng.choice(10_000, k % 4))) for k in range(30)]
    n = np.arange(30)
    root = J.forest(sets, n, n, 800, 1000)
    for a in range(30):
        for b in range(30):
            i = len(np.intersect1d(sets[a], sets[b]))
            if 10 * i >= 8 * (len(sets[a]) + len(sets[b]) - i):
                assert root[a] == root[b]


def test_common_passages_make_no_family(docs_df, monkeypatch):
    """Texts of the same few passages share crowded columns only; a family has those with much the same text."""
    monkeypatch.setattr(J, "HOT", 4)
    monkeypatch.setattr(J, "SAMPLE", 2)
    largest = {}

    def spied(edges, name):
        found = components(edges, name)
        largest[name] = max((r["count"] + 1 for r in found.groupBy("root").count().collect()), default=0)
        return found
    monkeypatch.setattr(J, "components", spied)
    rng = random.Random(8)
    pool = [" ".join(f"p{k}_{j}" for j in range(20)) for k in range(30)]
    rows = [(i, " ".join(rng.sample(pool, 5)), "en", "s") for i in range(120)]
    rows += [(1000 + i, rows[i][1] + " more", "en", "s") for i in range(0, 120, 10)]
    got = J.join_components(docs_df(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 9, 10)
    assert largest["gram-links"] == 2
    assert largest["gram-families"] <= 20


def test_rows_of_a_large_family_are_exchanged_a_few_times(docs_df, monkeypatch):
    monkeypatch.setattr(J, "ROWS", 8)
    seen = {}

    def echo(t_num, t_den):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(6), b.column(6)], ["u", "v"])
        return run

    def spied(edges, name):
        seen[name] = edges.count()
        return components(edges, name)
    monkeypatch.setattr(J, "block_links", echo)
    monkeypatch.setattr(J, "components", spied)
    rows = [(i, " ".join(f"e{i}" if j == 200 else f"w{j}" for j in range(400)), "en", "s") for i in range(300)]
    J.join_components(docs_df(rows)).collect()
    assert 300 <= seen["gram-links"] <= 10 * 300


def test_tiles_give_the_components_of_all_pairs(monkeypatch):
    rng = np.random.default_rng(4)
    base = [rng.choice(10_000, 60, replace=False).astype(np.int64) for _ in range(3)]
    sets = [np.unique(np.append(rng.choice(base[k % 3], 60 - k % 9, replace=False), rng.choice(10_000, k % 5))) for k in range(60)]

    def lowest(left, right):
        root = list(range(60))
        for a in left:
            for b in right:
                i = len(np.intersect1d(sets[a], sets[b]))
                if 10 * i >= 8 * (len(sets[a]) + len(sets[b]) - i):
                    low, high = sorted((root[a], root[b]))
                    root = [low if r == high else r for r in root]
        return root
    for rows in (4, 7, 64):
        monkeypatch.setattr(J, "ROWS", rows)
        for left, right in ((np.arange(60), np.arange(60)), (np.arange(0, 60, 2), np.arange(1, 60, 2))):
            want = lowest(left, right)
            assert J.block_forest(sets, left, right, 800, 1000).tolist() == want
            assert 3 < len(set(want)) < 50


@pytest.mark.parametrize("t_num", [900, 800])
def test_linked_sets_share_a_part(t_num):
    """Random pairs at the bound have a part's key in common, cut in one batch or each by itself."""
    rng = np.random.default_rng(6)
    seen = 0
    for _ in range(3000):
        x = np.unique(rng.integers(0, 2**48, int(rng.integers(1, 150)), dtype=np.uint64))
        drop = int(rng.integers(0, int(len(x) * (1 - t_num / 1000)) + 1))
        y = np.sort(x[rng.permutation(len(x))[drop:]])
        y = np.unique(np.append(y, rng.integers(0, 2**48, int(rng.integers(0, len(x) // 8 + 1)), dtype=np.uint64)))
        i = len(np.intersect1d(x, y))
        if 1000 * i < t_num * (len(x) + len(y) - i):
            continue
        seen += 1
        keys, offs = J.parts_of(np.concatenate([x, y]), np.array([0, len(x), len(x), len(x) + len(y)]), t_num)
        alone = [J.parts_of(s, np.array([0, len(s)]), t_num)[0] for s in (x, y)]
        assert offs[1] == offs[2] and (keys == np.concatenate(alone)).all()
        assert np.intersect1d(*alone).size
    assert seen > 500


@pytest.mark.parametrize("t_num", [900, 800])
def test_linked_sets_share_first_grams(t_num):
    """Over many random pairs at the bound: they share as many of their first n-grams as the smaller's c says."""
    rng = np.random.default_rng(3)
    seen = 0
    for _ in range(4000):
        x = np.unique(rng.integers(0, 2**48, int(rng.integers(1, 150)), dtype=np.uint64))
        drop = int(rng.integers(0, int(len(x) * (1 - t_num / 1000)) + 1))
        y = np.sort(x[rng.permutation(len(x))[drop:]])
        y = np.unique(np.append(y, rng.integers(0, 2**48, int(rng.integers(0, len(x) // 8 + 1)), dtype=np.uint64)))
        i = len(np.intersect1d(x, y))
        if 1000 * i < t_num * (len(x) + len(y) - i):
            continue
        seen += 1
        keys, offs = J.first_grams(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), t_num)
        assert np.intersect1d(keys[:offs[1]], keys[offs[1]:]).size >= J.common_first(min(len(x), len(y)), t_num)
    assert seen > 500


def test_gram_sets_equal_the_loop():
    texts = [r[1] for r in corpus(9)]
    sets = [s for p in W.parts(pa.array(texts, pa.string())) for s in [J.gram_sets(p, 3)]]
    sizes = np.concatenate([np.diff(o) for _, o in sets])
    assert sizes.tolist() == [len(grams(t, 3)) for t in texts]


def test_one_document_of_each_group_stays(docs_df):
    rows = corpus()
    df = docs_df(rows + rows[:3], ", _head long", (1,))
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    want = sorted({c for d, _, c in brute(rows, 3, 9, 10) if d == c})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_ids_that_are_null(docs_df):
    rows = [(None, "a b c d e f", "en", "s"), (None, "a b c d e f", "en", "s"), (4, "a b c d e f", "en", "s"),
            (None, "q r s t", "en", "s"), (None, None, "en", "s")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.join_components(docs_df(rows)).collect()), key=str)
    assert got == sorted([(None, 4, 4), (None, 4, 4), (4, 4, 4), (None, 2, None), (None, 0, None)], key=str)
    assert J.join_components(docs_df([])).collect() == []


def test_one_id_with_several_texts(docs_df):
    """Each text keeps its own n-grams and its own fate, whatever else its id stands for."""
    def family(name, ids):
        return [(i, " ".join(f"{name}{i}" if j == 20 else f"{name}_{j}" for j in range(90)), "en", "s") for i in ids]
    a, b, c = family("a", range(30)), family("b", range(10, 40)), [(50, r[1], "en", "s") for r in family("c", (1, 2))]
    lone = [(60, " ".join(f"{x}{j}" for j in range(30)), "en", "s") for x in "xy"] + [(15, "nothing like the others here", "en", "s")]
    rows = a + b + c + lone
    assert sorted(map(tuple, J.join_components(docs_df(rows)).collect())) == brute(rows, 3, 9, 10)
    kept = sorted((r["doc_id"], r["text"]) for r in J.keep_one(docs_df(rows + lone[:1])).collect())
    assert [k for k in kept if k[0] != 50] == sorted((r[0], r[1]) for r in [a[0], b[0], *lone])
    assert len([k for k in kept if k[0] == 50]) == 1


def test_components_of_long_chains(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 80)] + [(5000, 4000), (4000, 5000), (7, 7)]
    rng.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 80)}, 5000: 4000}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
