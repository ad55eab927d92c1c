import random
import re

import numpy as np
import pytest
import xxhash

from rekindle.llm import simhash as S

LOWER = {65 + i: 97 + i for i in range(26)}


def brute_fingerprint(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, distance=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        seen = [x for x in (least.get(find(k)), i) if x is not None]
        least[find(k)] = min(seen) if seen else None
    return [least[find(k)] for k in range(len(ids))]


def corpus():
    rng = random.Random(4)
    vocab = [f"Wort{i}" for i in range(200)] + ["é", "日本", "x y"]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one two"), (5, "ONE two"), (5, "one two three"), (None, "one")]
    i = 10
    for _ in range(30):
        w = [rng.choice(vocab) for _ in range(rng.choice([3, 4, 5, 40, 400, 1500]))]
        for _ in range(rng.choice([1, 2, 5])):
            x = list(w)
            if rng.random() < 0.6:
                x[rng.randrange(len(x))] = rng.choice(vocab)
            rows.append((i, rng.choice([" ", "\n", " \t "]).join(x)))
            i += 1
    return rows + [rows[9], rows[9], (i, "lang " * 40_000)]


def test_fingerprints_and_components_equal_loops(docs_df):
    rows = corpus()
    df = docs_df([(i, t, "en", "s") for i, t in rows], ", fp long, component_id string, n long", (9, "c", 1))
    got = S.op11_query(df).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], fps)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == sorted(
        [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want, strict=True)], key=key)
    assert got[0].asDict().keys() >= {"doc_id", "fingerprint", "component_id"}


def test_empty_table(docs_df):
    assert S.op11_query(docs_df([])).collect() == []


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 18])
def test_blocks_of_long_texts_change_nothing(block, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S.word_blocks, "__defaults__", (block,))
    for _, t in corpus()[:40]:
        assert S.fingerprint((t or "").encode(), 3) == brute_fingerprint(t)


@pytest.mark.parametrize("distance,segments", [(2, 2), (1, 2), (3, 2), (2, 3), (4, 3)])
@pytest.mark.parametrize("crowd", [2, 32])
def test_links_have_the_components_of_all_pairs(spark, distance, segments, crowd):
    rng = random.Random(distance * 10 + segments)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(9):
            x = base
            for b in rng.sample(range(64 if rng.random() < 0.5 else 32), rng.randint(0, distance + 1)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps | {0, 2**64 - 1, 1 << 63})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    out = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance=distance, segments=segments,
                  crowd=crowd).collect()
    assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= distance for r in out)
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in out:
        root[max(find(r.u), find(r.v))] = min(find(r.u), find(r.v))
    assert [find(x) for x in signed] == brute_components(signed, fps, distance)


def test_a_dense_crowd_does_linear_work(spark):
    """All fingerprints share one piece; links stay in proportion to their number."""
    fps = [(7 << 32) | x for x in range(1 << 11)]
    out = S.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    assert len(out) <= 65 * len(fps)
    from rekindle.llm.components import components
    got = components(spark.createDataFrame([tuple(r) for r in out], "u long, v long"))
    assert got.select("root").distinct().count() == 1 and got.count() == len(fps) - 1
