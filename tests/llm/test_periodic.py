import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rekindle.llm import periodic as P


def runs_brute(w):
    found, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                root = w[i:i + q]
                if not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_brute(w, runs):
    return " ".join(x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in runs))


def planted_brute(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def op13_brute(i, text):
    w = planted_brute(i, text)
    runs = runs_brute(w)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (i, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed_brute(w, runs)))


def made(rng, n):
    """Words with runs of all kinds: powers, nested and overlapping runs, long periods."""
    w = []
    while len(w) < n:
        q = rng.choice([1, 1, 2, 3, 4, 6, 7, 12, 30, 90])
        root = [rng.choice("abcd") for _ in range(q)]
        k = rng.choice([0, 1, 3, 4, 5, 9])
        w += root * k + root[:rng.randrange(q + 1)] + [f"x{rng.randrange(1000)}"] * rng.choice([0, 1])
    return w[:n]


@pytest.mark.parametrize("tile", [16, 64, 256, 4096])
def test_tiles_and_stitching_equal_loops(tile):
    rng = random.Random(tile)
    for n in [0, 1, 5, 6, 7, 16, 17, 63, 64, 65, 130, 300, 700, 1500]:
        for kind in range(4):
            w = [made(rng, n), ["a"] * n, ["a", "b", "a"] * (n // 3), made(rng, n // 3) * 3][kind]
            c = P.word_codes([x.encode() for x in w])
            by_q = {}
            for a, b, lo, hi in P.tiles(len(c), tile):
                for q, i, j in P.fragments(c[a:b], lo, hi, len(c) // 4):
                    by_q.setdefault(q, []).append((a + i, a + j))
            runs = []
            for q, parts in by_q.items():
                whole = []
                for i, j in sorted(parts):
                    if whole and i <= whole[-1][1]:
                        whole[-1][1] = max(j, whole[-1][1])
                    else:
                        whole.append([i, j])
                runs += [(i, j - i + q, q) for i, j in whole if P.long_enough(q, i, j)]
            assert sorted(runs, key=lambda r: (r[0], r[2])) == runs_brute(w), (n, kind)


def rows_of():
    rng = random.Random(3)
    rows = [(None, "a " * 30), (1, None), (2, ""), (3, " \n\t "), (4, "a a a a a a"), (4, "a a a a a"), (5, "é " * 9)]
    rows += [(100 + k, rng.choice([" ", "\n", "\t "]).join(made(rng, rng.choice([3, 20, 80, 200])))) for k in range(60)]
    rows += [(1000 + k, " ".join(made(rng, 900))) for k in range(12)]
    return rows + [rows[4], rows[4], rows[70], (2000, "one two three " * 300)]


def test_query_equals_brute_force(docs_df, monkeypatch):
    monkeypatch.setattr(P.find_runs, "__kwdefaults__", P.find_runs.__kwdefaults__ | {"tile": 64})
    rows = rows_of()
    df = docs_df([(i, t, "en", "s") for i, t in rows], ", runs string, row int, q int, n_words int", ("r", 1, 2, 3))
    got = [tuple(r)[:8] for r in P.op13_query(df).collect()]
    want = [op13_brute(i, t) for i, t in rows]
    assert any(x[1] > 3 for x in want) and any(zlib.crc32(str(x[0]).encode()) % 10 == 0 for x in want)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_real_outputs_and_empty_table(docs_df):
    [r] = P.find_runs(docs_df([(1, "x  a b a b a b a b y", "en", "s")])).collect()
    assert [tuple(x) for x in r.runs] == [(1, 8, 2)] and r.collapsed == "x a b y" and r.n_words == 10
    assert P.op13_query(docs_df([])).collect() == []


def test_powers_are_left_out_at_every_octave():
    c = np.zeros(5000, np.int32)
    assert P.fragments(c, 0, 62, 1250) == [(1, 0, 4999)]


def test_planted_rows_are_written_before_runs_are_found(docs_df):
    """One Arrow UDF a task: texts that are changed are not changed again in the plan that finds runs."""
    rows = [(i, f"a{i} b c d e f g " * 5, "en", "s") for i in range(60)] + [(None, "x y", None, None), (61, None, "en", "s")]
    df = docs_df(rows)
    planted = P.with_planted_runs(df)
    assert "ArrowEvalPython" not in planted._jdf.queryExecution().optimizedPlan().toString()
    got = {r["doc_id"]: r["text"] for r in planted.collect()}
    assert len(got) == len(rows) and got[None] == "x y" and got[61] is None
    for i in range(60):
        h = zlib.crc32(str(i).encode())
        words = f"a{i} b c d e f g".split() * 5
        if h % 10 == 0:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert got[i].split() == words[:a] + [words[a + k % p] for k in range(n - a)]
        else:
            assert got[i].split() == words
