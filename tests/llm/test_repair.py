import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rekindle.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged_brute(rows):
    out = []
    for c, t, role, text in rows:
        one = lambda x: " " if x is None else x
        d = zlib.crc32(f"{one(c)}:{one(t)}".encode()) % 20
        role, text = one(role), one(text)
        if d == 0:
            continue
        role = "user" if d == 4 else role
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(c, t, role, text)] * (2 if d == 3 else 1)
    return out


def repair_brute(turns):
    """Least (cost, audit) for each state after each row, and the rows that go with it."""
    turns = sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in turns:
        said = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not said else "d" if (role, text) in seen else "" if said[-1] in ".!?" else "t")
        seen.add((role, text))
    go = {"n": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(2):
            for q, (c, a, o) in list(best.items()):
                new = (c + 3, a + "I", o + [name[go[q]] + ":"])
                if go[q] not in best or new[:2] < best[go[q]][:2]:
                    best[go[q]] = new
        return best
    best = inserted({"n": (0, "", [])})
    for (_, _, role, text), fault in zip(turns, faults, strict=True):
        after = {}

        def put(q, new, after=after):
            if q not in after or new[:2] < after[q][:2]:
                after[q] = new
        for q, (c, a, o) in best.items():
            put(q, (c + 4, a + "D", o))
            if fault in ("", "t"):
                more = 3 * (fault == "t")
                if role[:1] == go[q] or (role[:1] == "s" and q == "n"):
                    put(role[:1], (c + more, a + "K", o + [f"{role}:{text}"]))
                put(go[q], (c + 3 + more, a + "R", o + [f"{name[go[q]]}:{text}"]))
        best = inserted(after)
    cost, audit, out = min((best[q] for q in ("n", "a") if q in best), key=lambda x: x[:2])
    known = [t for _, t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(turns))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def op12_brute(rows):
    hit = damaged_brute(rows)
    return sorted(((c, *repair_brute([r for r in hit if r[0] == c])) for c in {r[0] for r in rows}), key=str)


def made(rng, c, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "unknown", "sys", "", None]
    texts = ["Hi.", "Well?", "no end", "Hi.", "", None, " \n", "Ja! ", "x" * 50 + ".", "zwei. drei"]
    out = []
    for t in range(n):
        if rng.random() < 0.6:
            out.append((c, t, ["user", "assistant"][t % 2], f"turn {t}."))
        else:
            out.append((c, rng.choice([t, t, t, None, t // 2, t + 5]), rng.choice(roles), rng.choice(texts)))
    return out


def corpus():
    rng = random.Random(8)
    rows = [r for c in range(40) for r in made(rng, c, rng.choice([1, 2, 3, 8, 15]))]
    rows += made(rng, None, 12) + made(rng, 900, 230) + made(rng, 901, 61) + [(902, 1, "user", "a.")] * 70
    rows += [(903, t, "system", "a.") for t in range(9)] + [(904, t, None, None) for t in range(30)]
    dropped = next(t for t in range(1000) if zlib.crc32(f"905:{t}".encode()) % 20 == 0)
    return rows + [(905, dropped, "user", "gone.")]


@pytest.mark.parametrize("block,fan,parts", [(64, 64, 4), (4, 3, 7), (1, 2, 2)])
def test_query_equals_dynamic_programming(spark, block, fan, parts):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n long, audit string").repartition(parts)
    got = R.repair(R.damaged(df), copies=F.col("copies"), block=block, fan=fan).select(*R._RESULT)
    assert sorted((tuple(r) for r in got.collect()), key=str) == op12_brute(rows)


def test_empty_table_and_real_outputs(spark):
    assert R.op12_query(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(c, t, r, x) for c in range(3) for t, (r, x) in enumerate([("user", "a."), ("user", "b."), ("assistant", "c.")])]
    got = R.repair(spark.createDataFrame(rows, SCHEMA).repartition(1)).collect()
    assert {r.audit for r in got} == {"KIKK"} and {r.cost for r in got} == {3}
    assert "user:a.\nassistant:\nuser:b.\nassistant:c." in [r.repaired for r in got]


def test_auction_prices_are_exact():
    """Against Bellman's equations, for every origin and target of random lattices."""
    rng = random.Random(2)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice(["", "", "t", "b", "d"])) for _ in range(rng.choice([0, 1, 2, 5, 9]))]
        arcs, low = R.edit_lattice(rows)
        n = len(arcs)
        assert all(low[i] <= c + low[j] for i in range(n) for _, c, j in arcs[i])
        want = []
        for r in range(4):
            d = [10**6] * n
            d[n - 4 + r] = 0
            for _ in range(n):
                for i in range(n):
                    d[i] = min([d[i], *[c + d[j] for _, c, j in arcs[i]]])
            want.append(d[:4])
        got = R.distances(arcs, low)
        assert got == [w if (w := want[r][q]) < 10**6 else -1 for q in range(4) for r in range(4)]
        # two lattices one after the other are one
        more = [(rng.choice("suat"), rng.choice(["", "t", "b"])) for _ in range(4)]
        assert R.distances(*R.step_lattice([got, R.distances(*R.edit_lattice(more))])) == R.distances(*R.edit_lattice(rows + more))


def test_least_audit_among_all_of_its_cost():
    """Every edit sequence of short conversations, written out."""
    def every(rows, state=0, cost=0, audit="", budget=14):
        if cost > budget:
            return
        if not rows:
            if state in (0, 3):
                yield cost, audit
        else:
            (x, fault), rest = rows[0], rows[1:]
            yield from every(rest, state, cost + 4, audit + "D", budget)
            if fault in ("", "t"):
                more = 3 * (fault == "t")
                if x == "s" and state == 0:
                    yield from every(rest, 1, cost + more, audit + "K", budget)
                if x == "ua"[state == 2]:
                    yield from every(rest, R._NEXT[state], cost + more, audit + "K", budget)
                yield from every(rest, R._NEXT[state], cost + 3 + more, audit + "R", budget)
        yield from every(rows, R._NEXT[state], cost + 3, audit + "I", budget)
    for rows in itertools.product([(x, f) for x in "suat" for f in ("", "t", "b")], repeat=3):
        rows = list(rows)
        [(cost, edits)] = R.solved(rows, [c for c, _ in R.ENDING], [0])
        audit, _, _ = R.applied(edits, ["r"] * 3, ["t"] * 3, 0, True)
        assert (cost, audit) == min(every(rows))
