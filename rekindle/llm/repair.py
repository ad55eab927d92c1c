"""Conversation structure repair: shortest paths by auction over a lattice of edits.

Each row of a conversation is kept (K), given the role user or assistant (R) or
deleted (D), and empty user or assistant rows are inserted (I), so that the roles'
initials read ``(s?(ua)+)?`` at the least cost.  Nodes of the lattice are (place,
what was last said: nothing, system, user, assistant); edits are its arcs.

1. **Auction.**  Every node has a price, at first the sum of what the rows behind it
   cost at least, so no arc costs less than the difference of its ends' prices.  A
   path from the origin is extended along an arc that costs just that difference
   (a tight arc); where its last node has none, that node's price rises to the next
   possible one and the path contracts.  When the path reaches the target, the
   origin's price is the exact distance; each arc of a cheapest path is tight, and
   following the ASCII-least tight arc from the origin gives the least audit: a
   node on that way has its exact price, so a lesser letter that is not tight there
   leads to no cheapest path.  Prices are kept for further origins.
2. **Blocks.**  Rows sorted by range partitions are cut into blocks of ``ROWS`` rows.  A
   conversation of one block, as nearly all are, is solved where it lies.  Of longer
   ones each block gives its distances from state to state; groups of ``FAN`` blocks
   are lattices of the same kind, and groups of groups, until one is left.  The
   remaining costs at the end of every block come back the same way, each block is
   traced for every state it may be entered in, and the states are handed on through
   the groups.  No task holds a long conversation; only the digest of its repaired
   text, a chain by nature, reads it in one task, block after block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rekindle.llm.common import null_safe, small_batches, spread_join, written

#: Rows in a block (or BLOCK_CHARS characters), and blocks in a group.
ROWS = 64
FAN = 64
BLOCK_CHARS = 1 << 20
#: Equal rows of one turn are kept as one row with a number, at most so large.
COPIES = 4096

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What it costs to end a conversation in each state, and the rows that are put in for it.
ENDING = ((0, 0), (6, 2), (3, 1), (0, 0))
RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
_FAR = 1 << 60
_NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_NAME = {USER: "user", ASSISTANT: "assistant"}

Arcs = list[list[tuple[str, int, int]]]


# -- the auction ---------------------------------------------------------------

def edit_lattice(rows: list[tuple[str, str]]) -> tuple[Arcs, list[int]]:
    """Arcs of each node 4 * place + state in ASCII order, and first prices, for rows (role initial, fault).

    Faults: b blank, d duplicate, t truncated, "" none.
    """
    arcs: Arcs = []
    low = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        low[i] = low[i + 1] + {"b": DELETE, "d": DELETE, "t": min(DELETE, TRUNCATED)}.get(rows[i][1], 0)
    for i, (initial, fault) in enumerate(rows):
        for q in range(4):
            at, then = 4 * i, 4 * i + 4
            own = [("D", DELETE, then + q), ("I", INSERT, at + _NEXT[q])]
            if fault in ("", "t"):
                more = TRUNCATED if fault else 0
                keep = SYSTEM if initial == "s" and q == NOTHING else _NEXT[q] if initial == "ua"[q == USER] else None
                if keep is not None:
                    own.append(("K", more, then + keep))
                own.append(("R", RETAG + more, then + _NEXT[q]))
            arcs.append(own)
    arcs += [[], [], [], []]
    return arcs, [x for x in low for _ in range(4)]


def step_lattice(matrices: list[list[int]]) -> tuple[Arcs, list[int]]:
    """The same for steps given by their distances from state to state (-1: no way)."""
    arcs: Arcs = []
    low = [0] * (len(matrices) + 1)
    for i in range(len(matrices) - 1, -1, -1):
        low[i] = low[i + 1] + min(x for x in matrices[i] if x >= 0)
    for i, m in enumerate(matrices):
        arcs += [[("", m[4 * q + r], 4 * i + 4 + r) for r in range(4) if m[4 * q + r] >= 0] for q in range(4)]
    arcs += [[], [], [], []]
    return arcs, [x for x in low for _ in range(4)]


def with_target(arcs: Arcs, low: list[int], after: list[int]) -> tuple[Arcs, list[int]]:
    """A last node, reached from the end's states at the costs ``after``."""
    n, least = len(arcs), min(after)
    return ([*arcs[:-4], *[[("", after[q], n)] for q in range(4)], []], [x + least for x in low] + [0])


def auction(arcs: Arcs, price: list[int], origin: int, target: int) -> int:
    """The distance from origin to target; ``price`` is raised until the path that it supports gets there."""
    path = [origin]
    while path[-1] != target:
        i = path[-1]
        best, to = _FAR, -1
        for _, cost, j in arcs[i]:
            if cost + price[j] < best:
                best, to = cost + price[j], j
        if best > price[i]:  # contraction
            price[i] = best
            if i != origin:
                path.pop()
        else:  # extension
            path.append(to)
    return price[origin] - price[target]


def trace(arcs: Arcs, price: list[int], origin: int, target: int) -> list[tuple[str, int, int]]:
    """(letter, node, next node) along the ASCII-least tight arcs of converged prices."""
    out, i = [], origin
    while i != target:
        letter, j = next((x, j) for x, cost, j in arcs[i] if price[i] == cost + price[j])
        out.append((letter, i, j))
        i = j
    return out


def distances(arcs: Arcs, low: list[int]) -> list[int]:
    """From each state at the beginning to each at the end (-1: no way), by one auction a target for all origins."""
    n = len(arcs)
    back: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(arcs):
        for _, _, j in own:
            back[j].append(i)
    out = [-1] * 16
    for r in range(4):
        target = n - 4 + r
        live, todo = {target}, [target]
        while todo:
            for i in back[todo.pop()]:
                if i not in live:
                    live.add(i)
                    todo.append(i)
        price = [low[i] if i in live else _FAR for i in range(n)]  # nodes without a way are never entered
        for q in range(4):
            if q in live:
                out[4 * q + r] = auction(arcs, price, q, target)
    return out


def remaining(matrices: list[list[int]], after: list[int]) -> list[list[int]]:
    """The cost from each state at the end of every step, if it is ``after`` at the last one's."""
    arcs, price = with_target(*step_lattice(matrices), after)
    end = len(arcs) - 1
    return [[auction(arcs, price, 4 * i + q, end) for q in range(4)] for i in range(1, len(matrices) + 1)]


def solved(rows: list[tuple[str, str]], after: list[int], entered: list[int]) -> list[tuple[int, list[tuple[str, int, int]]]]:
    """For each state that a block may be entered in: (cost to the end, edits as (letter, row, state after it))."""
    arcs, price = with_target(*edit_lattice(rows), after)
    end = len(arcs) - 1
    out = []
    for q in entered:
        cost = auction(arcs, price, q, end)
        out.append((cost, [(x, i // 4, j % 4) for x, i, j in trace(arcs, price, q, end)]))
    return out


def applied(edits: list[tuple[str, int, int]], roles: list[str], texts: list[str], state: int,
            last: bool) -> tuple[str, list[str], int]:
    """Audit, repaired rows and final state of a block's edits; ``last``: the conversation's end is put in, too."""
    audit, rows = [], []
    for letter, i, q in edits:
        if not letter:
            continue  # the way out
        audit.append(letter)
        if letter != "D":
            rows.append(f"{roles[i]}:{texts[i]}" if letter == "K" else f"{_NAME[q]}:{texts[i] if letter == 'R' else ''}")
        state = q
    for _ in range(ENDING[state][1] if last else 0):
        state = _NEXT[state]
        audit.append("I")
        rows.append(f"{_NAME[state]}:")
    return "".join(audit), rows, state


# -- rows, faults and blocks -----------------------------------------------------

def fault_of(text: str, seen: bool) -> str:
    said = text.rstrip(BLANKS)
    return "b" if not said else "d" if seen else "" if said[-1] in ".!?" else "t"


_BLOCK = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType()), T.StructField("alone", T.BooleanType()),
    T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("faults", T.StringType()), *[T.StructField(x, T.LongType()) for x in (
        "blank", "duplicate", "truncated", "illegal", "low_turn", "high_turn", "turns", "first_turn", "last_turn")]])


class _Block:
    """Rows of a conversation, in order, and what is counted over them."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults: list[str] = []
        self.turns: list[int | None] = []
        self.chars = 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.turns.append(turn)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.roles) >= self.most or self.chars >= BLOCK_CHARS

    def row(self, conv, part: int, k: int, alone: bool) -> dict:
        initials = [r[:1] for r in self.roles]
        known = [t for t in self.turns if t is not None]
        return {"conv_id": conv, "part": part, "k": k, "alone": alone, "roles": self.roles, "texts": self.texts,
                "faults": "".join(f or "-" for f in self.faults), "blank": self.faults.count("b"),
                "duplicate": self.faults.count("d"), "truncated": self.faults.count("t"),
                "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])),
                "low_turn": min(known, default=None), "high_turn": max(known, default=None), "turns": len(set(known)),
                "first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None}


def blocks_of(schema: pa.Schema, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow body over sorted rows (conv_id, turn, role, text, chunk, n, later): blocks.

    A conversation of one block that neither begins nor ends the partition is ``alone``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        conv, block, k, inner, begun, out = None, _Block(most), 0, False, False, []

        def rows():
            for b in batches:
                yield from zip(*[b.column(c).to_pylist() for c in range(7)], strict=True)

        for c, turn, role, text, chunk, n, later in rows():
            if not begun or c != conv:
                if begun:
                    if block.roles or k == 0:
                        out.append(block.row(conv, part, k, inner and k == 0))
                    inner = True
                conv, block, k, begun = c, _Block(most), 0, True
            for copy in range(n):
                block.add(turn, role, text, fault_of(text, later or chunk > 0 or copy > 0))
                if block.full():
                    out.append(block.row(conv, part, k, False))
                    block, k = _Block(most), k + 1
            if len(out) >= 256 or sum(len(r["texts"]) for r in out[-4:]) >= 4 * most:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if begun and (block.roles or k == 0):
            out.append(block.row(conv, part, k, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def block_table(turns: DataFrame, most: int = ROWS) -> DataFrame:
    """Blocks of the rows (conv_id, turn, role, text, copies), sorted by conversation, turn (NULL first), role and text."""
    text_key = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    # a row with no copies only names its conversation
    rows = (turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
            .withColumn("key", text_key))
    said = rows.filter((F.col("n") > 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = (said.groupBy("conv_id", "key").agg(F.min(place).alias("first"), F.count("*").alias("n_rows"))
              .filter("n_rows > 1"))
    rows = spread_join(rows, firsts, ["conv_id", "key"], "n_rows")
    later = F.coalesce(~F.col("turn").eqNullSafe(F.col("first.turn")), F.lit(False)) & F.col("first").isNotNull()
    chunks = F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("n") - 1) / COPIES), F.lit(0)))
    rows = rows.select("conv_id", "turn", "role", "text", F.explode(chunks).alias("chunk"), "n", later.alias("later"))
    rows = rows.withColumn("n", F.least(F.lit(COPIES), F.col("n") - F.col("chunk") * COPIES))
    order = ["conv_id", "turn", "role", "text", "chunk"]
    kind = T.StructType([rows.schema["conv_id"], *_BLOCK.fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(blocks_of(to_arrow_schema(kind), most), kind), "repair-blocks")


def _pairs(b: dict) -> list[tuple[str, str]]:
    return [(r[:1], f.strip("-")) for r, f in zip(b["roles"], b["faults"], strict=True)]


def _rows_out(fn: Callable[[dict], dict], schema: pa.Schema):
    """mapInArrow body: ``fn`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([fn(r) for r in b.to_pylist()], schema)
    return run


def _mapped(df: DataFrame, fn: Callable[[dict], dict], more: str) -> DataFrame:
    """``fn`` of every row, keeping conv_id; ``more``: the other columns as DDL."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = T.StructType([df.schema["conv_id"], *T.StructType.fromDDL(more).fields])
    return df.mapInArrow(_rows_out(fn, to_arrow_schema(kind)), kind)


# -- long conversations: groups of blocks, and groups of groups -------------------

def _grouped(df: DataFrame, fn: Callable[[list[dict]], list[dict]], fan: int) -> DataFrame:
    """``fn`` of the rows (conv_id, idx, value, given) of every ``fan`` neighbours: rows (conv_id, idx, value)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = T.StructType([df.schema["conv_id"], T.StructField("idx", T.LongType()), T.StructField("value", T.ArrayType(T.LongType()))])
    schema = to_arrow_schema(kind)

    def run(t: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(fn(sorted(t.to_pylist(), key=lambda r: r["idx"])), schema)
    return df.withColumn("g", F.floor(F.col("idx") / fan)).groupBy("conv_id", "g").applyInArrow(run, kind)


def through_groups(steps: DataFrame, combine: Callable[[list[list[int]]], list[int]],
                   hand_on: Callable[[list[list[int]], list[int]], list[list[int]]], given: list[int],
                   fan: int) -> DataFrame:
    """(conv_id, idx, value): what reaches every step (conv_id, idx, value) if ``given`` reaches the whole conversation.

    ``combine`` makes one value of a group's; ``hand_on`` gives each of a group's
    steps its own, from the values and what reaches the group.
    """
    levels, most = [steps], steps.agg(F.max("idx").alias("m")).scalar()
    top = steps.sparkSession.range(1).select(most.alias("m")).first()["m"] or 0
    while top >= fan:
        up = _grouped(levels[-1].withColumn("given", F.lit(None).cast("array<bigint>")), lambda rows: [
            {"conv_id": rows[0]["conv_id"], "idx": rows[0]["idx"] // fan, "value": combine([r["value"] for r in rows])}], fan)
        levels.append(written(up, "repair-level"))
        top //= fan
    reach = levels[-1].select("conv_id", F.floor(F.col("idx") / fan).alias("g")).distinct().withColumn(
        "given", F.lit(given).cast("array<bigint>"))
    for level in reversed(levels):
        wide = null_safe(level.withColumn("g", F.floor(F.col("idx") / fan)), reach, ["conv_id", "g"]).drop("g")
        down = _grouped(wide, lambda rows: [
            {"conv_id": r["conv_id"], "idx": r["idx"], "value": x}
            for r, x in zip(rows, hand_on([r["value"] for r in rows], rows[0]["given"]), strict=True)], fan)
        found = written(down, "repair-reach")
        reach = found.select("conv_id", F.col("idx").alias("g"), F.col("value").alias("given"))
    return found


def _states(maps: list[list[int]], entered: list[int]) -> list[list[int]]:
    out, q = [], entered[0]
    for m in maps:
        out.append([q])
        q = m[q]
    return out


def _composed(maps: list[list[int]]) -> list[int]:
    out = [0, 1, 2, 3]
    for m in maps:
        out = [m[q] for q in out]
    return out


def _digests(schema: pa.Schema):
    """mapInArrow body over (conv_id, idx, audit, piece, cost) by conversation and idx: one row each, text after text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, audit, sha, some, cost = None, False, [], hashlib.sha256(), False, 0

        def done():
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "audit": "".join(audit), "cost": cost,
                                                "repaired_sha256": sha.hexdigest()}], schema)
        for b in batches:
            for r in b.to_pylist():
                if not begun or r["conv_id"] != conv:
                    if begun:
                        yield done()
                    conv, begun, audit, sha, some, cost = r["conv_id"], True, [], hashlib.sha256(), False, 0
                audit.append(r["audit"])
                cost = r["cost"] if r["idx"] == 0 else cost
                if r["piece"] is not None:
                    sha.update((b"\n" if some else b"") + r["piece"].encode())
                    some = True
        if begun:
            yield done()
    return run


_RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_NO_TEXT = hashlib.sha256(b"").hexdigest()


def repaired_blocks(open_: DataFrame, fan: int = FAN) -> DataFrame:
    """(conv_id, idx, audit, piece, cost, ...) of blocks (conv_id, idx, total, roles, texts, faults) of long conversations.

    ``piece``: the block's repaired rows, joined by newlines (NULL: none); ``cost``
    is what remains from the block's beginning.
    """
    after = [c for c, _ in ENDING]
    steps = written(_mapped(open_.select("conv_id", "idx", "roles", "faults"), lambda b: {
        "conv_id": b["conv_id"], "idx": b["idx"], "value": distances(*edit_lattice(_pairs(b)))},
        "idx bigint, value array<bigint>"), "repair-steps")
    costs = through_groups(steps, lambda ms: distances(*step_lattice(ms)), remaining, after, fan)
    costs = costs.withColumnRenamed("value", "after")
    known = written(null_safe(open_, costs, ["conv_id", "idx"]), "repair-known")

    def ends(b: dict) -> dict:
        found = solved(_pairs(b), b["after"], [0, 1, 2, 3])
        return {"conv_id": b["conv_id"], "idx": b["idx"], "value": [
            next((s for x, _, s in reversed(edits) if x), q) for q, (_, edits) in enumerate(found)]}
    maps = written(_mapped(known.select("conv_id", "idx", "roles", "faults", "after"), ends, "idx bigint, value array<bigint>"),
                   "repair-maps")
    entered = through_groups(maps, _composed, _states, [NOTHING], fan).withColumnRenamed("value", "entered")

    def final(b: dict) -> dict:
        [(cost, edits)] = solved(_pairs(b), b["after"], b["entered"])
        audit, rows, _ = applied(edits, b["roles"], b["texts"], b["entered"][0], b["idx"] == b["total"] - 1)
        return {"conv_id": b["conv_id"], "idx": b["idx"], "audit": audit, "piece": "\n".join(rows) if rows else None, "cost": cost}
    return written(_mapped(null_safe(known, entered, ["conv_id", "idx"]), final,
                           "idx bigint, audit string, piece string, cost bigint"), "repair-pieces")


def _gaps(low: Column, high: Column, turns: Column) -> Column:
    return F.when(low.isNull(), F.lit(0)).otherwise(high - low + 1 - turns).cast("long")


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies: Column | None = None, block: int = ROWS,
           fan: int = FAN) -> DataFrame:
    """One row per conversation: its faults before, and the cheapest repair.

    conv_id, gaps (missing turn numbers), blank, duplicate, truncated (rows by first
    fault), illegal (neighbouring roles that do not follow each other), cost, audit
    (the edits' initials), repaired_sha256 (of the repaired ``role:text`` rows,
    joined by newlines), repaired (that text; NULL for conversations of several
    blocks, whose pieces ``repaired_blocks`` has).

    ``copies``: how often a row stands there (0: it only names its conversation).

    Defined cases: a NULL role or text is one space; a role without a legal initial
    can only be changed or go; rows go by turn (NULL first), then role, then text;
    rows repeated in full are duplicates; NULL conversation ids are one
    conversation; a conversation without rows has zeros, an empty audit and the
    digest of no text; an empty table gives an empty result; other columns are
    ignored.  The audit of a conversation is one string, a character an edit.
    """
    spark = turns.sparkSession
    small_batches(spark)
    space = F.lit(" ")
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
                        (F.lit(1) if copies is None else copies).cast("long").alias("copies"))
    gone = F.col("copies") <= 0
    rows = rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").otherwise(F.col("role")).alias("role"),
                       F.when(gone, "").otherwise(F.col("text")).alias("text"), F.greatest("copies", F.lit(0)).alias("copies"))
    blocks = block_table(rows, block)

    def whole(b: dict) -> dict:
        [(cost, edits)] = solved(_pairs(b), [c for c, _ in ENDING], [NOTHING])
        audit, said, _ = applied(edits, b["roles"], b["texts"], NOTHING, True)
        text = "\n".join(said)
        return {x: b[x] for x in ("conv_id", "blank", "duplicate", "truncated", "illegal", "low_turn", "high_turn", "turns")} | {
            "cost": cost, "audit": audit, "repaired": text, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
    counted = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, low_turn bigint, high_turn bigint, turns bigint"
    short = _mapped(blocks.filter("alone"), whole, f"{counted}, cost bigint, audit string, repaired string, repaired_sha256 string")
    short = short.withColumn("gaps", _gaps(F.col("low_turn"), F.col("high_turn"), F.col("turns"))).select(*_RESULT, "repaired")

    rest = blocks.filter("not alone")
    filled = rest.filter(F.size("roles") > 0)
    per_part = filled.groupBy("conv_id", "part").agg(F.count("*").alias("m"))  # a row a range partition
    w = Window.partitionBy("conv_id").orderBy("part")
    places = per_part.select("conv_id", "part", (F.sum("m").over(w) - F.col("m")).alias("before"),
                             F.sum("m").over(Window.partitionBy("conv_id")).alias("total"))
    open_ = written(null_safe(filled, places, ["conv_id", "part"]).withColumn("idx", F.col("before") + F.col("k"))
                    .drop("before", "part", "k", "alone"), "repair-open")
    pieces = repaired_blocks(open_, fan)
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = T.StructType([open_.schema["conv_id"], T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType()),
                         T.StructField("repaired_sha256", T.StringType())])
    digests = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "idx")
               .select("conv_id", "idx", "audit", "piece", "cost").mapInArrow(_digests(to_arrow_schema(kind)), kind))
    # neighbouring blocks: the pair of roles between them, and a turn that goes on
    edge = open_.select("conv_id", "idx", "first_turn", "last_turn", F.substring(F.get("roles", F.lit(0)), 1, 1).alias("x"),
                        F.substring(F.element_at("roles", -1), 1, 1).alias("y"))
    after = edge.select("conv_id", (F.col("idx") - 1).alias("idx"), F.col("x").alias("next"), F.col("first_turn").alias("next_turn"))
    joints = null_safe(edge, after, ["conv_id", "idx"]).groupBy("conv_id").agg(
        F.sum((~F.concat("y", "next").isin(*LEGAL)).cast("long")).alias("more_illegal"),
        F.sum((F.col("last_turn") == F.col("next_turn")).cast("long")).alias("same"))
    counts = open_.groupBy("conv_id").agg(
        *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "illegal", "turns")],
        F.min("low_turn").alias("low_turn"), F.max("high_turn").alias("high_turn"))
    named = rest.select("conv_id").distinct()
    far = null_safe(null_safe(null_safe(named, counts, ["conv_id"], "left"), joints, ["conv_id"], "left"), digests, ["conv_id"], "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0).cast("long"))
    far = far.select("conv_id", _gaps(F.col("low_turn"), F.col("high_turn"), F.col("turns") - zero("same")).alias("gaps"),
                     zero("blank").alias("blank"), zero("duplicate").alias("duplicate"), zero("truncated").alias("truncated"),
                     (zero("illegal") + zero("more_illegal")).alias("illegal"), zero("cost").alias("cost"),
                     F.coalesce("audit", F.lit("")).alias("audit"),
                     F.coalesce("repaired_sha256", F.lit(_NO_TEXT)).alias("repaired_sha256"),
                     F.lit(None).cast("string").alias("repaired"))
    return short.unionByName(far)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: one row in twenty each dropped, emptied, without end marks, doubled, said by the user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(d == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(d == 1, "").when(d == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(d == 0, 0).when(d == 3, 2).otherwise(1).alias("copies"))


def op12_query(turns: DataFrame) -> DataFrame:
    return repair(damaged(turns), copies=F.col("copies")).select(*_RESULT)


ORACLE = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) ORDER BY i) AS t
  FROM range(256) r(i)),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
c AS (SELECT k.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                  lambda a, b: xor(a // 256, t[CAST(xor(a, b) % 256 AS INTEGER) + 1])), 4294967295) % 20 AS d FROM k, tab),
e AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
             CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE d <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen FROM e),
f AS (SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS x,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen THEN 'd'
                  WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN '' ELSE 't' END AS fault FROM o),
g AS (SELECT *, lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x AS pair, count(*) OVER (PARTITION BY conv_id) AS n FROM f),
ins(q, letters, q2, cost, said) AS (VALUES
  (0, '', 0, 0, ''), (0, 'I', 2, 3, chr(10) || 'user:'), (0, 'II', 3, 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, '', 1, 0, ''), (1, 'I', 2, 3, chr(10) || 'user:'), (1, 'II', 3, 6, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, '', 2, 0, ''), (2, 'I', 3, 3, chr(10) || 'assistant:'), (3, '', 3, 0, ''), (3, 'I', 2, 3, chr(10) || 'user:')),
arc(q, letter, q2, cost, x) AS (VALUES (0, 'D', 0, 4, NULL), (1, 'D', 1, 4, NULL), (2, 'D', 2, 4, NULL), (3, 'D', 3, 4, NULL),
  (0, 'K', 1, 0, 's'), (0, 'K', 2, 0, 'u'), (1, 'K', 2, 0, 'u'), (3, 'K', 2, 0, 'u'), (2, 'K', 3, 0, 'a'),
  (0, 'R', 2, 3, NULL), (1, 'R', 2, 3, NULL), (3, 'R', 2, 3, NULL), (2, 'R', 3, 3, NULL)),
way AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'c': CAST(0 AS BIGINT), 'a': '', 'o': ''} AS s FROM (SELECT DISTINCT conv_id FROM g)
  UNION ALL
  SELECT w.conv_id, g.i, arc.q2, min({'c': w.s.c + ins.cost + arc.cost + CASE WHEN arc.letter <> 'D' AND fault = 't' THEN 3 ELSE 0 END,
      'a': w.s.a || ins.letters || arc.letter,
      'o': w.s.o || ins.said || CASE arc.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || g.role || ':' || g.text
                                ELSE chr(10) || CASE WHEN arc.q2 = 2 THEN 'user:' ELSE 'assistant:' END || g.text END})
  FROM way w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.i = w.i + 1 JOIN ins ON ins.q = w.q
  JOIN arc ON arc.q = ins.q2 AND (arc.x IS NULL OR arc.x = g.x) AND (arc.letter = 'D' OR g.fault IN ('', 't'))
  GROUP BY w.conv_id, g.i, arc.q2),
b AS (SELECT w.conv_id, min({'c': w.s.c + ins.cost, 'a': w.s.a || ins.letters, 'o': w.s.o || ins.said}) AS s
      FROM way w JOIN (SELECT DISTINCT conv_id, n FROM g) m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.i
      JOIN ins ON ins.q = w.q AND ins.q2 IN (0, 3) GROUP BY w.conv_id),
t AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
             count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM g GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.s.c, 0) AS cost,
       coalesce(b.s.a, '') AS audit, sha256(coalesce(substr(b.s.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""
