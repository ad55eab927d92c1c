"""Document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer (K bytes of UTF-8) is a closed syncmer when the smallest of its inner
s-mers, by hash, is the first or the last of them.  Whether a k-mer is chosen
depends on its own bytes alone, so the anchors of an unchanged stretch stay the
same whatever stands around it, and keep their distances.

* ``anchors``: all closed syncmers of the whole text, each packed into one long
  (31 bits of hash, then 32 bits of byte position), in text order.
* ``sketch``: the SKETCH smallest distinct anchor hashes, each with its first
  position; a fixed-size sample of the whole text's anchors.
* ``render``: the sketch as a string ``hash@position`` (hexadecimal), by hash.
* ``likeness``: Dice coefficient estimated from two sketches; ``in_place``: the
  number of common anchors at the most frequent distance between their positions
  in the two texts (0 where nothing was put in or taken out before them).

A text shorter than K bytes has one anchor, the hash of all its bytes; NULL or
empty text has none (fingerprint '').
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, S = 12, 5
INNER = K - S + 1
SKETCH = 64
BLOCK = 1 << 16
_BIG = 2**31 - 1


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once (a lambda variable is not inlined)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _packed(hash64: Column, pos: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hash64, 33), 32) + pos


def _block_anchors(b: Column, start: Column) -> Column:
    """b: binary of K bytes or more, ``start`` bytes behind the place from which positions count."""
    inner = F.transform(F.sequence(F.lit(1), F.length(b) - (S - 1)), lambda i: F.xxhash64(F.substring(b, i, S)))

    def chosen(h: Column) -> Column:
        def edge(i: Column) -> Column:
            # the smaller end against the hashes between, one by one: most k-mers fail at one of the first
            at = [F.get(h, i + j if j else i) for j in range(INNER)]
            below = lambda end: reduce(and_, [end <= x for x in at[1:-1]])
            return F.call_function("if", at[0] <= at[-1], below(at[0]), below(at[-1]))
        return F.filter(F.sequence(F.lit(0), F.length(b) - K), edge)
    return F.transform(bind(inner, chosen), lambda p: _packed(F.xxhash64(F.substring(b, p + 1, K)), p + start))


def _long_anchors(b: Column) -> Column:
    """b: binary of K bytes or more, read in blocks of starts so that a long text needs little at a time."""
    def block(s: Column) -> Column:
        return bind(F.substring(b, s + 1, F.lit(BLOCK + K - 1)), lambda part: _block_anchors(part, s))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.length(b) - K, F.lit(BLOCK)), block))


def anchors(data: Column) -> Column:
    """array<bigint> of a binary column's anchors."""
    none = F.array().cast("array<bigint>")
    return bind(data, lambda b: F.when(F.length(b) >= K, _long_anchors(b))
                .when(F.length(b) > 0, F.array(_packed(F.xxhash64(b), F.lit(0)))).otherwise(none))


def text_bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def first_anchors(all_anchors: Column) -> Column:
    """Each distinct hash with its first position, by hash."""
    def first_of_each(s: Column) -> Column:
        hashed = lambda x: F.shiftright(x, 32)
        return F.filter(s, lambda x, i: (i == 0) | (hashed(x) != hashed(F.get(s, i - 1))))
    return bind(F.sort_array(all_anchors), first_of_each)


def sketch(all_anchors: Column) -> Column:
    """The SKETCH smallest distinct hashes with their first positions."""
    return F.slice(first_anchors(all_anchors), 1, SKETCH)


def spliced_sketch(own: Column, data: Column, cut: Column, next_own: Column, new_tail: Column) -> Column:
    """Sketch of ``data[:cut] + new_tail``, where ``new_tail`` is how the next text begins, from both texts' ``first_anchors``.

    Anchors are context-free: those that end before the cut, or in the next text
    before the new tail's end, are kept.  Only k-mers across the cut are read.
    Of a part's distinct hashes no more than the SKETCH smallest can be among
    the SKETCH smallest of all, and the parts are in text order.
    """
    def within(found: Column, length: Column) -> Column:
        return bind(length - K, lambda last: F.slice(
            F.filter(found, lambda a: a.bitwiseAND(F.lit(0xFFFFFFFF)) <= last), 1, SKETCH))

    def parts(at: Column) -> Column:
        from_ = F.greatest(at - (K - 1), F.lit(0))
        joint = F.concat(F.substring(data, F.lit(1) + from_, at - from_), F.substring(new_tail, F.lit(1), F.lit(K - 1)))
        across = bind(joint, lambda b: F.when(F.length(b) >= K, _block_anchors(b, from_))
                      .otherwise(F.array().cast("array<bigint>")))
        return F.concat(within(own, at), across, F.transform(within(next_own, F.length(new_tail)), lambda a: a + at))
    return sketch(F.when(F.length(new_tail) + cut < K, anchors(F.concat(F.substring(data, F.lit(1), cut), new_tail)))
                  .otherwise(bind(cut, parts)))


def hashes(sk: Column) -> Column:
    return F.transform(sk, lambda x: F.shiftright(x, 32))


def render(sk: Column) -> Column:
    return F.lower(F.array_join(F.transform(sk, lambda x: F.concat(
        F.lpad(F.hex(F.shiftright(x, 32)), 8, "0"), F.lit("@"), F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))))), " "))


def parse(fingerprint: Column) -> Column:
    """The sketch of a rendered fingerprint."""
    entry = lambda e: (F.shiftleft(F.conv(F.substring(e, 1, 8), 16, 10).cast("bigint"), 32)
                       + F.conv(F.substring(e, 10, 8), 16, 10).cast("bigint"))
    return F.when(F.length(fingerprint) > 0, F.transform(F.split(fingerprint, " "), entry)) \
        .otherwise(F.array().cast("array<bigint>"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two sketches: Jaccard on the smallest hashes of the union, as Dice; two empty sketches: 1."""
    def dice(j: Column) -> Column:
        return 2 * j / (1 + j)

    def jaccard(u: Column, x: Column, y: Column) -> Column:
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(u, x), y)) / F.size(u))
    return bind(hashes(a), lambda x: bind(hashes(b), lambda y: bind(
        F.slice(F.sort_array(F.array_union(x, y)), 1, SKETCH), lambda u: bind(jaccard(u, x, y), dice))))


def in_place(a: Column, b: Column) -> Column:
    """Common anchors at the most frequent offset (in bytes) between two sketches."""
    position = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))
    none = F.struct(F.lit(None).cast("bigint").alias("at"), F.lit(0).alias("n"), F.lit(0).alias("most"))

    def offsets(x: Column, y: Column) -> Column:
        there = F.map_from_arrays(hashes(y), F.transform(y, position))
        return bind(there, lambda m: F.transform(
            F.filter(x, lambda e: F.map_contains_key(m, F.shiftright(e, 32))),
            lambda e: F.element_at(m, F.shiftright(e, 32)) - position(e)))

    def count(s: Column, d: Column) -> Column:
        n = F.when(s["at"] == d, s["n"] + 1).otherwise(1)
        return F.struct(d.alias("at"), n.alias("n"), F.greatest(s["most"], n).alias("most"))
    return F.aggregate(F.sort_array(bind(a, lambda x: bind(b, lambda y: offsets(x, y)))), none, count,
                       lambda s: s["most"].cast("long"))


def fingerprint(docs: DataFrame, *, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` plus the rendered fingerprint of the whole text."""
    return docs.withColumn(out_col, render(sketch(anchors(text_bytes(F.col(text_col))))))


def _range_of(key: Column, bounds: list) -> Column:
    """Number of bounds at or below the key, by binary search over the sorted literal array."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << j for j in reversed(range(len(bounds).bit_length()))]

    def descend(at: Column, step: Column) -> Column:
        to = at + step
        return F.when((to <= len(bounds)) & (F.get(table, F.least(to, F.lit(len(bounds))) - 1) <= key), to).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), descend)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, edge, rng) ranged by id so that the next row in id order is the next row of the range.

    Ranges are cut at about sqrt(rows) quantiles of the id (from a mergeable
    summary of the id column; that many numbers reach the driver).  The last row
    of a range is followed by a copy of the next range's first document, marked
    ``edge``; the last document of all is followed by the first.  The text moves
    once.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = docs.count()
    ranges = max(1, int(n ** 0.5))
    bounds = docs.agg(F.percentile_approx(id_col, [j / ranges for j in range(1, ranges)] or [0.5], 8 * ranges)
                      .alias("b")).first()["b"] or []
    bounds = sorted(set(bounds)) if ranges > 1 else []
    ranged = rows.withColumn("rng", _range_of(F.col("id"), bounds)).withColumn("edge", F.lit(False))
    # first document of each range: smallest id first, then its smallest text (ids may repeat);
    # sqrt(rows) ids, so they are broadcast
    least = ranged.groupBy("rng").agg(F.min(F.struct("id")).alias("m")).select(F.col("m.id").alias("m_id"))
    firsts = (ranged.join(F.broadcast(least), F.col("id").eqNullSafe(F.col("m_id")), "left_semi")
              .groupBy("rng").agg(F.min(F.struct("id", "text")).alias("f")))
    order = Window.orderBy("rng")  # one row per range
    following = F.coalesce(F.lag("rng").over(order),
                           F.max("rng").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = firsts.select("f.id", "f.text", following.alias("rng"), F.lit(True).alias("edge"))
    return ranged.select("id", "text", "rng", "edge").unionByName(edges)


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with their likeness.

    Edited text: the last floor(n/4) code points replaced by the first as many
    (or all) of the next document in id order; after the last comes the first.

    Defined cases: NULL text is empty; a text under four code points is not
    changed; NULL ids come first; rows with equal ids go by their text; a single
    row is its own next document; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = with_next(docs, id_col, text_col)
    order = Window.partitionBy("rng").orderBy("edge", F.col("id").asc_nulls_first(), "text")
    # the first window moves the bare texts; anchors are made behind it, and the second finds its order in place
    rows = rows.withColumn("next_text", F.lead("text").over(order))
    rows = rows.withColumn("own", first_anchors(anchors(F.col("text").cast("binary"))))
    rows = rows.withColumn("next_own", F.lead("own").over(order)).filter(~F.col("edge"))
    n = F.length("text")
    m = F.floor(n / 4).cast("int")
    rows = (rows.withColumn("n_chars", n.cast("long"))
            .withColumn("head", F.substring(F.col("text"), F.lit(1), n - m))
            .withColumn("tail", F.substring(F.col("next_text"), F.lit(1), m)))
    new = spliced_sketch(F.col("own"), F.col("text").cast("binary"), F.octet_length("head"),
                         F.col("next_own"), F.col("tail").cast("binary"))
    return (rows.withColumn("new_sk", new)
            .withColumn("sk", F.slice("own", 1, SKETCH)).withColumn("next_sk", F.slice("next_own", 1, SKETCH))
            .select(F.col("id").alias("doc_id"), "n_chars",
                    F.sha2(F.concat("head", "tail").cast("binary"), 256).alias("edited_sha256"),
                    render(F.col("sk")).alias("fingerprint"), render(F.col("new_sk")).alias("edited_fingerprint"),
                    likeness(F.col("sk"), F.col("new_sk")).alias("near_edited"),
                    likeness(F.col("sk"), F.col("next_sk")).alias("near_next"),
                    in_place(F.col("sk"), F.col("new_sk")).alias("anchors_in_place")))


def op1_query(docs: DataFrame) -> DataFrame:
    return edited_fingerprints(docs)
