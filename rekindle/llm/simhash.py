"""SimHash near-dedup by multi-index hashing.

A text's fingerprint has bit b set where over half of its word shingles (repeats
counted) have bit b set in their 64-bit hash.  Fingerprints that differ in at most
``distance`` bits are linked.

1. One row goes on per distinct fingerprint.  It is cut into ``segments`` pieces.
   By the pigeonhole principle two linked fingerprints agree in some piece up to a
   radius (``radii``), so each piece's table is asked for all values in the small
   Hamming ball around the fingerprint's own piece, and every table match is
   verified by the complete distance.
2. A table entry (piece, value) with more than ``CROWD`` fingerprints would give
   the square of its size in matches.  Its fingerprints and all that ask for it
   are linked by their complete ball instead: two fingerprints are at most
   ``distance`` apart exactly if the ball of half that radius around one meets the
   other's.  Each point's fingerprints (65 at most for distance 2) are linked to
   its smallest one, so that work stays linear however dense the crowd is.
3. Components of the links give every fingerprint its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rekindle.llm import words as W
from rekindle.llm.common import small_batches, spread_join, written
from rekindle.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints that one table entry yields matches for; fuller ones go by complete balls.
CROWD = 32
#: Bytes of a text that are cut into words at a time.
BLOCK = 1 << 18
SPACE = b" \t\n\x0b\x0c\r"


def word_blocks(text: bytes, most: int = BLOCK) -> Iterator[list[bytes]]:
    """The lower-cased (A-Z) words of a text, some at a time."""
    a = 0
    while a < len(text):
        b = a + most
        while b < len(text) and text[b] not in SPACE:
            b += 1
        yield text[a:b].lower().split()
        a = b


def shingle_hashes(text: bytes, width: int) -> Iterator[list[int]]:
    """XXH64 of all runs of ``width`` words joined by spaces (fewer words: of all of them), some at a time."""
    tail: list[bytes] = []
    some = False
    digest = xxhash.xxh64_intdigest
    for block in word_blocks(text):
        w = tail + block
        if len(w) >= width:
            some = True
            yield [digest(b" ".join(w[i:i + width]), SEED) for i in range(len(w) - width + 1)]
            tail = w[len(w) - width + 1:] if width > 1 else []
        else:
            tail = w
    if tail and not some:
        yield [digest(b" ".join(tail), SEED)]


def fingerprint(text: bytes, width: int) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, width):
        h = np.array(hashes, np.uint64)
        for a in range(0, len(h), 1 << 14):
            bits = np.unpackbits(h[a:a + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, BITS)
            ones += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_of(width: int):
    """Arrow UDF: text -> fingerprint as a signed bigint; NULL counts as a text without words, which gives 0."""
    @arrow_udf(T.LongType())
    @W.trimmed
    def run(texts: pa.Array) -> pa.Array:
        buf, offs = W.raw(texts)
        found = [fingerprint(buf[a:b].tobytes(), width) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        return pa.array(np.array(found, np.uint64).view(np.int64))
    return run


def pieces(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the pieces that a fingerprint is cut into."""
    at = [BITS * s // segments for s in range(segments + 1)]
    return [(a, b - a) for a, b in zip(at[:-1], at[1:], strict=True)]


def radii(segments: int, distance: int) -> list[int]:
    """Radius within which some piece of two linked fingerprints agrees (-1: the piece need not be asked)."""
    each, more = divmod(distance, segments)
    return [each if s <= more else each - 1 for s in range(segments)]


def masks(width: int, radius: int) -> list[int]:
    """All values of ``width`` bits with at most ``radius`` bits set, as signed 64-bit numbers."""
    found = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def ball(value: Column, width: int, radius: int) -> Column:
    return F.transform(F.array(*[F.lit(m) for m in masks(width, radius)]), lambda m: value.bitwiseXOR(m))


def piece(fp: Column, low: int, width: int) -> Column:
    cut = F.shiftrightunsigned(fp, low)
    return cut if width == BITS else cut.bitwiseAND((1 << width) - 1)


def apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(classes: DataFrame, *, distance: int = 2, segments: int = 2, crowd: int = CROWD) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``fp`` of ``classes``.

    Their components are those of "at most ``distance`` bits apart"; every pair
    returned is a link, but not every link within a crowd is returned.
    """
    if not 0 <= distance <= 8 or not 1 <= segments <= BITS:
        raise ValueError("distance 0 to 8, segments 1 to 64")
    fp = F.col("fp")
    cut = [(s, low, w, r) for s, ((low, w), r) in enumerate(zip(pieces(segments), radii(segments, distance), strict=True))
           if r >= 0]

    def around(value: Column) -> Column:
        """The values in the ball around a table's ``value``, by the piece ``s`` it belongs to."""
        out = None
        for s, _, w, r in cut:
            here = ball(value, w, r)
            out = F.when(F.col("s") == s, here) if out is None else out.when(F.col("s") == s, here)
        return out

    entries = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), piece(fp, low, w).alias("value")) for s, low, w, _ in cut])).alias("e")).select("fp", "e.*")
    full = written(entries.groupBy("s", "value").agg(F.count("*").alias("n")).filter(F.col("n") > crowd), "simhash-full")
    marked = spread_join(entries, full.withColumn("full", F.lit(True)), ["s", "value"], "n")
    lists = written(marked.filter("full is null").groupBy("s", "value").agg(F.sort_array(F.collect_list("fp")).alias("of")),
                    "simhash-lists")  # crowd at most in each
    both = lambda f: F.flatten(F.transform("of", lambda x, i: F.transform(
        F.filter(f(i), lambda y: apart(x, y) <= distance), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    own = lists.filter(F.size("of") > 1).select(F.explode(both(lambda i: F.slice("of", i + 2, crowd))).alias("p"))
    # each two entries meet once: the lower one asks
    asked = (lists.select("s", F.col("value").alias("from"), "of", F.explode(around(F.col("value"))).alias("value"))
             .filter(F.col("value") > F.col("from")).drop("from"))
    met = asked.join(lists.withColumnRenamed("of", "others"), ["s", "value"]).select(
        F.explode(both(lambda i: F.col("others"))).alias("p"))
    near = own.unionByName(met).select("p.*")

    # all who are in a full entry or ask for one
    near_full = full.select("s", F.explode(around(F.col("value"))).alias("value")).distinct()
    crowded = (marked.filter("full").select("fp")
               .union(lists.join(near_full, ["s", "value"], "left_semi").select(F.explode("of"))).distinct())
    half = distance // 2
    # a point's table: fingerprints within half the distance; those within the rest of it ask
    points = crowded.select("fp", F.explode(ball(fp, BITS, half)).alias("point"))
    hubs = points.groupBy("point").agg(F.min("fp").alias("hub"))
    ask = points if distance % 2 == 0 else crowded.select("fp", F.explode(ball(fp, BITS, distance - half)).alias("point"))
    star = (ask.join(hubs, "point").filter(F.col("fp") != F.col("hub"))
            .select(F.col("fp").alias("x"), F.col("hub").alias("y")))
    return (near.unionByName(star).select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())


def near_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    distance: int = 2, segments: int = 2) -> DataFrame:
    """doc_id, fp (bigint), class_size, component_id for every row: components of "fingerprints within ``distance`` bits".

    component_id: smallest id reachable over links, itself included; class_size:
    the number of rows with the same fingerprint.

    Defined cases: a text that is NULL, empty or without words has fingerprint 0
    and is linked like any other; a text of fewer words than ``width`` has its
    whole sequence as one shingle; a bit set in exactly half of the shingles is 0;
    rows repeated in full or ids with several texts are rows of their own; a NULL
    id is never a component's name unless there is no other; texts of any length
    are read whole, in blocks; an empty table gives an empty result; other
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    signed = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint_of(width)(F.col(text_col)).alias("fp")),
                     "simhash-signed")
    classes = written(signed.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("class_size")),
                      "simhash-classes")
    linked = components(links(classes, distance=distance, segments=segments), "simhash-links")
    # classes that stand alone name themselves; only the linked ones are renamed
    both = linked.union(linked.select(F.col("root").alias("node"), "root").distinct())
    named = both.join(classes, F.col("node") == F.col("fp")).select("fp", "root", "rep")
    roots = named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    renamed = spread_join(named.select("fp", "root"), roots, ["root"], "n").select("fp", "component_id")
    of_class = classes.join(renamed, "fp", "left").select(
        "fp", "class_size", F.coalesce("component_id", "rep").alias("component_id"), F.col("class_size").alias("n"))
    return spread_join(signed, of_class, ["fp"], "n").select("doc_id", "fp", "class_size", "component_id")


def op11_query(docs: DataFrame) -> DataFrame:
    return near_components(docs, width=3, distance=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_size")
