"""Periodic runs of words, found in tiles whose length grows with the period.

A run is a stretch of consecutive words with smallest period q, at least
``COPIES`` periods and ``LEAST`` words long, that no neighbouring word extends.  In
other words: a stretch of places i with word(i) = word(i + q), of length
(COPIES - 1) q at least, whose q first words are no power of a shorter sequence.

1. Periods P to 2P - 1 (P a power of two) are an octave.  A document is exploded
   into tiles of 16 P words, 5 P of them shared with the next tile; all octaves
   whose tiles would be shorter than ``TILE`` words share one scale of tiles, and a
   tile that holds the whole document takes all octaves that are left.  A document
   of up to ``TILE`` words is one tile.
2. Each tile is solved by itself.  Every P words lies a boundary b; the Z-function
   there, z(q) = how far the words from b agree with those from b + q, is at least
   2 P at the first boundary of each run.  Hashes of 2 P words tell for which q of
   the octave it can be; there z is evaluated on the words, forwards and backwards,
   up to the tile's edges.  Periods whose first q words are a power are left out by
   the same hashes (any q words of a stretch decide that for all of it).
3. Tiles of long documents give fragments, shuffled by document and period and
   stitched where they touch.  Two tiles share enough words that each place of a
   run lies in a fragment of one of them, and fragments of one run touch.

Exact, but for a collision of 64-bit hashes within a document in the test for powers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from rekindle.llm import words as W
from rekindle.llm.common import small_batches, written

#: Words in the smallest tile (a power of two, 16 at least).
TILE = 4096
COPIES = 4
LEAST = 6
_ALL = 62

_RUN = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))
_FRAGMENT = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("q", "i", "j")]))
_TILES = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("n", "start", "first", "last")]
                                  + [T.StructField("codes", T.BinaryType())]))


def word_codes(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def tiles(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """(start, stop, first octave, last octave) of the tiles of ``n`` words."""
    if tile < 16 or tile & (tile - 1):
        raise ValueError("tile: a power of two, 16 at least")
    first, last = 0, tile.bit_length() - 5
    while n > tile:
        for start in range(0, n, tile - (5 << last)):
            yield start, min(n, start + tile), first, last
            if start + tile >= n:
                break
        tile, first, last = 2 * tile, last + 1, last + 1
        if 1 << first > n // COPIES:
            return
    yield 0, n, first, _ALL


def agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many elements two arrays have in common at their start."""
    n, k, step = min(len(x), len(y)), 0, 64
    while k < n:
        d = np.flatnonzero(x[k:min(n, k + step)] != y[k:min(n, k + step)])
        if len(d):
            return k + int(d[0])
        k, step = k + step, 4 * step
    return n


_LEAST_FACTOR = np.array([0, 1, 2, 3], np.int32)


def least_factors(n: int) -> np.ndarray:
    """The smallest prime factor of every number up to ``n`` at least."""
    global _LEAST_FACTOR
    if len(_LEAST_FACTOR) <= n:
        f = np.arange(2 * n + 1, dtype=np.int32)
        for p in range(2, int((2 * n) ** 0.5) + 1):
            if f[p] == p:
                part = f[p * p::p]
                part[part == np.arange(p * p, 2 * n + 1, p)] = p
        _LEAST_FACTOR = f
    return _LEAST_FACTOR


def primitive(h: np.ndarray, b: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the q words from b are no power; ``h`` hashes twice the octave's words, and b agrees with b + q for as long."""
    ok, x = np.ones(len(b), bool), q.copy()
    factor = least_factors(int(q.max())) if len(q) else None
    while (x > 1).any():
        r = np.maximum(factor[x], 1)
        d = q // r
        ok &= (r == 1) | (h[b] != h[b + d])
        x = x // r
    return ok


def fragments(c: np.ndarray, first: int, last: int, most: int) -> list[tuple[int, int, int]]:
    """(q, i, j): places i to j - 1 of a tile agree with those q on, for the octaves' primitive q up to ``most``."""
    m, found = len(c), []
    h, octave = W.mix64(c.astype(np.uint64) + W._P), 0
    while octave <= last and 1 << octave <= most and m >= 3 << octave:
        p = 1 << octave
        h = W.mix64(h[:-p] * W._P + h[p:])  # of 2 p words
        if octave >= first:
            at = np.arange(0, len(h) - p, p)
            padded = np.concatenate([h, np.zeros(2 * p, np.uint64)])
            hit = np.lib.stride_tricks.sliding_window_view(padded[p:], p)[::p][:len(at)] == h[at][:, None]
            k, off = np.nonzero(hit)
            b, q = at[k], p + off
            there = (b + q < len(h)) & (q <= most)
            b, q = b[there], q[there]
            if len(b):
                ok = primitive(h, b, q)
                b, q = b[ok], q[ok]
                order = np.lexsort((b, q))
                done = (0, 0)
                for x, y in zip(q[order].tolist(), b[order].tolist(), strict=True):
                    if x == done[0] and y < done[1]:
                        continue  # in the stretch just found
                    z = agree(c[y:], c[y + x:])
                    if z < 2 * p:
                        continue
                    found.append((x, y - agree(c[:y][::-1], c[:y + x][::-1]), y + z))
                    done = (x, y + z)
        octave += 1
    return found


def long_enough(q, i, j):
    """Whether the places i to j - 1 that agree with those q on make a run."""
    return (j - i >= (COPIES - 1) * q) & (j - i + q >= LEAST)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside all runs or in a run's first period, joined by blanks."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words)


def _each(texts: pa.Array) -> Iterator[list[bytes]]:
    buf, offs = W.raw(texts)
    for a, b in zip(offs[:-1], offs[1:], strict=True):
        yield buf[a:b].tobytes().split()


def _triples(rows: list[list[tuple[int, int, int]]], names: list[str]) -> pa.Array:
    flat = np.array([t for r in rows for t in r], np.int64).reshape(-1, 3)
    offs = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names))


@arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", _RUN),
                         T.StructField("collapsed", T.StringType())]))
@W.trimmed
def one_tile(texts: pa.Array) -> pa.Array:
    """Texts that are one tile: their fragments are whole."""
    n, runs, rest = [], [], []
    for words in _each(texts):
        n.append(len(words))
        own = fragments(word_codes(words), 0, _ALL, len(words) // COPIES)
        runs.append(sorted(((i, j - i + q, q) for q, i, j in own if long_enough(q, i, j)), key=lambda r: (r[0], r[2])))
        rest.append(collapse(words, runs[-1]).decode())
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), _triples(runs, ["start", "length", "period"]),
                                       pa.array(rest, pa.string())], ["n_words", "runs", "collapsed"])


def tiles_of(tile: int):
    """Arrow UDF: text -> its tiles, with the words as codes that are equal for equal words of the text."""
    @arrow_udf(_TILES)
    @W.trimmed
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for words in _each(texts):
            c = word_codes(words)
            out.append([{"n": len(c), "start": a, "first": lo, "last": hi, "codes": c[a:b].tobytes()}
                        for a, b, lo, hi in tiles(len(c), tile)])
        return pa.array(out, pa.list_(pa.struct([(x, pa.int64()) for x in ("n", "start", "first", "last")]
                                                + [("codes", pa.binary())])))
    return run


@arrow_udf(_FRAGMENT)
@W.trimmed
def solve(n: pa.Array, start: pa.Array, first: pa.Array, last: pa.Array, codes: pa.Array) -> pa.Array:
    """The fragments of every tile, at their places in the document."""
    out = []
    for most, at, lo, hi, c in zip(n.to_pylist(), start.to_pylist(), first.to_pylist(), last.to_pylist(), codes, strict=True):
        own = fragments(np.frombuffer(c.as_buffer(), np.int32), lo, hi, most // COPIES)
        out.append([(q, at + i, at + j) for q, i, j in own])
    return _triples(out, ["q", "i", "j"])


@arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("collapsed", T.StringType())]))
@W.trimmed
def without_repeats(texts: pa.Array, runs: pa.Array) -> pa.Array:
    n, rest = [], []
    for words, own in zip(_each(texts), runs.to_pylist(), strict=True):
        n.append(len(words))
        rest.append(collapse(words, [(r["start"], r["length"], r["period"]) for r in own or []]).decode())
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(rest, pa.string())], ["n_words", "collapsed"])


def stitch(found: DataFrame, keys: list[str]) -> DataFrame:
    """Fragments (keys, q, i, j) that touch, as one (keys, q, i, j)."""
    order = Window.partitionBy(*keys, "q").orderBy("i", "j")
    reach = F.max("j").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("i") > reach), 1).otherwise(0)
    return (found.withColumn("new", new).withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*keys, "q", "part").agg(F.min("i").alias("i"), F.max("j").alias("j")).drop("part"))


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period), collapsed for every row.

    Words are what stands between ASCII white space, numbered from 0; ``collapsed``
    are the words that no run contains after its first period, joined by blanks.

    Texts of up to 2 * ``tile`` bytes are one tile and stay where they are; tiles of
    longer ones are dealt out, and their fragments are stitched.

    Defined cases: NULL and empty texts have no words, no run and an empty
    ``collapsed``; rows repeated in full, or ids with several texts, are rows of
    their own; NULL ids stay; an empty table gives an empty result; texts of any
    length are read whole; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    is_long = F.octet_length("text") > 2 * tile
    short = base.filter(~is_long).withColumn("r", one_tile(F.col("text"))).select("doc_id", "r.*")

    long_ = written(base.filter(is_long).withColumn("row", F.monotonically_increasing_id()), "periodic-long")
    dealt = (long_.select("row", F.explode(tiles_of(tile)(F.col("text"))).alias("t")).select("row", "t.*")
             .repartition("row", "first", "start"))
    found = dealt.select("row", F.explode(solve("n", "start", "first", "last", "codes")).alias("f")).select("row", "f.*")
    whole = stitch(found, ["row"]).filter(long_enough(F.col("q"), F.col("i"), F.col("j")))
    run = F.struct(F.col("i").alias("start"), F.col("q").alias("period"), (F.col("j") - F.col("i") + F.col("q")).alias("length"))
    runs = whole.groupBy("row").agg(F.sort_array(F.collect_list(run)).alias("runs"))  # of one text
    runs = runs.withColumn("runs", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])))
    runs = written(runs, "periodic-runs")
    far = (long_.join(runs, "row", "left").withColumn("runs", F.coalesce("runs", F.array().cast(_RUN)))
           .withColumn("r", without_repeats(F.col("text"), F.col("runs")))
           .select("doc_id", "r.n_words", "runs", "r.collapsed"))
    return short.unionByName(far)


@arrow_udf(T.StringType())
@W.trimmed
def repeat_tail(texts: pa.Array, g: pa.Array) -> pa.Array:
    """From word g % n on, the text's first 1 + (n - a) // (3 + g % 8) words are repeated to its end."""
    out = []
    for words, x, text in zip(_each(texts), g.to_pylist(), texts, strict=True):
        n = len(words)
        if x is None or n == 0:
            out.append(text.as_py())
            continue
        a = x % n
        p = 1 + (n - a) // (3 + x % 8)
        out.append(b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode())
    return pa.array(out, pa.string())


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the decimal id is divisible by 10, the text's end is made periodic (NULL ids: never)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = F.coalesce(h % 10 == 0, F.lit(False))
    # the tenth that is changed is computed once: its Python workers do not run beside those that find runs
    planted = docs.filter(some).select("doc_id", repeat_tail(F.col("text"), F.floor(h / 10)).alias("text"))
    return docs.filter(~some).select("doc_id", "text").unionByName(written(planted, "periodic-planted"))


def mark(run: Column) -> Column:
    return F.concat(run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","),
                    run["period"].cast("string"), F.lit("\n"))


def op13_query(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    found = find_runs(with_planted_runs(docs))
    best = F.get(F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"),
                                                                    r["period"].alias("p")))), F.lit(0))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
                    (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
                    F.floor(-F.col("best.l") * 1000 / F.col("best.p")).cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform("runs", mark), "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words"))
