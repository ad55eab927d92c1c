"""Rank correlation of columns with missing values, and pruning by it.

Every pair of columns is correlated over the rows that have both, with ranks
taken among just those rows.  Ranks of a column are the same for all partners
that are present in the same rows, so a column is ranked once per kind of
partner, not once per pair:

1. rows are counted by which columns they have (partial aggregation); the counts
   of rows with both columns, a number a pair, tell which columns are present in
   the same rows;
2. a *rank set* is a column together with one such kind of partner.  Rows are taken
   in blocks; a block tells, per column and range of values, its distinct values and
   how many of its rows each of a column's sets has there;
3. the blocks' values of one column and range meet, and every block gets back the
   ranks of its own distinct values in all the column's sets: what is exchanged is a
   value a cell and, packed, the steps between a block's ranks, never a row a cell
   and set;
4. the rows of a block meet their ranks, and each block adds up products of centred
   ranks, one number a pair.

The bounds of the ranges come from a sample, as those of Spark's range partitioning
do: they decide which task ranks a value, not its rank.  The driver sees numbers per
pair of columns, and per column, range and set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quality import approximate_quantiles

#: Rows of a block: a power of two, so that rows numbered in sequence fall into blocks by a shift.
BLOCK_BITS = 14
#: Rows whose values of a column meet in one task, about, and rows of the sample that tell the bounds of one such range.
RANGE_ROWS = 1 << 18
SAMPLE_ROWS = 1 << 8


def _number(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _both_present(x: DataFrame, d: int) -> dict[tuple[int, int], int]:
    """Rows that have both columns, per pair (i <= j); ``x`` has the values as c0, c1, ..."""
    has = F.array_compact(F.array(*[F.when(F.col(f"c{i}").isNotNull(), F.lit(i)) for i in range(d)]))
    kinds = x.groupBy(has.alias("has")).agg(F.count(F.lit(1)).alias("n"))
    pairs = (kinds.select("n", "has", F.explode("has").alias("i")).select("n", "i", F.explode("has").alias("j"))
             .filter("i <= j").groupBy("i", "j").agg(F.sum("n").alias("n")))
    return {(r["i"], r["j"]): r["n"] for r in pairs.collect()}  # a number a pair of columns


def _pack(steps: np.ndarray) -> bytes:
    """Non-negative whole numbers in as few bytes as the largest needs; the first byte is that size."""
    kind = np.min_scalar_type(int(steps.max(initial=0)))
    return bytes([kind.itemsize]) + steps.astype(kind).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", offset=1).astype(np.int64)


def _cells(table: pa.Table, d: int) -> np.ndarray:
    """The values of the columns c0, c1, ..., missing ones as NaN."""
    return np.stack([table.column(f"c{i}").combine_chunks().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
                     for i in range(d)], 1) if d else np.zeros((table.num_rows, 0))


SUMMARY = "part long, i int, g int, v array<double>, n binary, t array<long>"


def _summary(d: int, partners: dict[int, list[int | None]], bounds: list[list[float]]):
    """A block's distinct values per column and range, and the rows of every rank set of the column that hold them."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = _cells(table, d)
        has = ~np.isnan(x)
        rows = []
        for i, kinds in partners.items():
            mine = has[:, i]
            v, at = np.unique(x[mine, i], return_inverse=True)
            n = np.stack([np.bincount(at if k is None else at[has[mine, k]], minlength=len(v)) for k in kinds])
            ends = np.searchsorted(v, bounds[i], "right").tolist()  # a bound belongs to the range below it
            for g, (lo, hi) in enumerate(zip([0, *ends], [*ends, len(v)], strict=True)):
                if lo < hi:
                    part = n[:, lo:hi]
                    rows.append((i, g, v[lo:hi], _pack(part), part.sum(1)))
        i, g, v, n, t = zip(*rows, strict=True) if rows else ((),) * 5
        return pa.table({"part": pa.array([key[0].as_py()] * len(rows), pa.int64()), "i": pa.array(i, pa.int32()),
                         "g": pa.array(g, pa.int32()), "v": pa.array(v, pa.list_(pa.float64())),
                         "n": pa.array(n, pa.binary()), "t": pa.array(t, pa.list_(pa.int64()))})
    return run


RANKS = "part long, i int, g int, v array<double>, r binary"


def _ranked(table: pa.Table) -> pa.Table:
    """Blocks' values of one column and range -> per block, the steps between twice its values' mean ranks in the range, less one."""
    vs = [np.asarray(v) for v in table.column("v").to_numpy()]
    v, at = np.unique(np.concatenate(vs), return_inverse=True)
    ns = [_unpack(n.as_py()).reshape(-1, len(x)) for n, x in zip(table.column("n"), vs, strict=True)]
    cnt = np.stack([np.bincount(at, np.concatenate(c), len(v)) for c in zip(*ns, strict=True)]).astype(np.int64)
    twice = 2 * np.cumsum(cnt, 1) - cnt
    ends = np.cumsum([0, *map(len, vs)])
    packed = [_pack(np.diff(twice[:, at[lo:hi]], axis=1, prepend=0)) for lo, hi in zip(ends, ends[1:])]
    return table.select(["part", "i", "g", "v"]).append_column("r", pa.array(packed, pa.binary()))


def _gram(d: int, sets: dict[tuple[int, int | None], int], below: dict, left: list[int], right: list[int]):
    """Per block: sums of products of the centred ranks of sets left[p] and right[p], and of their squares.

    ``below[i, g]``: per set of column i, twice the rows in lower ranges, less all of the set's."""
    numbers: dict[int, list[tuple[int, int | None]]] = {}
    for (i, k), s in sets.items():
        numbers.setdefault(i, []).append((s, k))

    def run(rows: pa.Table, ranks: pa.Table) -> pa.Table:
        x = _cells(rows, d)
        has = ~np.isnan(x)
        block = np.zeros((len(x), len(sets)))
        for i, g, v, r in zip(*[ranks.column(c).to_pylist() if c in "ig" else ranks.column(c) for c in "igvr"], strict=True):
            v = v.values.to_numpy(zero_copy_only=False)
            twice = np.cumsum(_unpack(r.as_py()).reshape(-1, len(v)), 1) + below[i, g][:, None]
            mine = np.flatnonzero((x[:, i] >= v[0]) & (x[:, i] <= v[-1]))
            at = np.searchsorted(v, x[mine, i])
            for (s, k), of in zip(numbers[i], twice, strict=True):
                block[mine, s] = of[at] / 2 if k is None else np.where(has[mine, k], of[at] / 2, 0.0)
        total = block.T @ block
        return pa.table({"p": pa.array(range(len(left)), pa.int32()), "ab": total[left, right],
                         "aa": total[left, left], "bb": total[right, right]})
    return run


def _bounds(x: DataFrame, d: int, n: int) -> list[list[float]]:
    """Per column, the bounds of the ranges in which its values are ranked."""
    ranges = -(-n // RANGE_ROWS)
    if ranges < 2:
        return [[] for _ in range(d)]
    some = x.sample(min(1.0, SAMPLE_ROWS * ranges / n), 1)
    found = approximate_quantiles(some, {f"c{i}": [k / ranges for k in range(1, ranges)] for i in range(d)}, 1000).collect()
    return [sorted({r["value"] for r in found if r["feature"] == f"c{i}"}) for i in range(d)]


def spearman(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rank correlation of every pair of columns over the rows that have both (ties share ranks)
    -> a, b, n (those rows), rho; a is the earlier column.

    NULL and NaN are missing.  rho is NULL where fewer than two rows have both
    or one column is constant on them; an empty table gives n = 0 everywhere."""
    d, spark = len(cols), df.sparkSession
    x = cut_lineage(df.select(F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("part"),
                              *[_number(c).alias(f"c{i}") for i, c in enumerate(cols)]))
    both = _both_present(x, d)
    n = lambda i, j: both.get((min(i, j), max(i, j)), 0)
    kind = [min(i for i in range(d) if n(i, j) == n(i, i) == n(j, j)) for j in range(d)]  # present in the same rows
    sets: dict[tuple[int, int | None], int] = {}

    def rank_set(i: int, partner: int) -> int:
        return sets.setdefault((i, None if n(i, partner) == n(i, i) else kind[partner]), len(sets))

    pairs = [(i, j, rank_set(i, j), rank_set(j, i)) for i in range(d) for j in range(i + 1, d) if n(i, j) > 1]
    named = [(cols[i], cols[j], n(i, j)) for i in range(d) for j in range(i + 1, d)]
    out = spark.createDataFrame(named, "a string, b string, n long")
    if not pairs:
        return out.withColumn("rho", F.lit(None).cast("double"))

    partners: dict[int, list[int | None]] = {}
    for i, k in sets:
        partners.setdefault(i, []).append(k)
    bounds = _bounds(x, d, x.count())
    blocks = cut_lineage(x.groupBy("part").applyInArrow(_summary(d, partners, bounds), SUMMARY))
    rows_in = blocks.select("i", "g", F.posexplode("t").alias("k", "n")).groupBy("i", "g", "k").agg(F.sum("n").alias("n")).collect()
    counts = {i: np.zeros((len(bounds[i]) + 1, len(ks)), np.int64) for i, ks in partners.items()}
    for r in rows_in:  # a number a column, range and set
        counts[r["i"]][r["g"], r["k"]] = r["n"]
    below = {(i, g): 2 * c[:g].sum(0) - c.sum(0) for i, c in counts.items() for g in range(len(c))}
    ranks = blocks.select("part", "i", "g", "v", "n").groupBy("i", "g").applyInArrow(_ranked, RANKS)
    sums = (x.groupBy("part").cogroup(ranks.groupBy("part"))
            .applyInArrow(_gram(d, sets, below, [p[2] for p in pairs], [p[3] for p in pairs]), "p int, ab double, aa double, bb double")
            .groupBy("p").agg(F.sum("ab").alias("ab"), F.sum("aa").alias("aa"), F.sum("bb").alias("bb")))
    names = spark.createDataFrame([(p, cols[i], cols[j]) for p, (i, j, _s, _t) in enumerate(pairs)], "p int, a string, b string")
    rho = F.when((F.col("aa") > 0) & (F.col("bb") > 0),
                 F.col("ab") / F.when((F.col("aa") > 0) & (F.col("bb") > 0), F.sqrt("aa") * F.sqrt("bb")))
    return out.join(names.join(sums, "p").select("a", "b", rho.alias("rho")), ["a", "b"], "left")


def pruning(df: DataFrame, cols: list[str], limit: float = 0.85) -> DataFrame:
    """Greedy pruning -> rank (place in ``cols``), feature, kept, because_of, rho.

    In the order of ``cols`` a column goes if it correlates over ``limit`` (absolute
    rho, at least two rows in common) with a column kept before it; ``because_of``
    is the first such column and ``rho`` their correlation.  A column whose
    correlations are all unknown stays."""
    rho = {(r["a"], r["b"]): r["rho"] for r in spearman(df, cols).collect()}  # one row a pair of columns
    kept: list[str] = []
    rows = []
    for place, c in enumerate(cols, 1):
        by = next((k for k in kept if rho[k, c] is not None and abs(rho[k, c]) > limit), None)
        if by is None:
            kept.append(c)
        rows.append((place, c, by is None, by, None if by is None else rho[by, c]))
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, kept boolean, because_of string, rho double")


def prune_correlated(df: DataFrame, cols: list[str], limit: float = 0.85) -> list[str]:
    """The columns :func:`pruning` keeps, in their order."""
    return [r["feature"] for r in pruning(df, cols, limit).orderBy("rank").collect() if r["kept"]]
