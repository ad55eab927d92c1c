"""Gradient-boosted trees that know missing values (M2, T24), and what each feature
contributes to a row's score (M11, M12).

Training is a series of Spark aggregates.  Every feature is cut into bins once
(bin 0: missing); a level of a tree needs the sums of first and second derivatives
per (node, feature, bin), map-side combined, and a window over the bins gives the
gain of every split with the missing rows on either side.  Only the best split of
each open node, 2 ** depth rows at most, reaches the driver.  A category enters as its
out-of-fold label rate (``stats.target_encode``), so any cardinality trains.

Contributions are the Shapley values of the trees along their paths: a leaf's value
is shared among the distinct features on its path, by whether the row goes that way
and by the part of the training rows that does.  They sum to the row's margin minus
the base value.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..session import cut_lineage, in_few_partitions
from .metrics import corr_moments, corr_of
from .quality import approximate_quantiles, column_quantiles


@dataclass
class Split:
    feature: int
    bin: int          # rows of this bin and below go left
    missing_left: bool
    cover: float


@dataclass
class Leaf:
    value: float
    cover: float


@dataclass
class Boosted:
    """Features in order, their bin edges, the prior log odds and the trees (heap-numbered nodes)."""
    cols: list[str]
    edges: list[list[float]]
    prior: float
    trees: list[dict[int, Split | Leaf]] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"cols": self.cols, "edges": self.edges, "prior": self.prior,
                           "trees": [{k: asdict(n) for k, n in t.items()} for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        d = json.loads(text)
        node = lambda n: Split(**n) if "feature" in n else Leaf(**n)
        return Boosted(d["cols"], d["edges"], d["prior"], [{int(k): node(n) for k, n in t.items()} for t in d["trees"]])


# -- bins ------------------------------------------------------------------------

def bin_edges(train: DataFrame, cols: list[str], bins: int = 32, exact: bool = False) -> list[list[float]]:
    """Upper edges of each feature's bins: its quantiles, to six decimals, without repeats.

    By mergeable summaries (to a 10,000th of the ranks) in one pass, or ``exact``."""
    qs = [k / bins for k in range(1, bins)]
    found: dict[str, set[float]] = {c: set() for c in cols}
    # bins - 1 numbers a feature, whatever the data's size
    wanted = {c: qs for c in cols}
    found_at = column_quantiles(train, wanted) if exact else approximate_quantiles(train, wanted, 10_000)
    rows = found_at.select("feature", F.round("value", 6).alias("value")).collect()
    for r in rows:
        found[r["feature"]].add(r["value"])
    return [sorted(found[c]) for c in cols]


def _bins_of(edges: list[list[float]]):
    """Arrow UDF: the features' values -> the array of their bins, by binary search."""
    ends = [np.array(e, float) for e in edges]

    @arrow_udf(T.ArrayType(T.IntegerType()))
    def run(*values: pa.Array) -> pa.Array:
        out = np.zeros((len(values[0]), len(ends)), np.int32)
        for i, (x, e) in enumerate(zip(values, ends, strict=True)):
            x = x.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(e, x, "left") + 1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * len(ends)), pa.array(out.ravel()))
    return run


def binned(df: DataFrame, cols: list[str], edges: list[list[float]]) -> DataFrame:
    """``df`` with the array ``bins`` of its features' bins: 0 for a missing value, else 1 + the number of edges below it."""
    if not cols:
        return df.withColumn("bins", F.array().cast("array<int>"))
    return df.withColumn("bins", _bins_of(edges)(*[F.col(c).cast("double") for c in cols]))


# -- one level ---------------------------------------------------------------------

def _partial_sums(graded=None):
    """Per partition: sums of the derivatives and the rows of every (node, feature, bin) met there.

    Batches are (node, bins, g, h), or what ``graded`` makes such batches of."""
    def run(batches):
        total: dict[int, np.ndarray] = {}  # node -> (g, h, rows) x feature x bin
        for batch in batches if graded is None else map(graded, batches):
            if not batch.num_rows:
                continue
            node, inverse = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            d = len(batch.column(1)[0])
            bins = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            g, h = (np.repeat(batch.column(i).to_numpy(zero_copy_only=False), d) for i in (2, 3))
            width = int(bins.max(initial=0)) + 1
            key = (np.repeat(inverse, d) * d + np.tile(np.arange(d), batch.num_rows)) * width + bins
            size = len(node) * d * width
            part = np.stack([np.bincount(key, w, size).reshape(len(node), d, width) for w in (g, h, None)], 1)
            for i, n in enumerate(node.tolist()):
                old = total.get(n)
                if old is None:
                    total[n] = part[i]
                elif old.shape[2] >= width:
                    old[:, :, :width] += part[i]
                else:
                    part[i][:, :, :old.shape[2]] += old
                    total[n] = part[i]
        for n, sums in total.items():
            f, b = np.nonzero(sums[2])
            yield pa.RecordBatch.from_pydict({"node": pa.array(np.full(len(f), n), pa.int32()), "f": pa.array(f, pa.int32()),
                                              "bin": pa.array(b, pa.int32()), "g": sums[0][f, b], "h": sums[1][f, b]})
    return run


_SUMS = "node int, f int, bin int, g double, h double"


def _added(part: DataFrame) -> DataFrame:
    return part.groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def histogram(rows: DataFrame) -> DataFrame:
    """(node, f, bin, g, h): sums of the derivatives over rows (node, bins, g, h).

    A partition adds up its rows as they pass, with no row per (row, feature); what is
    exchanged is a row per partition, node, feature and bin."""
    part = rows.select("node", "bins", F.col("g").cast("double").alias("g"), F.col("h").cast("double").alias("h"))
    return _added(part.mapInArrow(_partial_sums(), _SUMS))


def split_gains(hist: DataFrame, lam: float = 1.0, min_cover: float = 1.0) -> DataFrame:
    """(node, f, bin, missing_left, gain, gl, hl, gr, hr): every split between bins, missing rows on either side.

    The split after the last bin parts the missing rows from all others.
    """
    key = Window.partitionBy("node", "f")
    upto = key.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    known = lambda x: F.when(F.col("bin") > 0, F.col(x)).otherwise(0.0)
    lost = lambda x: F.when(F.col("bin") == 0, F.col(x)).otherwise(0.0)
    s = hist.select("node", "f", "bin", *[e.alias(f"{x}_{n}") for x in ("g", "h") for n, e in (
        ("all", F.sum(x).over(key)), ("low", F.sum(known(x)).over(upto)), ("lost", F.sum(lost(x)).over(key)))])
    s = s.filter("bin > 0").withColumn("missing_left", F.explode(F.array(F.lit(True), F.lit(False))))
    left = lambda x: F.col(f"{x}_low") + F.when(F.col("missing_left"), F.col(f"{x}_lost")).otherwise(0.0)
    s = s.select("node", "f", "bin", "missing_left", "g_all", "h_all", left("g").alias("gl"), left("h").alias("hl"))
    s = s.withColumns({"gr": F.col("g_all") - F.col("gl"), "hr": F.col("h_all") - F.col("hl")})
    part = lambda g, h: F.col(g) * F.col(g) / (F.col(h) + lam)
    gain = (part("gl", "hl") + part("gr", "hr") - part("g_all", "h_all")) / 2
    return (s.filter((F.col("hl") >= min_cover) & (F.col("hr") >= min_cover))
            .select("node", "f", "bin", "missing_left", gain.alias("gain"), "gl", "hl", "gr", "hr"))


def best_splits(gains: DataFrame) -> DataFrame:
    """Each node's best split; ties: the first feature, the lowest bin, missing rows to the left."""
    best = F.max(F.struct(F.round("gain", 9).alias("gain"), (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"),
                          "missing_left", "gl", "hl", "gr", "hr")).alias("s")
    return gains.groupBy("node").agg(best).select("node", "s.gain", (-F.col("s.f")).alias("f"), (-F.col("s.bin")).alias("bin"),
                                                  "s.missing_left", "s.gl", "s.hl", "s.gr", "s.hr")


# -- trees -----------------------------------------------------------------------------

def _matrix(bins: pa.Array, d: int) -> np.ndarray:
    return bins.flatten().to_numpy(zero_copy_only=False).reshape(len(bins), d)


def node_of(tree: dict[int, Split | Leaf], bins: np.ndarray) -> np.ndarray:
    """The numbers of the nodes that rows of bins end in (a child's number is above its parent's)."""
    node = np.zeros(len(bins), np.int64)
    for at, n in sorted(tree.items()):
        if isinstance(n, Split):
            mine = np.flatnonzero(node == at)
            b = bins[mine, n.feature]
            node[mine] = np.where((b <= n.bin) & ((b > 0) | n.missing_left), 2 * at + 1, 2 * at + 2)
    return node


def add_values(out: np.ndarray, trees: list[dict[int, Split | Leaf]], bins: np.ndarray) -> np.ndarray:
    """The values of the rows' leaves added to ``out``, tree by tree."""
    for tree in trees:
        value = np.zeros(max(tree) + 1)
        for at, n in tree.items():
            if isinstance(n, Leaf):
                value[at] = n.value
        out = out + value[node_of(tree, bins)]
    return out


def _graded(d: int, trees: list[dict[int, Split | Leaf]], tree: dict[int, Split | Leaf], todo: set[int]):
    """Rows (y, bins, margin before ``trees``) -> (node, bins, g, h) of those in the nodes ``todo`` of the tree at hand."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bins = _matrix(batch.column(1), d)
        node = node_of(tree, bins)
        mine = np.isin(node, list(todo))
        bins, y, before = bins[mine], *(batch.column(i).to_numpy(zero_copy_only=False)[mine] for i in (0, 2))
        p = 1 / (1 + np.exp(-add_values(before, trees, bins)))
        at = pa.array(np.arange(len(bins) + 1, dtype=np.int32) * d)
        return pa.RecordBatch.from_pydict({"node": pa.array(node[mine], pa.int32()), "g": p - y, "h": p * (1 - p),
                                           "bins": pa.ListArray.from_arrays(at, pa.array(bins.ravel()))}).select(["node", "bins", "g", "h"])
    return run


def train_boosted(train: DataFrame, cols: list[str], *, label: str = "label", rounds: int = 20, depth: int = 4,
                  rate: float = 0.3, lam: float = 1.0, min_cover: float = 1.0, bins: int = 32, cut: int = 5) -> Boosted:
    """Second-order boosting of the log loss; rows without a label are left out.

    A table without rows, or of one label only, gives the prior alone.
    """
    data = train.filter(F.col(label).isNotNull())
    n, p = data.agg(F.count(F.lit(1)), F.avg(F.col(label).cast("double"))).first()
    data = in_few_partitions(data, n)
    if not n or p in (0.0, 1.0):
        return Boosted(list(cols), [[] for _ in cols], 0.0 if not n else math.copysign(30.0, p - 0.5))
    prior = math.log(p / (1 - p))
    model = Boosted(list(cols), bin_edges(data, cols, bins), prior)
    rows = cut_lineage(binned(data, cols, model.edges).select(F.col(label).cast("double").alias("y"), "bins",
                                                              F.lit(prior).alias("margin"))).persist()
    leaf = lambda g, h: Leaf(-rate * g / (h + lam), h)
    fresh: list[dict[int, Split | Leaf]] = []  # trees that the margin of ``rows`` does not hold yet
    for k in range(rounds):
        tree: dict[int, Split | Leaf] = {}
        todo = {0}
        for _ in range(depth):
            sums = _added(rows.select("y", "bins", "margin").mapInArrow(
                _partial_sums(_graded(len(cols), list(fresh), dict(tree), todo)), _SUMS))
            found = best_splits(split_gains(sums, lam, min_cover)).filter("gain > 1e-6").collect()  # a row a node
            todo = set()
            for s in found:
                i = s["node"]
                tree[i] = Split(s["f"], s["bin"], s["missing_left"], s["hl"] + s["hr"])
                tree[2 * i + 1], tree[2 * i + 2] = leaf(s["gl"], s["hl"]), leaf(s["gr"], s["hr"])
                todo |= {2 * i + 1, 2 * i + 2}
            if not todo:
                break
        if not tree:
            break  # no split gains anything
        model.trees.append(tree)
        fresh.append(tree)
        if (k + 1) % cut == 0 and k + 1 < rounds:
            done, rows = rows, cut_lineage(rows.withColumn("margin", _with_trees(len(cols), fresh)("margin", "bins"))).persist()
            done.unpersist()
            fresh = []
    rows.unpersist()
    return model


def _with_trees(d: int, trees: list[dict[int, Split | Leaf]]):
    """Arrow UDF: margins and the rows' bins -> the margins with the trees' values."""
    @arrow_udf(T.DoubleType())
    def run(before: pa.Array, bins: pa.Array) -> pa.Array:
        return pa.array(add_values(before.to_numpy(zero_copy_only=False), trees, _matrix(bins, d)))
    return run


def margin(model: Boosted, bins: Column) -> Column:
    if not model.trees:
        return F.lit(float(model.prior))
    return _with_trees(len(model.cols), model.trees)(F.lit(float(model.prior)), bins)


def score_boosted(model: Boosted, df: DataFrame, keep=("sample_id", "label", "split")) -> DataFrame:
    """Keep columns + score, the probability of label 1."""
    x = binned(df, model.cols, model.edges)
    return x.select(*keep, (1 / (1 + F.exp(-margin(model, F.col("bins"))))).alias("score"))


# -- contributions ------------------------------------------------------------------------

@dataclass
class _Path:
    """A leaf: its features, the bins of each that lead there, and the shares of its value.

    ``shares[pattern, j]``: what feature j gets of a row for which the bits of
    ``pattern`` tell which features lead to the leaf.
    """
    features: list[int]
    allowed: list[np.ndarray]
    shares: np.ndarray
    mean: float


def _shares(value: float, z: list[float]) -> np.ndarray:
    """Shapley values of the game in which a feature outside the coalition counts by its part ``z`` of the rows."""
    m = len(z)
    out = np.zeros((1 << m, m))
    weight = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
    for pattern in range(1 << m):
        goes = [pattern >> j & 1 for j in range(m)]
        for j in range(m):
            by_size = [1.0]
            for other in range(m):
                if other != j:
                    by_size = [(by_size[s] * z[other] if s < len(by_size) else 0.0)
                               + (by_size[s - 1] * goes[other] if s else 0.0) for s in range(len(by_size) + 1)]
            out[pattern, j] = value * (goes[j] - z[j]) * sum(w * c for w, c in zip(weight, by_size, strict=True))
    return out


def paths(model: Boosted) -> list[_Path]:
    found = []

    def walk(tree, at, allowed, z):
        n = tree[at]
        if isinstance(n, Leaf):
            fs = sorted(allowed)
            found.append(_Path(fs, [allowed[f] for f in fs], _shares(n.value, [z[f] for f in fs]),
                               n.value * math.prod(z.values())))
            return
        size = len(model.edges[n.feature]) + 2
        b = np.arange(size)
        left = (b <= n.bin) & ((b > 0) | n.missing_left)
        for child, way in ((2 * at + 1, left), (2 * at + 2, ~left)):
            part = tree[child].cover / n.cover if n.cover > 0 else 0.0
            walk(tree, child, allowed | {n.feature: allowed.get(n.feature, np.ones(size, bool)) & way},
                 z | {n.feature: z.get(n.feature, 1.0) * part})
    for t in model.trees:
        walk(t, 0, {}, {})
    return found


def base_value(model: Boosted) -> float:
    """The mean margin along the trees' paths: what the contributions add to."""
    return model.prior + sum(p.mean for p in paths(model))


def contributions_of(model: Boosted):
    """Arrow UDF: a row's bins -> its features' contributions."""
    of, n = paths(model), len(model.cols)

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def run(bins: pa.Array) -> pa.Array:
        b = _matrix(bins, n)
        phi = np.zeros((len(b), n))
        for p in of:
            pattern = np.zeros(len(b), np.int64)
            for j, (f, ok) in enumerate(zip(p.features, p.allowed, strict=True)):
                pattern |= ok[b[:, f]].astype(np.int64) << j
            phi[:, p.features] += p.shares[pattern]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * n), pa.array(phi.ravel()))
    return run


def contributions(model: Boosted, df: DataFrame) -> DataFrame:
    """``df`` with ``margin`` and the array ``phi`` of its features' contributions (M11), row by row."""
    x = binned(df, model.cols, model.edges)
    return (x.withColumn("margin", margin(model, F.col("bins"))).withColumn("phi", contributions_of(model)(F.col("bins")))
            .drop("bins"))


def attribution(explained: DataFrame, cols: list[str]) -> DataFrame:
    """feature, mean_abs_contribution, rank (M11) over all rows, in one aggregate."""
    a = explained.select(F.posexplode("phi").alias("f", "x")).groupBy("f").agg(F.avg(F.abs("x")).alias("mean_abs_contribution"))
    names = F.array(*[F.lit(c) for c in cols])
    order = Window.orderBy(F.desc("mean_abs_contribution"), "feature")  # a row a feature
    return (a.select(F.get(names, F.col("f")).alias("feature"), "mean_abs_contribution")
            .withColumn("rank", F.row_number().over(order)))


def contribution_direction(explained: DataFrame, cols: list[str], categories: set[str] = frozenset(), k: int = 5,
                           min_rows: int = 10) -> DataFrame:
    """feature, rank, n, corr, sign (M12) of the ``k`` features with the largest mean contribution.

    corr: of the feature's value with its own contribution, over the rows that have
    the value, from one aggregate of moments.  ``category`` for a category, ``n/a``
    for ``min_rows`` rows or fewer, or without any variation.
    """
    aggs = []
    for i, c in enumerate(cols):
        x, phi = F.col(c).cast("double"), F.get("phi", F.lit(i))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(F.abs(phi)).alias(f"a{i}"),
                 *[e.alias(f"{n}{i}") for n, e in zip("csy", corr_moments(x, phi), strict=True)]]
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"),
                               corr_of(F.col(f"c{i}"), F.col(f"s{i}"), F.col(f"y{i}")).alias("c"),
                               F.col(f"s{i}").alias("s"), F.col(f"a{i}").alias("a")) for i, c in enumerate(cols)])
    top = explained.agg(*aggs).select(F.explode(cells).alias("x")).select("x.*").orderBy(F.desc("a"), "feature").limit(k)
    kind = F.col("feature").isin(*categories) if categories else F.lit(False)
    ok = ~kind & (F.col("n") > min_rows) & (F.col("s") > 0)
    sign = (F.when(kind, "category").when(~ok, "n/a").when(F.col("c") > 0, "up").when(F.col("c") < 0, "down").otherwise("n/a"))
    return top.select("feature", F.row_number().over(Window.orderBy(F.desc("a"), "feature")).alias("rank"), "n",
                      F.when(ok, F.col("c")).alias("corr"), sign.alias("sign"))
