"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Documents whose n-gram sets are equal form a class; one row per class goes on.

1. Columns.  Two sets with Jaccard >= t share at least t * size n-grams of either,
   so if each lists its n-grams in one common order (by hash) and keeps the first
   ``size - ceil(t * size) + c`` of them, they share c of those at least.  Only these
   entries of the incidence matrix are exchanged; c grows with the size.
2. Product over the sparse columns (HOT classes or fewer): overlap counts of pairs
   are accumulated, with pairs of incompatible sizes left out, and pairs that cannot
   reach c are discarded.  A column yields HOT / 2 pairs an entry at most.
3. Dense columns (a large group of copies, or a common passage).  A set with fewer
   dense columns than the smallest c of a possible partner leaves them out: each of
   its links shares a sparse column too.  No pairs are made of the rest.
4. Pairs that reach c by sparse columns alone are joined.  That others share n-grams
   says little in a large corpus, where the common ones would chain most sets.  So
   the whole rows of the others and of the sets kept for their dense columns are cut
   by hash into more parts than two linked rows have differences: some part is equal
   in both (``parts_of``).  Rows with an equal part are joined to the smallest of
   them, by way of the smallest of ``SAMPLE`` groups where the part is crowded.
   The joins make families (connected components).
5. Each family's whole rows are multiplied with each other in blocks of documents of
   like size: up to eight of a size, or as many as ``BLOCK`` n-grams a block make.  A
   pair of blocks is multiplied in tiles of ``ROWS`` x ``ROWS`` documents: overlap
   counts are accumulated over stretches of columns, pairs that cannot reach their
   bound any more are dropped, pairs that the tiles before have joined are left out.
   Each pair of blocks gives a spanning forest of its links, not the links.
6. Components of the forests' edges give the component of every class.

Exact up to 48-bit hash collisions of n-grams within a pair.
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
from rekindle.llm.common import identity, small_batches, spare_names, spread_join, written
from rekindle.llm.components import components

ROWS = 128
HOT = 16
SAMPLE = 64
COLUMNS = 4096
#: N-grams of a block that has more than ROWS documents, at most: a row is exchanged once a block of its family.
BLOCK = 1 << 22
_LOW = np.uint64((1 << 48) - 1)
_48 = np.uint64(48)


def gram_sets(part: W.Part, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes (48 bits, ascending) of every text of a part, and CSR offsets.

    Words are compared with A-Z in lower case; a text with fewer words than
    ``width`` has its whole sequence as one n-gram, one without words has none.
    """
    n = len(part.offs) - 1
    h, doc, count = part.hashes(lower=True), part.doc_of_word(), np.diff(part.woffs)
    at, g = W.windows(h, doc, width)
    own = doc[at]
    short = np.flatnonzero((count > 0) & (count < width))
    for size in range(1, width):
        some = short[count[short] == size]
        first, whole = part.woffs[some], np.full(len(some), size, np.uint64)
        for j in range(size):
            whole = whole * W._P + h[first + j]
        own, g = np.append(own, some), np.append(g, W.mix64(whole))
    key = np.sort((own.astype(np.uint64) << _48) | (g & _LOW))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return key & _LOW, np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << _48)


def _texts(texts: pa.Array, most: int = 1 << 15) -> Iterator[W.Part]:
    """Parts of at most 2**15 texts, so that a text's number fits the sort key."""
    for a in range(0, len(texts), most):
        for p in W.parts(texts.slice(a, most)):
            p.first += a
            yield p


def common_first(size, t_num: int):
    """c: how many of their first n-grams two linked sets share, if ``size`` is the smaller one's."""
    return np.minimum(4 + size // 20, -(-t_num * size // 1000))


def first_grams(grams: np.ndarray, offs: np.ndarray, t_num: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of every set (ascending) that are exchanged, and their CSR offsets."""
    size = np.diff(offs)
    n = np.minimum(size, size - -(-t_num * size // 1000) + common_first(size, t_num))
    rank = np.arange(len(grams)) - np.repeat(offs[:-1], size)
    return grams[rank < np.repeat(n, size)], np.append(0, np.cumsum(n))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(values: list[np.ndarray], offs: list[np.ndarray]) -> pa.Array:
    lengths = np.concatenate([np.diff(o) for o in offs]) if offs else np.zeros(0, np.int64)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), _signed(flat))


def signatures(width: int, t_num: int):
    """Arrow UDF: text -> (n, digest of the set, n-grams to exchange)."""
    kind = T.StructType([T.StructField("n", T.LongType()), T.StructField("digest", T.LongType()),
                         T.StructField("keys", T.ArrayType(T.LongType()))])

    @arrow_udf(kind)
    @W.trimmed
    def run(texts: pa.Array) -> pa.Array:
        n, digest, keys, koffs = [], [], [], []
        for p in _texts(texts):
            g, offs = gram_sets(p, width)
            total = np.zeros(len(g) + 1, np.uint64)
            np.cumsum(W.mix64(g), out=total[1:])
            size = np.diff(offs)
            n.append(size)
            digest.append(W.mix64(total[offs[1:]] - total[offs[:-1]] + size.astype(np.uint64)))
            k, ko = first_grams(g, offs, t_num)
            keys.append(k)
            koffs.append(ko)
        size = np.concatenate(n) if n else np.zeros(0, np.int64)
        dig = np.concatenate(digest) if digest else np.zeros(0, np.uint64)
        return pa.StructArray.from_arrays(
            [pa.array(size.astype(np.int64)), pa.array(dig.view(np.int64), mask=size == 0), _lists(keys, koffs)],
            ["n", "digest", "keys"])
    return run


def set_of(width: int):
    """Arrow UDF: text -> its sorted n-gram hashes."""
    @arrow_udf(T.ArrayType(T.LongType()))
    @W.trimmed
    def run(texts: pa.Array) -> pa.Array:
        found = [gram_sets(p, width) for p in _texts(texts)]
        return _lists([g for g, _ in found], [o for _, o in found])
    return run


def size_bounds(t_num: int) -> np.ndarray:
    """The least size of every size class; linked sets are of one class or of neighbouring ones."""
    at = [1]
    while at[-1] < 1 << 40:
        at.append(max(at[-1] + 1, at[-1] + at[-1] // 16, (at[-1] - 1) * 1000 // t_num + 1))
    return np.array(at)


def parts_of(grams: np.ndarray, offs: np.ndarray, t_num: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which any two linked sets share one at least, and their CSR offsets.

    Sets of at most m n-grams that are linked differ in h = 2 m (1 - t) / (1 + t)
    n-grams at most.  Cut by hash into h + h / 2 + 1 parts, all but h are equal,
    so of their h + 1 largest parts (by number, then place) one is equal.  m is
    the largest size of a size class; a set is cut for its own class and for the
    next one up, where its larger partners are.
    """
    n = len(offs) - 1
    size, bounds = np.diff(offs), size_bounds(t_num)
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(W.mix64(grams), out=total[1:])
    high, keys, owner = grams >> np.uint64(16), [], []
    for up in (0, 1):
        level = np.searchsorted(bounds, size, "right") - 1 + up
        h = np.where(size > 0, 2 * (bounds[level + 1] - 1) * (1000 - t_num) // (1000 + t_num), -1)
        many = h + np.maximum(h, 0) // 2 + 1
        first = np.append(0, np.cumsum(many))
        place = (high * np.repeat(many.astype(np.uint64), size)) >> np.uint64(32)
        count = np.bincount(np.repeat(first[:-1], size) + place.astype(np.int64), minlength=first[-1])
        ends = np.cumsum(count)
        own = np.repeat(np.arange(n), many)
        at = np.arange(first[-1]) - first[own]
        key = W.mix64((level[own].astype(np.uint64) << np.uint64(40)) + at.astype(np.uint64)) + total[ends] - total[ends - count]
        order = np.lexsort((at, -count, own))
        some = order[at <= h[own]]
        keys.append(W.mix64(key[some]))
        owner.append(own[some])
    own = np.concatenate(owner)
    return np.concatenate(keys)[np.argsort(own, kind="stable")], np.append(0, np.cumsum(np.bincount(own, minlength=n)))


def part_keys(width: int, t_num: int):
    """Arrow UDF: text -> the keys of its n-gram set's parts."""
    @arrow_udf(T.ArrayType(T.LongType()))
    @W.trimmed
    def run(texts: pa.Array) -> pa.Array:
        found = [parts_of(*gram_sets(p, width), t_num) for p in _texts(texts)]
        return _lists([k for k, _ in found], [o for _, o in found])
    return run


def forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, t_num: int, t_den: int) -> np.ndarray:
    """Smallest set number reachable by links between rows ``left`` and rows ``right`` of the incidence matrix."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])
    df = np.diff(np.append(np.flatnonzero(new), len(flat)))
    col = np.cumsum(new) - 1
    shared = df[col] > 1  # other columns add nothing to an overlap
    owner, col = owner[shared], col[shared]
    if len(col):
        col = np.cumsum(np.append(True, col[1:] != col[:-1])) - 1
    union_most = size[left][:, None] + size[right][None, :]
    # t_den * overlap >= t_num * (union_most - overlap)
    need = -(-t_num * union_most // (t_den + t_num))
    count = np.zeros(need.shape, np.float32)
    row_l, row_r = np.full(n, -1), np.full(n, -1)
    row_l[left], row_r[right] = np.arange(len(left)), np.arange(len(right))
    rest = np.bincount(owner, minlength=n)
    width = int(col[-1]) + 1 if len(col) else 0
    for a in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(col, [a, a + COLUMNS])
        own, c = owner[lo:hi], col[lo:hi] - a
        x = np.zeros((len(left), min(COLUMNS, width - a)), np.float32)
        y = np.zeros((len(right), x.shape[1]), np.float32)
        in_l, in_r = row_l[own] >= 0, row_r[own] >= 0
        x[row_l[own][in_l], c[in_l]] = 1
        y[row_r[own][in_r], c[in_r]] = 1
        count += x @ y.T
        rest -= np.bincount(own, minlength=n)
        if not (count + np.minimum(rest[left][:, None], rest[right][None, :]) >= need).any():
            break
    i, j = np.nonzero(count >= need)
    i, j = left[i], right[j]
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (before == root).all():
            break
    return root


def block_forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, t_num: int, t_den: int) -> np.ndarray:
    """``forest`` in tiles of ROWS x ROWS; rows that earlier tiles have joined are not compared with each other again."""
    root = np.arange(len(sets))
    same = np.array_equal(left, right)
    for a in range(0, len(left), ROWS):
        for b in range(a if same else 0, len(right), ROWS):
            x, y = left[a:a + ROWS], right[b:b + ROWS]
            both = np.append(x, y)
            names, n = np.unique(root[both], return_counts=True)
            in_x, in_y = (root[k] == names[n.argmax()] for k in (x, y))
            # all pairs but those within the largest component, if it has half of the rows
            todo = [(x, y)] if 2 * n.max() < len(both) else [(x[~in_x], y)] + [(x[in_x], y[~in_y])] * (not same or a != b)
            for i, j in todo:
                if len(i) == 0 or len(j) == 0:
                    continue
                some = np.union1d(i, j)
                found = some[forest([sets[k] for k in some], np.searchsorted(some, i), np.searchsorted(some, j), t_num, t_den)]
                for u, v in zip(some[found != some], found[found != some], strict=True):
                    if root[u] != root[v]:
                        low, high = sorted((root[u], root[v]))
                        root[root == high] = low
    return root


def block_links(t_num: int, t_den: int):
    """mapInArrow body over rows (family, c, up, bi, bj, side, digest, grams) sorted by the first five."""
    def finish(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        _, _, up, bi, bj = rows[0][0]
        seen = {}
        for _, side, digest, grams in rows:
            seen.setdefault(digest, (side, grams))
        digest = np.array(list(seen))
        side = np.array([b for b, _ in seen.values()])
        left, right = np.flatnonzero(side == (-1 if up else bi)), np.flatnonzero(side == (-2 if up else bj))
        if len(left) == 0 or len(right) == 0 or len(digest) < 2:
            return digest[:0], digest[:0]
        root = block_forest([g for _, g in seen.values()], left, right, t_num, t_den)
        off = np.flatnonzero(root != np.arange(len(root)))
        return digest[off], digest[root[off]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def out(pair):
            return pa.RecordBatch.from_arrays([pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64())], ["u", "v"])
        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            grams = b.column(7)
            offs, flat = grams.offsets.to_numpy(), grams.values.to_numpy()
            for r in range(b.num_rows):
                now = tuple(c[r] for c in cols[:5])
                if now != key:
                    if len(rows) > 1:
                        yield out(finish(rows))
                    key, rows = now, []
                rows.append((now, cols[5][r], int(cols[6][r]), flat[offs[r]:offs[r + 1]].copy()))
            W.give_back()
        if len(rows) > 1:
            yield out(finish(rows))
    return run


def join_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    threshold: float = 0.9) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the components of "Jaccard of n-gram sets >= threshold".

    component_id: smallest id reachable over links, itself included.

    Defined cases: NULL or empty texts have no n-grams and no link (component_id
    is their own id); equal sets link; NULL ids are never a component's name
    unless it has no other; rows repeated in full are one class; rows with one id
    and several texts are documents of their own; an empty table gives an empty
    result; other columns are ignored.
    """
    return row_components(docs, id_col=id_col, text_col=text_col, width=width, threshold=threshold).select(
        "doc_id", "n_shingles", "component_id")


def _crowded(keyed: DataFrame, name: str) -> DataFrame:
    """The keys k with 8 digests or more among every SAMPLE-th digest, and an estimate of their number."""
    return written(keyed.filter(F.pmod(F.col("digest"), F.lit(SAMPLE)) == 0).groupBy("k").agg(F.count("*").alias("n"))
                   .filter(F.col("n") >= 8).select("k", (F.col("n") * SAMPLE).alias("crowd")), name)


def _dealt(keyed: DataFrame, crowded: DataFrame) -> DataFrame:
    """``keyed`` with ``crowd`` and ``part``: the rows of a crowded key are dealt over SAMPLE parts."""
    part = F.when(F.col("crowd").isNotNull(), F.pmod(F.xxhash64("digest"), F.lit(SAMPLE))).otherwise(0)
    return keyed.join(crowded, "k", "left").withColumn("part", part)


def _stars(keyed: DataFrame, name: str) -> DataFrame:
    """Links (u, v) of the digests of each key to the smallest of them, by way of the smallest of their part."""
    hub = F.min("digest").over(Window.partitionBy("k", "part"))
    found = written(_dealt(keyed, _crowded(keyed, f"{name}-crowded")).withColumn("hub", hub)
                    .filter("digest <> hub or crowd is not null")
                    .select("digest", "hub", F.when(F.col("digest") == F.col("hub"), F.col("k")).alias("k")).distinct(), name)
    outer = found.filter("k is not null").select("digest", F.min("digest").over(Window.partitionBy("k")).alias("hub"))
    return (found.filter("k is null").select("digest", "hub").union(outer).filter("digest <> hub")
            .select(F.col("digest").alias("u"), F.col("hub").alias("v")))


def row_key(id_: Column, text: Column) -> Column:
    """A row's key: ids alone may stand for several texts."""
    return identity(id_, text)


def row_components(docs: DataFrame, *, id_col: str, text_col: str, width: int, threshold: float) -> DataFrame:
    """The columns of ``join_components``, the row's ``key`` and ``root``, a digest of its component (NULL: no n-grams)."""
    t_num, t_den = int(round(threshold * 1000)), 1000
    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    key = row_key(F.col("doc_id"), F.col("text"))
    signed = written(base.select("doc_id", key.alias("key"), signatures(width, t_num)(F.col("text")).alias("s"))
                     .select("doc_id", "key", "s.*"), "gram-signatures")

    # one row of columns per class; most columns have one class only
    keyed = (signed.filter(F.size("keys") > 0).select("digest", "n", "keys").dropDuplicates(["digest"])
             .select("digest", F.col("n").cast("int").alias("n"), F.explode("keys").alias("k")))
    # a crowded column is dense whatever its exact number: it needs no count over all its rows
    # (which columns are found so changes the work, not the result); the rest are counted
    entries = (_dealt(keyed, _crowded(keyed, "gram-crowded"))
               .withColumn("df", F.coalesce("crowd", F.count("*").over(Window.partitionBy("k", "part"))))
               .filter("df > 1").select("digest", "n", "k", "df"))
    entries = written(entries, "gram-entries")
    dense = entries.filter(F.col("df") > HOT).groupBy("digest").agg(F.count("*").cast("int").alias("n_dense"))
    entries = entries.join(dense, "digest", "left").withColumn("n_dense", F.coalesce("n_dense", F.lit(0)))
    least = lambda n: F.least(4 + F.floor(n / 20), F.ceil(n * t_num / 1000))  # noqa: E731  common_first
    sparse = (entries.filter(F.col("df") <= HOT).groupBy("k")
              .agg(F.sort_array(F.collect_list(F.struct("digest", "n", "n_dense"))).alias("of")))  # HOT at most
    pairs = sparse.select(F.explode(F.flatten(F.transform("of", lambda x, i: F.transform(
        F.filter(F.slice("of", i + 2, HOT), lambda y: F.least(x["n"], y["n"]) * 1000 >= F.greatest(x["n"], y["n"]) * t_num),
        lambda y: F.struct(x.alias("x"), y.alias("y")))))).alias("p"))
    pairs = pairs.groupBy("p.x", "p.y").agg(F.count("*").alias("overlap"))
    need = least(F.least("x.n", "y.n"))
    pairs = written(pairs.filter(F.col("overlap") + F.least("x.n_dense", "y.n_dense") >= need).select(
        F.col("x.digest").alias("u"), F.col("y.digest").alias("v"), (F.col("overlap") >= need).alias("sure")), "gram-pairs")
    # a partner has t * n n-grams at least; one less for safety in the division
    kept = entries.filter((F.col("df") > HOT)
                          & (F.col("n_dense") >= least(F.greatest(F.floor(F.col("n") * t_num / 1000) - 1, F.lit(1)))))
    ends = pairs.select(F.explode(F.array("u", "v")).alias("digest"), (~F.col("sure")).alias("cut"))
    candidates = ends.union(kept.select("digest", F.lit(True))).groupBy("digest").agg(F.max("cut").alias("cut"))
    classes = written(signed.filter("digest is not null").groupBy("digest").agg(
        F.min("key").alias("key"), F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count("*").alias("n_rows")), "gram-classes")
    # the same plan at every size: the texts move once, and only those of candidates go on
    texts = written(base.select(key.alias("key"), "text").hint("merge")
                    .join(classes.join(candidates, "digest").select("key", "digest", "cut").hint("merge"), "key")
                    .select("digest", "text", "cut"), "gram-texts")
    parts = texts.filter("cut").select("digest", F.explode(part_keys(width, t_num)(F.col("text"))).alias("k"))
    family = components(pairs.filter("sure").select("u", "v").union(_stars(parts, "gram-stars")), "gram-families")
    members = family.union(family.select(F.col("root").alias("node"), "root").distinct())
    # linked sets are of the same or of neighbouring size classes
    size_class = F.floor(F.log("n") / float(np.log(1.001 / threshold))).cast("int")
    sized = members.join(classes, F.col("node") == F.col("digest")).select(
        "digest", F.col("root").alias("family"), size_class.alias("c"), "n")
    wide = F.greatest(F.lit(ROWS), F.least(F.greatest(F.lit(2 * ROWS), F.ceil(F.count("*") / F.lit(8))),
                                           F.floor(F.lit(BLOCK) / F.max("n"))))
    blocks = sized.groupBy("family", "c").agg(F.ceil(F.count("*") / wide).cast("int").alias("b"),
                                              F.count("*").alias("n_classes"))
    near = blocks
    for shift, name in ((1, "b_up"), (-1, "b_down")):
        near = near.join(blocks.select("family", (F.col("c") - shift).alias("c"), F.col("b").alias(name)), ["family", "c"], "left")
    wanted = spread_join(sized, near, ["family", "c"], "n_classes", "inner").select(
        "digest", "family", "c", "b", F.coalesce("b_up", F.lit(0)).alias("b_up"),
        F.coalesce("b_down", F.lit(0)).alias("b_down"),
        F.pmod(F.xxhash64("digest"), F.col("b")).cast("int").alias("block"))
    rows = (texts.select("digest", "text").hint("merge").join(wanted.hint("merge"), "digest")
            .withColumn("grams", set_of(width)(F.col("text"))))
    me = F.col("block")
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda o: o < n)
    pairs = F.concat(
        F.transform(upto(F.col("b")), lambda o: F.struct(F.col("c").alias("c"), F.lit(0).alias("up"), F.least(o, me).alias("bi"),
                                                         F.greatest(o, me).alias("bj"), me.alias("side"))),
        F.transform(upto(F.col("b_up")), lambda o: F.struct(F.col("c").alias("c"), F.lit(1).alias("up"), me.alias("bi"),
                                                            o.alias("bj"), F.lit(-1).alias("side"))),
        F.transform(upto(F.col("b_down")), lambda o: F.struct((F.col("c") - 1).alias("c"), F.lit(1).alias("up"), o.alias("bi"),
                                                              me.alias("bj"), F.lit(-2).alias("side"))))
    # a block pair: within a class (side: own block number) or with the next class up (side: -1 lower, -2 upper)
    at = ["family", "c", "up", "bi", "bj"]
    spread = (rows.withColumn("p", F.explode(pairs)).select("family", "p.c", "p.up", "p.bi", "p.bj", "p.side", "digest", "grams")
              .repartition(*at).sortWithinPartitions(*at))
    links = spread.mapInArrow(block_links(t_num, t_den), "u bigint, v bigint")
    linked = components(links, "gram-links")

    # classes in a component of several: the smallest id of all its classes
    both = linked.union(linked.select(F.col("root").alias("node"), "root").distinct())
    named = both.join(classes, F.col("node") == F.col("digest")).select("digest", "root", "rep")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("digest", "root", "component_id")
    of_class = classes.join(named, "digest", "left").select(
        "digest", F.coalesce("root", "digest").alias("root"), F.coalesce("component_id", "rep").alias("component_id"), "n_rows")
    # rows without n-grams have no class to be looked up
    found = (spread_join(signed.filter("digest is not null"), of_class, ["digest"], "n_rows")
             .unionByName(signed.filter("digest is null"), allowMissingColumns=True))
    return (found
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
                    .alias("component_id"), "key", "root"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
             threshold: float = 0.9) -> DataFrame:
    """One row of each component, one whose id names it; columns unchanged.

    Of texts without n-grams each (id, text) stays once.

    Only ids are exchanged: the documents that go, and the ids with several rows,
    are small tables as a rule, so the texts stay where they are (the written
    tables' sizes decide between a broadcast and a shuffle).
    """
    found = row_components(docs, id_col=id_col, text_col=text_col, width=width, threshold=threshold)
    [key] = spare_names(docs, "_key")
    per_id = found.groupBy(F.col("doc_id").alias(key)).agg(
        F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("head"), F.count("*").alias("n"))
    per_id = written(per_id.filter(~F.col("head") | (F.col("n") > 1)), "gram-ids")
    gone, several = per_id.filter(~F.col("head")).select(key), per_id.filter("head").select(key)
    same = docs[id_col].eqNullSafe(F.col(key))
    kept = docs.join(gone, same, "left_anti")
    heads = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .join(several, F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")
             .groupBy("doc_id", "root", F.when(F.col("root").isNull(), F.col("key")).alias("own")).agg(F.min("key").alias(key)).select(key))
    heads = written(heads, "gram-heads")
    return (kept.join(several, same, "left_anti")
            .unionByName(kept.join(several, same, "left_semi")
                         .join(heads, row_key(F.col(id_col), F.col(text_col)) == F.col(key), "left_semi")
                         .dropDuplicates([id_col, text_col])))


def op6_query(docs: DataFrame) -> DataFrame:
    return join_components(docs, width=3, threshold=0.9)


ORACLE = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT id, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams
      FROM d),
n AS (SELECT id, doc_id, CAST(len(grams) AS BIGINT) AS n FROM s),
e AS (SELECT id, unnest(grams) AS gram FROM s),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM e a JOIN e b ON a.gram = b.gram AND a.id < b.id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT id, id AS other FROM n UNION SELECT r.id, t.b FROM reach r JOIN both_ways t ON r.other = t.a)
SELECT n.doc_id, n.n AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN n USING (id) JOIN n o ON o.id = reach.other GROUP BY n.id, n.doc_id, n.n
"""
