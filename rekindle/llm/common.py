"""Helpers shared by the operators: written stages, uniform hashes, ordered ranks and prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rekindle.session import checkpoint_dir, persisted

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of text that an Arrow batch to a Python worker holds at most (or one longer text).
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of ``most`` bytes instead of 64 MB: texts are long, and each task holds a few copies of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and read back from the shared folder.

    The table is written as Parquet below ``spark.checkpoint.dir``, so a lost
    executor costs no recomputation and the planner knows its true size (which
    is what decides on a broadcast).  Where the setting is absent the table is
    persisted until ``rekindle.session.release``.
    """
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if not folder:
        return persisted(df)
    path = f"{folder.rstrip('/')}/rekindle-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """Uniform double in [0, 1) from a seeded 64-bit hash; order-preserving in the hash's top 53 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def bucket_prefix(df: DataFrame, group: list[str], bucket: str, sums: dict[str, Column]) -> DataFrame:
    """Totals of all earlier buckets of the same group, one row per (group, bucket).

    ``df`` is pre-aggregated map-side to (group, bucket); the window then sees
    one row per bucket.  Callers choose about sqrt(rows) buckets a group, so
    neither a bucket nor the list of buckets of a hot group outgrows a task.
    """
    totals = df.groupBy(*group, bucket).agg(*[c.alias(f"_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, bucket, *[
        F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(n) for n in sums])


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the keys appear once."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(F.col(f"_r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def identity(*cols: Column) -> Column:
    """A row's key from its columns, NULL told from every value: two seeded 64-bit hashes (128 bits), as a struct."""
    flagged = [x for c in cols for x in (c.isNull(), c)]
    return F.struct(F.xxhash64(F.lit(0), *flagged).alias("a"), F.xxhash64(F.lit(1), *flagged).alias("b"))


#: A key with more than this part of all rows is joined by broadcast in ``spread_join``; there are fewer such keys than 1 / part.
HEAVY = 1 / 500


def spread_join(rows: DataFrame, per_key: DataFrame, keys: list[str], n: str, how: str = "left") -> DataFrame:
    """``rows`` joined to ``per_key`` (a row a key, with its number ``n`` of rows of ``rows``), NULL equal to NULL.

    The rows of one key may be a third of all.  Keys with more than ``HEAVY`` of
    the rows (fewer than 1 / ``HEAVY`` keys by counting, so their table has a
    proven bound) meet their rows by broadcast, where the rows lie; the rest
    meet by a shuffle in which no key has more.  ``n`` is left out.
    """
    per_key = written(per_key, "spread-keys")
    most = F.lit(HEAVY) * per_key.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n")).scalar()
    heavy = F.broadcast(per_key.filter(F.col(n) > most).drop(n))
    light = per_key.filter(F.col(n) <= most).drop(n)
    marked = null_safe(rows, heavy.select(*keys).withColumn("_heavy", F.lit(True)), keys, "left")
    some = null_safe(marked.filter("_heavy").drop("_heavy"), heavy, keys)
    rest = null_safe(marked.filter("_heavy is null").drop("_heavy"), light, keys, how)
    return some.unionByName(rest)
