"""Session construction and lineage cutting.

Library code never picks a machine-local folder: the checkpoint folder is
whatever the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "rekindle", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


_KEPT: list[DataFrame] = []
_FOLDERS: list[tuple[SparkSession, str]] = []
_TABLES: list[tuple[SparkSession, str]] = []


def persisted(df: DataFrame) -> DataFrame:
    """The table computed once and kept on the executors until :func:`release`
    (a lost block is recomputed from its lineage)."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    _KEPT.append(kept)
    return kept


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path that driver and executors share: below ``spark.checkpoint.dir``, or below
    the warehouse where that is unset.  :func:`release` deletes it."""
    base = checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append((spark, path))
    return path


def bucketed(df: DataFrame, keys: list[str], name: str = "table", buckets: int | None = None) -> DataFrame:
    """The table stored in the warehouse in hash buckets of ``keys``, sorted in each.

    Joins and aggregates on ``keys`` read it without an exchange of its rows, and so do
    both sides of a join of two tables of one bucket count (by default that of
    ``spark.sql.shuffle.partitions``).  A bucket is one task, so the keys should be close
    to unique (an order code, not a member).  :func:`release` drops the table."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys)  # a file a bucket
       .saveAsTable(table))
    _TABLES.append((spark, table))
    return spark.table(table)


def release() -> None:
    """Drop the tables persisted or bucketed so far and the folders given out by
    :func:`shared_folder`."""
    while _KEPT:
        _KEPT.pop().unpersist(blocking=False)
    while _TABLES:
        spark, table = _TABLES.pop()
        spark.sql(f"drop table if exists {table}")
    while _FOLDERS:
        spark, folder = _FOLDERS.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows that a partition of a training table holds at most (beyond one partition a core).
TRAIN_ROWS = 1 << 19


def in_few_partitions(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (``rows`` rows) in one partition a core, or more where those would hold over ``TRAIN_ROWS``.

    For training: every partition sends its own statistics of all nodes, features and
    bins at every level of every tree, so what is exchanged grows with the number of
    partitions.  They are put together where they lie, without an exchange of rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(1, cores, -(-rows // TRAIN_ROWS)))


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut a long lineage before several consumers or an iterative one.

    With a shared ``spark.checkpoint.dir`` the table is written there as Parquet,
    from the one computation of its plan, and read back: it survives executor loss,
    and readers decode only the columns (and, by statistics, the rows) they ask for,
    where a checkpoint file holds whole serialized rows.  The files stay, as
    checkpoint files do, for the owner of that folder.  Without a shared folder the
    table is persisted (memory and disk) until :func:`release`, and a lost block is
    recomputed from its lineage.  No machine-local folder is ever chosen here.
    """
    spark = df.sparkSession
    d = checkpoint_dir(spark)
    if not d:
        return persisted(df)
    path = f"{d.rstrip('/')}/rekindle/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
