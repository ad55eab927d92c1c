"""Sharding by proportional stratified interleaving.

The rows of each source are put into a seeded random order; row r of n gets the
fractional rank (r - 1 + u) / n with one offset u per source; all rows are sorted
by fractional rank and the sorted list is cut into shards whose row counts differ
by one at most.  Any stretch of the list holds each source in proportion, so every
shard has the mixture of the whole.

Both orders (within a source, over all) are two-level ranks over about sqrt(rows)
ranges of a key that is uniform by construction; no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rekindle.llm.common import bucket_prefix, null_safe, unit_hash, written


def interleave(docs: DataFrame, *, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: int = 5) -> DataFrame:
    """doc_id, source, size, text_crc32, frac_rank, shard, slot for every row of ``docs``.

    size: UTF-8 bytes of the text plus 1 (NULL text: 1); text_crc32 unsigned
    (NULL text as empty).  slot counts from 0 in each shard without gaps.

    Defined cases: NULL sources form one source; NULL ids are ordered by their
    text's checksum; rows repeated in full each get a slot of their own; an
    empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = written(rows.withColumn("u", unit_hash(F.col("doc_id"), F.col("text_crc32"), F.col("size"), seed=seed)),
                   "shard-rows")
    sources = written(rows.groupBy("source").agg(F.count("*").alias("n"))
                      .withColumn("offset", unit_hash(F.col("source"), seed=seed + 1))
                      .withColumn("n_buckets", F.ceil(F.sqrt("n")).cast("long")), "shard-sources")
    rows = (null_safe(rows, sources, ["source"])
            .withColumn("bucket", F.floor(F.col("u") * F.col("n_buckets"))))
    first = bucket_prefix(rows, ["source"], "bucket", {"before": F.count("*")})
    in_bucket = Window.partitionBy("source", "bucket").orderBy("u", "doc_id", "text_crc32", "size")
    rows = (null_safe(rows, first, ["source", "bucket"])
            .withColumn("r", F.col("before") + F.row_number().over(in_bucket))
            .withColumn("frac_rank", (F.col("r") - 1 + F.col("offset")) / F.col("n"))
            .select("doc_id", "source", "size", "text_crc32", "r", "frac_rank"))
    total = sources.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_all")).scalar()
    rows = (rows.withColumn("n_all", total).withColumn("all", F.lit(0))
            .withColumn("stretch", F.floor(F.least(F.col("frac_rank"), F.lit(1.0 - 2.0 ** -50))
                                           * F.ceil(F.sqrt(F.col("n_all"))))))
    rows = written(rows, "shard-ranks")
    first = bucket_prefix(rows, ["all"], "stretch", {"before": F.count("*")}).drop("all")
    in_stretch = (Window.partitionBy("stretch")
                  .orderBy("frac_rank", F.col("source").asc_nulls_last(), "r"))
    pos = F.col("before") + F.row_number().over(in_stretch) - 1
    rows = rows.join(first, "stretch").withColumn("pos", pos)
    # integer arithmetic: position p is in shard floor(p * k / n), whose first position is ceil(shard * n / k)
    rows = rows.withColumn("shard", F.expr(f"int((pos * {int(n_shards)}L) div n_all)"))
    return rows.select("doc_id", "source", "size", "text_crc32", "frac_rank", "shard",
                       F.expr(f"pos - ((shard * n_all + {int(n_shards) - 1}L) div {int(n_shards)}L)").alias("slot"))


def op5_query(docs: DataFrame) -> DataFrame:
    return interleave(docs, n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")
