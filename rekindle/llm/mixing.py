"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a weight; a budget (a share of all words) is split over the
sources by weight, a source's target stops at ``max_epochs`` times its size and
the excess is shared again by weight (water filling, solved in closed form over
the sorted fill levels).  A source whose target holds e complete epochs takes
each document e times; the remaining fraction goes to the documents with the
smallest exponential keys ``-ln(u) / quality_weight`` (the Efraimidis-Spirakis
order), up to the prefix sum of sizes nearest to the remainder.  ``u`` is a hash
of seed and document id, so a rerun takes the same documents.

Only DataFrame functions.  The text is reduced to sizes in one pass; ordering a
source is a two-level prefix sum over sqrt(rows) key ranges, so a source with a
third of all rows is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rekindle.llm.common import WORD, bucket_prefix, identity, null_safe, spare_names, written

SYMBOLS = "#*$%&|<>!"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def symbol_free_share(text: Column) -> Column:
    """Quality weight in [0.5, 1]: 0.5 plus half the share of characters that are no symbols."""
    n = F.length(text)
    clean = F.length(F.translate(text, SYMBOLS, ""))
    return F.when(n > 0, 0.5 + 0.5 * (clean / n)).otherwise(F.lit(0.5))


def source_targets(sources: DataFrame, cycle: tuple[int, ...], budget_share: float,
                   max_epochs: float) -> DataFrame:
    """(source, source_size, n) -> the same with ``target``; one row per source (the list of the mixture's parts)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in cycle]),
                          ((F.row_number().over(by_name) - 1) % len(cycle) + 1).cast("int"))
    s = sources.withColumn("w", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    everything = Window.partitionBy()
    upto = (Window.orderBy("fill", F.col("source").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = (s.withColumn("fill", F.col("cap") / F.col("w"))
         .withColumn("w_all", F.sum("w").over(everything))
         .withColumn("budget", F.lit(float(budget_share)) * F.sum("source_size").over(everything))
         .withColumn("cap_upto", F.sum("cap").over(upto))
         .withColumn("w_upto", F.sum("w").over(upto))
         .withColumn("capped", F.col("cap_upto") + F.col("fill") * (F.col("w_all") - F.col("w_upto"))
                     < F.col("budget")))
    s = (s.withColumn("cap_used", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything))
         .withColumn("w_open", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(everything)))
    share = F.col("w") * (F.col("budget") - F.col("cap_used")) / F.col("w_open")
    return s.select("source", "source_size", "n",
                    F.when(F.col("capped"), F.col("cap")).otherwise(F.least(share, F.col("cap"))).alias("target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        size: Column | None = None, quality_weight: Column | None = None,
        cycle: tuple[int, ...] = (5, 2, 1), budget_share: float = 1.5, max_epochs: int = 2,
        seed: int = 3, row: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken (= copies * size), copies, key, row for every row of ``docs``.

    ``row`` is carried along (NULL by default), for a join with the documents.

    ``size`` defaults to the number of words, ``quality_weight`` (clipped to
    [0.01, 100]; NULL or NaN counts as 1) to ``symbol_free_share``.  Weights
    ``cycle`` go round over the sources in code-point order, NULL last.

    Defined cases: a NULL or empty text has size 0 and takes 0 words; NULL
    sources form one source; equal keys go by id; rows repeated in full count
    each for themselves; an empty table gives an empty result; other columns
    are ignored.  An unpopulated budget (all sizes 0) gives target 0.
    """
    text = F.col(text_col)
    size = word_count(text) if size is None else F.coalesce(size, F.lit(0)).cast("long")
    w = symbol_free_share(text) if quality_weight is None else quality_weight
    w = F.when(w.isNull() | F.isnan(w), F.lit(1.0)).otherwise(F.least(F.greatest(w, F.lit(0.01)), F.lit(100.0)))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
                               .cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + 1) / F.lit(float(1 << 52))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               size.alias("size"), w.cast("double").alias("w"), u.alias("u"),
                               (F.lit(None).cast("bigint") if row is None else row).alias("row"))
                   .select("doc_id", "source", "size", "w", "row", (-F.log("u") / F.col("w")).alias("key")), "mix-rows")

    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"),
                                         F.avg("w").alias("w_mean"))
    means = sources.select("source", "w_mean")
    targets = null_safe(source_targets(sources, cycle, budget_share, max_epochs), means, ["source"])
    targets = written(targets.select(
        "source", "source_size", "target",
        F.ceil(F.sqrt("n")).cast("long").alias("n_buckets"), "w_mean",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("long").alias("epochs")), "mix-targets")
    # keys are exponential with a rate near the mean weight, so this range number is near uniform
    rows = (null_safe(rows, targets, ["source"])
            .withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key") * F.col("w_mean"))) * F.col("n_buckets")),
                                          F.col("n_buckets") - 1)))
    before_bucket = bucket_prefix(rows, ["source"], "bucket", {"bucket_before": F.sum("size")})
    rows = null_safe(rows, before_bucket, ["source", "bucket"])
    earlier = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = F.col("bucket_before") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    return (rows.withColumn("copies", F.col("epochs") + F.when(before + F.col("size") / 2 <= rest, 1)
                            .otherwise(0).cast("long"))
            .withColumn("copies", F.least(F.col("copies"), F.lit(int(max_epochs)).cast("long")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies", "key", "row"))


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as ``mix`` takes it (0 times and more); columns unchanged.

    Rows equal in all columns (NULL equal to NULL only) are one row with the sum of their copies.
    """
    row, copies, copy = spare_names(docs, "_row", "_copies", "_copy")
    keyed = docs.select("*", identity(*[docs[c] for c in docs.columns]).alias(row))
    taken = (mix(keyed, row=F.col(row), **options).groupBy(F.col("row").alias(row))
             .agg(F.sum("copies").cast("int").alias(copies)).filter(F.col(copies) > 0))
    return (keyed.dropDuplicates([row]).join(taken, row)
            .select(*docs.columns, F.explode(F.array_repeat(F.lit(True), F.col(copies))).alias(copy)).drop(copy))


def op3_query(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         CASE WHEN length(text) > 0
              THEN 0.5 + 0.5 * (CAST(length(translate(text, '{SYMBOLS}', '')) AS DOUBLE) / length(text))
              ELSE 0.5 END AS w,
         (CAST('0x' || substr(md5('3:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 1)
           / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
              2.0 * CAST(source_size AS DOUBLE) AS cap FROM s0),
s2 AS (SELECT *, cap / w AS fill, sum(w) OVER () AS w_all,
              1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM s1),
s3 AS (SELECT *, sum(cap) OVER (ORDER BY fill, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS cap_upto,
              sum(w) OVER (ORDER BY fill, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS w_upto FROM s2),
s4 AS (SELECT *, cap_upto + fill * (w_all - w_upto) < budget AS capped FROM s3),
s5 AS (SELECT *, sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS cap_used,
              sum(CASE WHEN capped THEN 0 ELSE w END) OVER () AS w_open FROM s4),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN cap ELSE least(w * (budget - cap_used) / CAST(w_open AS DOUBLE), cap) END AS target
      FROM s5),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
k AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / d.w, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(least(epochs + CASE WHEN before + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END, 2) * size
            AS BIGINT) AS taken
FROM k
"""
