"""Model operators (M1-M3, M10, M11, M13, M15) with ``pyspark.ml``.

* M1 encode: categorical NULL -> 'unknown', ``StringIndexer`` fitted on train
  (alphabetical, unseen test values -> the extra 'keep' bucket, T20); numeric
  NULLs are imputed with the train median and flagged by an indicator column
  (Spark trees reject NaN, T24).
* M2 train: ``GBTClassifier`` (seeded).  The result is *not* meant to equal
  the reference's xgboost numbers; tests check properties.
* M11 attribution is re-aimed as permutation importance: every test row is
  exploded over the features, takes that one column from another row, is scored
  once, and the AUC drop is computed with the distributed AUC operator.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import in_few_partitions
from .events import row_index
from .features import ID_COLS
from .metrics import auc_ap, metric_table

def feature_columns(features: DataFrame, ids=ID_COLS) -> list[str]:
    """The columns a model may see.

    Ids, dates and the label are left out by name; anything else that is not a
    number, a flag or a category (a date or timestamp would carry t0) or that is
    named after the label is refused."""
    cols = [f for f in features.schema.fields if f.name not in ids]
    for f in cols:
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.StringType)):
            raise ValueError(f"{f.name}: {f.dataType.simpleString()} is no feature type")
        if "label" in f.name.lower().split("_"):
            raise ValueError(f"{f.name} is derived from the label")
    return [f.name for f in cols]


def split_types(features: DataFrame, cols: list[str]) -> tuple[list[str], list[str]]:
    types = {f.name: f.dataType.simpleString() for f in features.schema.fields}
    cats = [c for c in cols if types[c] == "string"]
    nums = [c for c in cols if c not in cats]
    return cats, nums


def encode_pipeline(cats: list[str], nums: list[str], empty: set[str] = frozenset()) -> list:
    """M1 stages: fill/cast + missing indicators, indexers, imputer, assembler.
    Columns in ``empty`` have no median to impute and get 0."""
    full = [c for c in nums if c not in empty]
    sel = ["*"] + [f"coalesce(CAST(`{c}` AS DOUBLE), 0D) AS `{c}__m`" for c in nums if c in empty] + [f"coalesce(`{c}`, 'unknown') AS `{c}__s`" for c in cats] \
        + [f"CAST(`{c}` AS DOUBLE) AS `{c}__d`" for c in nums] \
        + [f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}__na`" for c in nums]
    prep = SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")
    idx = [StringIndexer(inputCols=[f"{c}__s" for c in cats], outputCols=[f"{c}__i" for c in cats],
                         handleInvalid="keep", stringOrderType="alphabetAsc")] if cats else []
    imp = Imputer(inputCols=[f"{c}__d" for c in full], outputCols=[f"{c}__m" for c in full],
                  strategy="median") if full else None
    inputs = [f"{c}__i" for c in cats] + [f"{c}__m" for c in nums] + [f"{c}__na" for c in nums]
    asm = VectorAssembler(inputCols=inputs, outputCol="features_vec", handleInvalid="keep")
    return [prep, *idx, *([imp] if imp else []), asm]


def assembled_names(cats: list[str], nums: list[str]) -> list[str]:
    return list(cats) + list(nums) + [f"{c}__isna" for c in nums]


def most_categories(encode: PipelineModel) -> int:
    """Bins that the fitted category column with the most values needs (one is for unseen values)."""
    return max((len(x) + 1 for st in encode.stages if isinstance(st, StringIndexerModel) for x in st.labelsArray), default=0)


def fit_encoding(train: DataFrame, cats: list[str], nums: list[str]) -> tuple[DataFrame, PipelineModel]:
    """The train split with a double label, in few partitions, and the encoding fitted on it."""
    found = train.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(nums)]).first()
    empty = {c for i, c in enumerate(nums) if found[f"c{i}"] == 0}
    data = in_few_partitions(train.withColumn("label", F.col("label").cast("double")), found["rows"])
    return data, Pipeline(stages=encode_pipeline(cats, nums, empty)).fit(data)


def train_gbt(train: DataFrame, cols: list[str], seed: int = 42, max_iter: int = 40,
              max_depth: int = 5, min_bins: int = 64) -> PipelineModel:
    """M1 + M2: fit encoding and gradient-boosted trees on the train split.

    ``maxBins`` follows the fitted categories (a tree needs a bin for each, and
    one for unseen values), so a column of any cardinality trains.  A numeric
    column without a value in ``train`` is filled with 0 (there is no median)."""
    cats, nums = split_types(train, cols)
    data, encode = fit_encoding(train, cats, nums)
    most = most_categories(encode)
    gbt = GBTClassifier(featuresCol="features_vec", labelCol="label", seed=seed,
                        maxIter=max_iter, maxDepth=max_depth, maxBins=max(min_bins, most))
    return PipelineModel([*encode.stages, gbt.fit(encode.transform(data).select("label", "features_vec"))])


def save_model(model: PipelineModel, path: str) -> None:
    """M2: write the fitted encoding and trees (replacing what is there)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_split(model: PipelineModel, df: DataFrame, keep=("sample_id", "label", "split")) -> DataFrame:
    """M3: probability of class 1 -> keep columns + score."""
    out = model.transform(df.withColumn("label", F.col("label").cast("double")))
    return out.select(*[F.col(c) for c in keep if c != "label"],
                      F.col("label").cast("int").alias("label"),
                      vector_to_array("probability")[1].alias("score"))


def gain_importance(model: PipelineModel, cols: list[str], df: DataFrame) -> DataFrame:
    """The tree ensemble's importance per input column, ranked (the
    missing-indicator importance is added to its feature)."""
    cats, nums = split_types(df, cols)
    names = list(cats) + list(nums) + list(nums)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    agg: dict[str, float] = {}
    for n, v in zip(names, imp):
        agg[n] = agg.get(n, 0.0) + float(v)
    spark = df.sparkSession
    t = spark.createDataFrame(sorted(agg.items()), "feature string, gain double")
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("gain"), "feature")))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "sample_id") -> DataFrame:
    """L2: fixed-size reproducible sample — the n rows with the smallest
    xxhash64(id, seed) (``sample`` is not fixed-size)."""
    return (df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
              .orderBy("_h", id_col).limit(n).drop("_h"))


def permutation_importance(model: PipelineModel, test: DataFrame, cols: list[str],
                           seed: int = 42) -> DataFrame:
    """M11 (re-aimed): AUC drop when one feature column is taken from another row.

    Over all rows of ``test``.  The permutation is a cyclic shift of a seeded
    random order (range-partitioned on the hash, so no task holds the table);
    each row meets its donor once, is exploded over the feature numbers and
    scored in one pass, and the AUC is grouped by the number."""
    n_part = int(test.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = test.withColumn("_h", F.xxhash64(F.col("sample_id"), F.lit(seed + 1)))
    ix = row_index(hashed.repartitionByRange(n_part, "_h", "sample_id")
                   .sortWithinPartitions("_h", "sample_id"))
    total = ix.count()
    shift = max(1, int(total * 0.6180339887) % max(total, 1))
    donor = ix.select(((F.col("_idx") + shift) % F.lit(max(total, 1))).alias("_idx"),
                      *[F.col(c).alias(f"__d_{c}") for c in cols])
    each = ix.join(donor, "_idx").withColumn(
        "permuted", F.explode(F.sequence(F.lit(-1), F.lit(len(cols) - 1))))  # -1: as it is
    each = each.select("permuted", "sample_id", "label", "split",
                       *[F.when(F.col("permuted") == i, F.col(f"__d_{c}")).otherwise(F.col(c)).alias(c)
                         for i, c in enumerate(cols)])
    auc = auc_ap(score_split(model, each, keep=("permuted", "sample_id", "label", "split")), by="permuted")
    base = auc.filter("permuted = -1").select("auc_roc").scalar()
    names = F.array(*[F.lit(c) for c in cols])
    return (auc.filter("permuted >= 0")
            .select(F.get(names, F.col("permuted")).alias("feature"), base.alias("auc_base"),
                    F.col("auc_roc").alias("auc_perm"))
            .withColumn("delta_auc", F.col("auc_base") - F.col("auc_perm"))
            .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("delta_auc"), "feature"))))


def evaluate(scored: DataFrame, name: str, by: str = "split", threshold: float = 0.5) -> DataFrame:
    """M9 row(s) for one model: auc_roc, auc_pr, brier, precision, recall, f1."""
    keys = [by] if by else []
    return metric_table(scored, by, threshold).select(
        F.lit(name).alias("model"), *keys, "auc_roc", F.col("average_precision").alias("auc_pr"),
        "brier", "precision", "recall", "f1")


def ablation(train: DataFrame, test: DataFrame, cols: list[str], drop_cols, seed: int = 42,
             **gbt_kw) -> DataFrame:
    """Full model vs the model without ``drop_cols`` on the test split,
    with the AUC difference."""
    reduced = [c for c in cols if c not in set(drop_cols)]
    m_full = train_gbt(train, cols, seed, **gbt_kw)
    m_red = train_gbt(train, reduced, seed, **gbt_kw)
    r = evaluate(score_split(m_full, test), "full", by="split").unionByName(
        evaluate(score_split(m_red, test), "reduced", by="split"))
    full_auc = F.max(F.when(F.col("model") == "full", F.col("auc_roc"))).over(Window.partitionBy("split"))
    return r.withColumn("delta_auc", full_auc - F.col("auc_roc"))


def key_feature_ranks(importance: DataFrame, watch: list[str]) -> DataFrame:
    """Rank of each watched feature in an importance table (NULL if absent)."""
    spark = importance.sparkSession
    w = spark.createDataFrame([(f,) for f in watch], "feature string")
    return w.join(importance.select("feature", "rank"), "feature", "left")
