"""Scans and sinks.

Raw extracts arrive as CSV with a declared subset of typed columns and
timestamps in mixed text formats; every scan declares its schema (no
inference pass over the data) and parses timestamps with ``try_to_timestamp``
over a list of formats.  Sinks write Parquet / CSV with Spark writers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import FEATURE_COLS, ID_COLS
from ..operators.events import SAMPLE_COLS

# Raw header column -> canonical name.
ORDER_COLUMN_MAP = {
    "ShopMemberId": "member_id", "TradesGroupCode": "order_code", "OrderDateTime": "order_ts",
    "StatusDef": "status", "TotalSalesAmount": "sales_amount", "TsCount": "ts_count",
    "Qty": "qty", "TotalPrice": "total_price", "TotalDiscount": "total_discount",
    "TotalCouponDiscount": "total_coupon_discount", "ChannelType": "channel",
    "PaymentType": "payment", "ShippingType": "shipping", "ShopId": "shop_id",
}
LINE_COLUMN_MAP = {"ShopId": "shop_id", "ShopMemberId": "member_id", "TradesGroupCode": "order_code",
                   "OrderDateTime": "order_ts", "SalePageId": "sale_page_id", "Qty": "qty",
                   "UnitPrice": "unit_price", "StatusDef": "status"}
MEMBER_COLUMN_MAP = {"ShopId": "shop_id", "ShopMemberId": "member_id",
                     "RegisterSourceTypeDef": "register_source", "RegisterDateTime": "register_date",
                     "Gender": "gender", "Birthday": "birthday", "MemberCardLevel": "card_level",
                     "IsAppInstalled": "is_app_installed", "IsEnableEmail": "optin_email",
                     "IsEnablePushNotification": "optin_push", "IsEnableShortMessage": "optin_sms",
                     "CountryAliasCode": "country"}
NUMERIC = {"sales_amount", "ts_count", "qty", "total_price", "total_discount",
           "total_coupon_discount", "unit_price", "card_level"}
BOOLEAN = {"is_app_installed", "optin_email", "optin_push", "optin_sms"}
TIMESTAMP = {"order_ts", "register_date", "birthday"}


def parse_ts(c: str | Column, on_bad: str = "null") -> Column:
    """Mixed-format timestamp text -> timestamp_ntz.

    Dates with - or /, one- or two-digit fields, blank or T before the time,
    optional seconds and any number of fraction digits (kept to microseconds);
    a zone mark is dropped (wall-clock time).  Blank text is NULL.  Other text
    that is no timestamp is NULL, or fails the job with ``on_bad='error'``."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.trim(c.cast("string"))
    got = F.translate(text, "/", "-").try_cast(T.TimestampNTZType())
    if on_bad == "null":
        return got
    return F.when((F.length(text) > 0) & got.isNull(),
                  F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast(T.TimestampNTZType())).otherwise(got)


def unparsed_timestamps(df: DataFrame, cols) -> DataFrame:
    """Per text column: filled values, and how many of them are no timestamp -> column, filled, unparsed."""
    aggs = []
    for i, c in enumerate(cols):
        filled = F.length(F.trim(F.col(c).cast("string"))) > 0
        aggs += [F.count_if(filled).alias(f"f{i}"), F.count_if(filled & parse_ts(c).isNull()).alias(f"u{i}")]
    rows = ", ".join(f"'{c}', f{i}, u{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).select(F.expr(f"stack({len(cols)}, {rows}) as (column, filled, unparsed)"))


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Non-numeric text -> NULL (``try_cast``)."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in cols})


def _scan_csv(spark: SparkSession, path: str, colmap: dict, shop_id=None, on_bad_ts: str = "error") -> DataFrame:
    # header names, every column read as text (no inference pass), typed below by name
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if shop_id is not None:
        raw = raw.filter(F.col("ShopId") == F.lit(str(shop_id)))  # pushed into the scan
    missing = [src for src in colmap if src not in raw.columns]
    if missing:
        raise ValueError(f"columns {', '.join(missing)} not in {path}")
    return raw.select(*[_typed(src, dst, on_bad_ts).alias(dst) for src, dst in colmap.items()])


def _typed(src: str, dst: str, on_bad_ts: str) -> Column:
    if dst in TIMESTAMP:
        return parse_ts(src, on_bad_ts)
    if dst in NUMERIC:
        return F.col(src).try_cast("double")
    return F.col(src).try_cast("boolean") if dst in BOOLEAN else F.col(src)


def scan_checked(spark: SparkSession, path: str, colmap: dict, shop_id=None) -> tuple[DataFrame, DataFrame]:
    """S1 with a quarantine: (good rows, bad records), no record lost and none failing the job.

    A record is bad if it has more or fewer fields than the header (reason
    'fields') or text that is no timestamp in a timestamp column (the column's
    name; several reasons are joined by commas).  Good rows equal the plain scan's.
    Bad ones come as file, record (a torn line as it stands, any other record
    written as CSV again), reason.  Torn lines are kept whatever their shop, since
    their fields cannot be told apart.  Text that is no number is NULL as in S7,
    and an empty file gives two empty tables.  Each of the two tables reads the
    file when used."""
    names = spark.read.option("header", True).csv(path).columns
    torn = "_torn"
    while torn in names:
        torn += "_"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, torn]])
    # pruned columns would hide a wrong number of fields from the parser
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", torn).option("columnPruning", False).csv(path))
    missing = [src for src in colmap if src not in names]
    if missing:
        raise ValueError(f"columns {', '.join(missing)} not in {path}")
    if shop_id is not None:
        raw = raw.filter(F.col(torn).isNotNull() | (F.col("ShopId") == F.lit(str(shop_id))))
    whole = F.col(torn).isNull()
    reasons = [F.when(~whole, F.lit("fields"))] + [
        F.when(whole & (F.length(F.trim(src)) > 0) & parse_ts(src).isNull(), F.lit(dst))
        for src, dst in colmap.items() if dst in TIMESTAMP]
    reason = F.concat_ws(",", *reasons)
    good = raw.filter(reason == "").select(*[_typed(src, dst, "null").alias(dst) for src, dst in colmap.items()])
    bad = raw.filter(reason != "").select(
        F.input_file_name().alias("file"), F.coalesce(F.col(torn), F.to_csv(F.struct(*[F.col(c) for c in names]))).alias("record"),
        reason.alias("reason"))
    return good, bad


def write_quarantine(bad: DataFrame, path: str, mode: str = "append") -> None:
    """The bad records of a scan as a side table (Parquet, a folder per reason)."""
    bad.write.mode(mode).partitionBy("reason").parquet(path)


def scan_orders(spark: SparkSession, path: str, shop_id=None, colmap=ORDER_COLUMN_MAP,
                on_bad_ts: str = "error") -> DataFrame:
    """Order header CSV -> canonical orders (declared schema, mixed timestamps).

    ``on_bad_ts``: 'error' fails on text that is no timestamp, 'null' keeps the
    row without one (count them with ``unparsed_timestamps``)."""
    return _scan_csv(spark, path, colmap, shop_id, on_bad_ts)


def scan_lines(spark: SparkSession, path: str, shop_id=None, on_bad_ts: str = "error") -> DataFrame:
    """Order line CSV -> canonical lines (validity filter: features.scan_lines_valid)."""
    return _scan_csv(spark, path, LINE_COLUMN_MAP, shop_id, on_bad_ts)


def scan_member_csv(spark: SparkSession, path: str, shop_id=None, on_bad_ts: str = "error") -> DataFrame:
    """Member CSV -> canonical members (sentinels: features.scan_members)."""
    return _scan_csv(spark, path, MEMBER_COLUMN_MAP, shop_id, on_bad_ts)


def scan_pages(spark: SparkSession, path: str, shop_id=None) -> DataFrame:
    """Sale-page table, one tenant (loaded for completeness; F3 does not use it)."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    return df.filter(F.col("ShopId") == F.lit(shop_id)) if shop_id is not None else df


def write_samples(samples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: the sample table in its fixed column order, sorted by sample id (L3:
    range-partitioned, so the files follow each other), as Parquet."""
    samples.select(*SAMPLE_COLS).orderBy("sample_id").write.mode(mode).parquet(path)


def scan_samples(spark: SparkSession, path: str) -> DataFrame:
    """Read the sample table back (date kept as DATE)."""
    return spark.read.parquet(path).select(
        F.col("sample_id").cast("long"), F.col("label").cast("int"), "member_id",
        F.to_date("t0_date").alias("t0_date"), "t0_order_code", "split")


def write_split_features(features: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: assert unique sample ids, then write one folder per split, sorted by
    sample id (L3)."""
    from ..operators.features import check_unique_ids
    check_unique_ids(features)
    features.orderBy("split", "sample_id").write.mode(mode).partitionBy("split").parquet(path)


def scan_features(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, list[str]]:
    """Read a feature table and derive the feature column list (ids excluded)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        # typed by the known feature list: no schema-inference pass over the data
        from ..operators.features import CATEGORICAL_COLS
        raw = spark.read.option("header", True).csv(path)
        ints = {"sample_id": "long", "label": "int"}
        df = raw.select(*[F.col(c).try_cast(ints.get(c, "double")).alias(c)
                          if c in ints or (c not in ID_COLS and c not in CATEGORICAL_COLS)
                          else F.col(c) for c in raw.columns])
    from ..operators.model import feature_columns
    return df, feature_columns(df)


def write_metric_tables(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """K3: metric tables -> one CSV folder each.

    No ``coalesce(1)``: an aggregate arrives in one or a few partitions anyway
    (AQE coalesces small shuffles), and a large table passed here (e.g. the
    scored rows) is not funnelled through a single task."""
    for name, df in tables.items():
        df.write.mode(mode).option("header", True).csv(f"{folder.rstrip('/')}/{name}")


__all__ = ["FEATURE_COLS", "coerce_numeric", "parse_ts", "scan_features", "scan_lines",
           "scan_member_csv", "scan_orders", "scan_pages", "scan_samples", "unparsed_timestamps",
           "write_metric_tables", "write_samples", "write_split_features"]
