"""Column expressions shared by every operator.

This is the single home of the semantic traps listed in the survey (T1-T3,
T7, T13, T21, T25): each is decided once here, as a built-in Spark
expression, so that every operator evaluates inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ts(c: str | Column) -> Column:
    """Date or timestamp -> timestamp without time zone (midnight for dates)."""
    return col(c).cast(T.TimestampNTZType())


def floor_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole days between two instants, floored (17:55 on D to D+10 -> 9).

    ``datediff`` would give 10, ``timestampdiff(DAY)`` truncates toward zero;
    both differ from the floor of the fractional day count.
    """
    micros = F.timestamp_diff("MICROSECOND", as_ts(earlier), as_ts(later))
    return F.floor(micros / F.lit(float(MICROS_PER_DAY)))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """NULL when the denominator is 0 or NULL or the numerator NULL.

    Both sides are cast to double first (T25: no decimal rounding)."""
    n = col(num).cast("double")
    d = col(den).cast("double")
    return F.when(d.isNull() | (d == 0) | n.isNull(), F.lit(None).cast("double")) \
            .otherwise(n / d)


def flag(cond: Column) -> Column:
    """A comparison that is NULL (a NaN in pandas) counts as False -> 0/1 int."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def nonzero_or_null(c: str | Column, null_is_true: bool = True) -> Column:
    """``x != 0`` where a missing x counts as True (pandas NaN != 0)."""
    return F.coalesce(col(c) != 0, F.lit(null_is_true))


def is_not(c: str | Column, value: str) -> Column:
    """``c != value`` with NULL counting as 'not equal' (pandas semantics)."""
    return F.coalesce(col(c) != F.lit(value), F.lit(True))


def clip(c: str | Column, lo, hi) -> Column:
    """Inclusive clip."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), col(c)))


def dormancy_threshold(ci: str | Column, k: float, lo: int, hi: int) -> Column:
    """int(clip(k * ci, lo, hi)) — truncated like ``astype('int32')``."""
    return clip(col(ci) * F.lit(k), lo, hi).cast("int")


def discount_floor(c: str | Column, floor: float = 0.01) -> Column:
    """Denominator floored at ``floor``; NULL stays NULL."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None).cast("double")) \
            .when(c < floor, F.lit(floor)).otherwise(c.cast("double"))


def sentinel_to_null(c: str | Column, sentinel) -> Column:
    """Value equal to the sentinel -> NULL."""
    c = col(c)
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)


def fill_unknown(df: DataFrame, cols: Iterable[str], value: str = "unknown") -> DataFrame:
    """P5: categorical NULL -> 'unknown'."""
    return df.fillna(value, subset=list(cols))


def round_half_away(c: str | Column, digits: int = 6) -> Column:
    """``round(x * 10^d) / 10^d`` in double arithmetic, half away from zero,
    and -0.0 normalised to 0.0: the rounding of common SQL engines, so equal
    doubles round to equal doubles in both (no tie ambiguity)."""
    scale = float(10 ** digits)
    return F.round(col(c) * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (float sums depend on addition order)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_half_away(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def exact_sum(c: str | Column, scale: int = 6) -> Column:
    """Order-independent money sum: add as DECIMAL, return double (survey §4.7)."""
    return F.sum(col(c).cast(T.DecimalType(38, scale))).cast("double")


def weekday0(c: str | Column) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.dayofweek``)."""
    return F.weekday(col(c))
