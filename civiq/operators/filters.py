"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiq.functions.values import quoted
from civiq.schemas import PROVINCE_NAME, PROVINCE_PATTERN, REQUIRED_TICKET_COLUMNS


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows missing any of ``columns`` (null or NaN)."""
    return df.dropna(subset=list(columns or REQUIRED_TICKET_COLUMNS))


def keep_present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNotNull())


def keep_years(df: DataFrame, start: int, stop: int, column: str = "timestamp") -> DataFrame:
    """Years ``start..stop``, both included.

    A half-open range on the timestamp itself, so a Parquet scan can use it;
    a filter on ``year(column)`` could not be pushed down.
    """
    data_type = df.schema[column].dataType
    low = F.lit(f"{start:04d}-01-01").cast(data_type)
    high = F.lit(f"{stop + 1:04d}-01-01").cast(data_type)
    return df.filter((quoted(column) >= low) & (quoted(column) < high))


def keep_province(
    df: DataFrame, column: str = "province", pattern: str = PROVINCE_PATTERN, name: str = PROVINCE_NAME
) -> DataFrame:
    """Rows whose province contains ``pattern`` (or is ``name``), under the full name; null goes."""
    province = quoted(column)
    return df.filter(province.rlike(pattern) | (province == name)).withColumn(column, F.lit(name))


def keep_not_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose value differs; null differs from everything."""
    return df.filter(~quoted(column).eqNullSafe(value))


def keep_tag(df: DataFrame, tag: str, column: str = "type_list") -> DataFrame:
    return df.filter(quoted(column) == tag)


def keep_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """A regular-expression search, not set membership: a longer tag matches too."""
    return df.filter(quoted(column).rlike(pattern))


def any_missing(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str) -> DataFrame:
    """One row, one boolean ``missing``: is any value of ``column`` absent from the other table?"""
    values = df.select(quoted(column).alias("value")).distinct()
    known = allowed.select(quoted(allowed_column).alias("known")).distinct()
    absent = values.join(known, values.value.eqNullSafe(known.known), "left_anti").limit(1)
    return absent.agg((F.count(F.lit(1)) > 0).alias("missing"))


def keep_agreeing(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows in which both columns of every pair hold the same, non-null value."""
    for left, right in pairs:
        df = df.filter(quoted(left) == quoted(right))
    return df
