"""Derived ticket columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiq.functions.dates import parse_any, parse_iso, strftime_to_pattern
from civiq.functions.values import quoted, text_to_double


def parse_timestamps(df: DataFrame, columns: tuple[str, ...] = ("timestamp", "last_activity"), on_error: str = "raise") -> DataFrame:
    return df.withColumns({c: parse_iso(quoted(c), on_error) for c in columns})


def add_date_parts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Year, month and number of days in that month."""
    ts = quoted(column)
    return df.withColumns({
        f"year_{column}": F.year(ts),
        f"month_{column}": F.month(ts),
        f"days_{column}": F.day(F.last_day(ts)),
    })


# Two commas or more: neither a longitude with a latitude nor a longitude alone.
_TOO_MANY_PARTS = "%,%,%"


def split_coordinates(df: DataFrame, column: str = "coords", on_error: str = "raise") -> DataFrame:
    """``"lon,lat"`` to two doubles. One part leaves latitude null; more than two parts are rejects."""
    text = quoted(column)
    kept = df.filter(text.isNull() | ~text.like(_TOO_MANY_PARTS))
    second = F.when(text.contains(","), F.substring_index(text, ",", -1))
    return kept.withColumns({
        "longitude": text_to_double(F.substring_index(text, ",", 1), on_error),
        "latitude": text_to_double(second, on_error),
    })


def coordinate_rejects(df: DataFrame, column: str = "coords") -> DataFrame:
    """The rows ``split_coordinates`` leaves out."""
    return df.filter(quoted(column).like(_TOO_MANY_PARTS))


def add_status_flag(df: DataFrame, column: str = "status", value: str = "active", name: str = "is_active") -> DataFrame:
    return df.withColumn(name, F.when(quoted(column) == value, True).otherwise(False))


def add_upper_name(df: DataFrame, column: str = "name", name: str = "name_upper") -> DataFrame:
    return df.withColumn(name, F.upper(F.trim(quoted(column))))


def _first_with(columns: list[str], *needles: str) -> str | None:
    return next((c for c in columns if any(n in c for n in needles)), None)


def cast_first_timestamp(df: DataFrame, column: str | None = None) -> DataFrame:
    """Tolerant timestamp cast of ``column``, or of the first one named like a time or date."""
    column = column or _first_with(df.columns, "time", "date")
    return df.withColumn(column, quoted(column).try_cast("timestamp")) if column else df


def cast_lat_lon(df: DataFrame, latitude: str | None = None, longitude: str | None = None) -> DataFrame:
    """Tolerant double casts of the first columns named like latitude and longitude; both must exist.

    The name search has false hits ("relation" contains "lat"): give the names where that matters.
    """
    latitude = latitude or _first_with(df.columns, "lat")
    longitude = longitude or _first_with(df.columns, "lon", "lng")
    if not (latitude and longitude):
        return df
    return df.withColumns({c: quoted(c).try_cast("double") for c in (latitude, longitude)})


def normalize_dates(
    df: DataFrame, columns: list[str], fmt: str = "%Y-%m-%d", patterns: list[str] | None = None
) -> DataFrame:
    """Date text in any of ``patterns`` to text in a strftime format; bad dates to null, unknown columns skipped."""
    pattern = strftime_to_pattern(fmt)
    return df.withColumns({
        c: F.date_format(parse_any(quoted(c), patterns), pattern) for c in columns if c in df.columns
    })
