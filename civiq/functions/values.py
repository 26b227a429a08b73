"""Missing values and text-to-number conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What Python's float() takes once surrounding blanks are gone; Spark alone would also take "1d".
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
SPECIAL_PATTERN = r"^[+-]?(?i:inf|infinity)$"
MISSING_PATTERN = r"^[+-]?(?i:nan)$"
PLAIN_PATTERN = r"^[0-9+.eE-]+$"
BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DoubleType, T.FloatType))


def is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def is_timestamp(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType))


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: list[str], base: str) -> str:
    """``base``, with underscores behind it until no taken name equals it, whatever the case."""
    lower = {t.lower() for t in taken}
    while base.lower() in lower:
        base += "_"
    return base


def without_nan(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column: one notion of "missing"."""
    names = [f.name for f in df.schema.fields if is_floating(f.dataType)]
    return df.withColumns({n: without_nan(quoted(n)) for n in names}) if names else df


def strip_blanks(column: Column) -> Column:
    """Trim every Unicode blank; the built-in trim only knows the space."""
    return F.regexp_replace(column, BLANKS, "")


def text_to_double(column: Column, on_error: str = "raise") -> Column:
    """Text to double with Python's rules; a bad value raises, or is null with ``on_error="null"``."""
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    text = strip_blanks(column)
    # Text of these characters alone means the same to both; the rest takes the longer way.
    parsed = F.coalesce(
        F.when(column.rlike(PLAIN_PATTERN), column.try_cast("double")),
        F.when(text.rlike(NUMBER_PATTERN) | text.rlike(SPECIAL_PATTERN), text.try_cast("double")),
    )
    if on_error == "null":
        return parsed
    bad = F.raise_error(F.concat(F.lit("not a number: "), column)).cast("double")
    return F.coalesce(parsed, F.when(column.isNotNull() & ~text.rlike(MISSING_PATTERN), bad))


def text_to_bigint(column: Column) -> Column:
    """Strict integer cast: a bad value raises whatever the session's ANSI setting is."""
    parsed = column.try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit("not an integer: "), column.cast("string"))).cast("bigint")
    return F.when(column.isNotNull(), F.coalesce(parsed, bad))
