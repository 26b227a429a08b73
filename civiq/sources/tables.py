"""CSV, Parquet and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from civiq.functions.values import MISSING_PATTERN, NUMBER_PATTERN, SPECIAL_PATTERN, quoted, strip_blanks, text_to_double
from civiq.sources.blocks import is_large, opens_quote, read_csv_blocks

# The texts pandas reads as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_INTEGER = r"^[+-]?[0-9]+$"
_BOOLEAN = r"^(True|TRUE|true|False|FALSE|false)$"


def read_csv_text(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = True
) -> DataFrame:
    """A CSV with a header, every column a string; quoted newlines and doubled quotes are kept.

    Spark reads a multi-line file in one task; a file longer than a task's share goes to ``read_csv_blocks``, which
    finds the same records in many. Without quoted newlines, ``multiline=False`` needs no shuffle.
    """
    if multiline and is_large(spark, path):
        return read_csv_blocks(spark, path, schema)
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    multiline: bool = True, na_tokens: list[str] | None = None, on_error: str = "raise",
) -> DataFrame:
    """A CSV with missing-value tokens nulled and types taken from ``schema``, else inferred.

    A value that doesn't fit the schema raises, or is null with ``on_error="null"``.

    Inference reads the file once more: one aggregate, one row back to the driver.
    """
    text = read_csv_text(spark, path, multiline=multiline)
    tokens = NA_TOKENS if na_tokens is None else na_tokens
    text = text.select(*[F.when(~quoted(c).isin(tokens), quoted(c)).alias(c) for c in text.columns])
    if schema:
        return text.select(*[_typed(f, on_error).alias(f.name) for f in schema.fields])
    return infer_types(text)


def _typed(field: T.StructField, on_error: str) -> Column:
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    value = quoted(field.name).try_cast(field.dataType)
    if on_error == "null":
        return value
    bad = F.raise_error(F.concat(F.lit(f"column {field.name} cannot hold: "), quoted(field.name))).cast(field.dataType)
    return F.when(quoted(field.name).isNotNull(), F.coalesce(value, bad))


def reject_open_quotes(spark: SparkSession, path: str) -> None:
    """Raise if a line of the file ends inside a quoted value: such records need ``multiline=True``.

    A quote inside a value that doesn't start with one is a character like any other.
    """
    torn = spark.read.text(path).filter(opens_quote(F.col("value"))).first()
    if torn:
        raise ValueError(f"a quoted value holds a line break, read with multiline=True: {torn['value'][:80]!r}")


def infer_types(df: DataFrame) -> DataFrame:
    """Cast string columns that hold only integers, numbers or booleans; a column without values is double."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df

    def kind(column: Column) -> Column:
        """One bit per value: 1 an integer, 2 another number, 4 a boolean, 8 anything else."""
        text = strip_blanks(column)
        is_int = column.rlike(_INTEGER) | text.rlike(_INTEGER)
        is_float = text.rlike(NUMBER_PATTERN) | text.rlike(SPECIAL_PATTERN) | text.rlike(MISSING_PATTERN)
        return (
            F.when(is_int & column.try_cast("bigint").isNotNull(), 1)
            .when(is_float, 2).when(text.rlike(_BOOLEAN), 4).when(column.isNotNull(), 8)
        )

    kinds = df.agg(*[F.bit_or(kind(quoted(c))).alias(f"k{i}") for i, c in enumerate(strings)]).first()
    casts = {}
    for i, c in enumerate(strings):
        seen = kinds[f"k{i}"]
        if seen is None:
            casts[c] = F.lit(None).cast("double")
        elif seen == 1:
            casts[c] = quoted(c).try_cast("bigint")
        elif seen in (2, 3):
            casts[c] = text_to_double(quoted(c))
        elif seen == 4:
            casts[c] = strip_blanks(quoted(c)).try_cast("boolean")
    return df.withColumns(casts) if casts else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", records_per_file: int = 0) -> None:
    """CSV with a header and no index; blanks kept, quotes doubled, timestamps in ISO form.

    ``records_per_file`` starts a new file after so many. Files with quoted line breaks are best kept shorter than a task's
    share: they are read whole, without the shuffle that finds records in longer ones.
    """
    (
        df.write.mode(mode).option("header", True).option("escape", '"').option("maxRecordsPerFile", records_per_file)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[quoted(c) for c in columns]) if columns else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Parquet in the given mode (``ignore`` skips a target that exists), optionally by partition columns.

    With partition columns the rows are rebalanced on them first: few files per
    folder, and adaptive execution splits a folder that holds much of the data.
    """
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    gathered = df.hint("rebalance", *[quoted(c) for c in partition_by])
    gathered.write.mode(mode).partitionBy(*partition_by).parquet(path)


def _is_date_name(name: str) -> bool:
    lower = name.lower()
    return lower.endswith(("_at", "_time")) or lower.startswith("timestamp") or lower in ("modified", "date")


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False, coerce: bool = False
) -> DataFrame:
    """JSON records, one per line or (``multiline``) in a pretty-printed array.

    ``coerce`` turns numeric text into numbers and parses text columns named
    like dates, where every value allows it.
    """
    reader = spark.read.option("multiLine", multiline)
    df = (reader.schema(schema) if schema else reader).json(path)
    if not coerce:
        return df
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and _is_date_name(f.name)]
    if dated:
        fits = df.agg(*[
            F.coalesce(F.bool_and(F.when(quoted(c).isNotNull(), quoted(c).try_cast("timestamp").isNotNull())), F.lit(False)).alias(c)
            for c in dated
        ]).first()
        df = df.withColumns({c: quoted(c).try_cast("timestamp") for c in dated if fits[c]})
    return infer_types(df)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON records, one per line: a single array would be one task's work."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
