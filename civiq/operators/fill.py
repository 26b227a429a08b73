"""Filling missing numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiq.functions.values import nan_to_null, quoted
from civiq.operators.columns import numeric_columns
from civiq.operators.quantiles import profile
from civiq.operators.stats import melted

STRATEGIES = ("mean", "median", "mode", "zero")


def fill_constant(df: DataFrame, value: float, columns: list[str] | None = None) -> DataFrame:
    """Null and NaN to a constant, in the given or in all numeric columns."""
    columns = columns or numeric_columns(df)
    clean = nan_to_null(df)
    filled = {c: F.coalesce(quoted(c), F.lit(value).cast(df.schema[c].dataType)) for c in columns}
    return clean.withColumns(filled) if filled else clean


def fill_missing(df: DataFrame, strategy: str = "mean") -> DataFrame:
    """Fill each numeric column with its mean, median, mode or zero; a column without values stays null.

    Mean and mode are a one-row scalar subquery, medians are constants found
    before: no join. Mean and median make integer columns double, as a fraction
    must fit. The smallest mode wins a tie.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    columns = numeric_columns(df)
    if strategy == "zero" or not columns:
        return fill_constant(df, 0, columns)
    clean = nan_to_null(df)
    if strategy == "median":
        found = profile(melted(clean, columns), [0.5])
        medians = {c: F.lit(found[c].quantiles[0.5] if c in found else None).cast("double") for c in columns}
        return clean.withColumns({c: F.coalesce(quoted(c).cast("double"), medians[c]) for c in columns})
    if strategy == "mean":
        stats = clean.agg(*[F.avg(quoted(c)).cast("double").alias(c) for c in columns])
    else:
        per_column = _modes(melted(clean, columns))
        stats = per_column.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])
    value = stats.select(F.struct(*[quoted(c) for c in columns]).alias("s")).scalar()
    kept = {c: clean.schema[c].dataType if strategy == "mode" else "double" for c in columns}
    return clean.withColumns({c: F.coalesce(quoted(c), value.getField(c)).cast(kept[c]) for c in columns})


def _modes(long: DataFrame) -> DataFrame:
    counts = long.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("x").alias("x")))
    return counts.groupBy("column").agg(best.alias("best")).select("column", F.col("best.x").alias("value"))
