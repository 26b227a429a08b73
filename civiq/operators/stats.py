"""Counts, profiles, summaries, correlations and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from civiq.functions.values import is_floating, is_number, is_timestamp, quoted, without_nan
from civiq.operators.quantiles import profile

QUARTILES = (0.25, 0.5, 0.75)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_count_exprs(df: DataFrame, columns: list[str], nan_is_missing: bool = False) -> list[Column]:
    out = []
    for c in columns:
        column = quoted(c)
        if nan_is_missing and is_floating(df.schema[c].dataType):
            column = without_nan(column)
        out.append(F.count_if(column.isNull()).alias(c))
    return out


def null_counts(df: DataFrame, columns: list[str] | None = None, nan_is_missing: bool = False) -> DataFrame:
    """Missing values per column as (column, nulls), all columns in one pass."""
    columns = columns or df.columns
    counts = df.agg(*null_count_exprs(df, columns, nan_is_missing))
    return counts.unpivot([], [quoted(c) for c in columns], "column", "nulls")


def value_counts(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """Rows per non-null value, unordered."""
    present = df.filter(quoted(column).isNotNull())
    return present.groupBy(quoted(column).alias(name)).agg(F.count(F.lit(1)).alias("count"))


def category_column(df: DataFrame) -> str | None:
    """The first column named like a type or a category."""
    return next((c for c in df.columns if "type" in c or "category" in c), None)


def top_categories(df: DataFrame, column: str | None = None, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values, null included; the value breaks ties."""
    column = column or category_column(df)
    if column is None:
        raise ValueError("no column named like a type or category")
    counts = df.groupBy(quoted(column).alias("category")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("category")).limit(n)


def group_size(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per non-null key."""
    present = df.filter(quoted(key).isNotNull())
    return present.groupBy(quoted(key).alias(key)).agg(F.count(F.lit(1)).alias(name))


def _as_double(column: Column, data_type: T.DataType) -> Column:
    if is_floating(data_type):
        return without_nan(column).cast("double")
    if isinstance(data_type, T.TimestampNTZType):
        # Difference to the epoch keeps zone-free time zone-free.
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, column).cast("double")
    if is_timestamp(data_type):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def melted(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles in long form (column, x), missing values left out."""
    wide = df.select(*[_as_double(quoted(c), df.schema[c].dataType).alias(c) for c in columns])
    return wide.unpivot([], [quoted(c) for c in columns], "column", "x").filter(F.col("x").isNotNull())


def summary_stats(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum as (column, stat, value, ts_value).

    Numbers fill ``value``; timestamps fill ``ts_value`` and have no deviation.
    A frame with neither gives count, unique, top and freq as (column, stat, value, top).
    All columns share the scans of ``profile``, whose first one gives the moments too.
    """
    fields = [f for f in df.schema.fields if is_number(f.dataType) or is_timestamp(f.dataType)]
    if not fields:
        return describe_categories(df)
    names = [f.name for f in fields]
    times = [f.name for f in fields if is_timestamp(f.dataType)]
    found = profile(melted(df, names), QUARTILES)
    stats = []
    for c in names:
        # A column without values still has its rows: the count is 0, the rest null.
        seen = found.get(c)
        cells = [("count", float(seen.n if seen else 0))]
        for stat in ("mean", "std", "low"):
            cells.append(({"low": "min"}.get(stat, stat), getattr(seen, stat, None)))
        cells += [(f"{int(p * 100)}%", seen.quantiles[p] if seen else None) for p in QUARTILES]
        cells.append(("max", getattr(seen, "high", None)))
        stats += [(c, stat, value) for stat, value in cells]
    table = df.sparkSession.createDataFrame(stats, "column string, stat string, v double")
    is_time = F.col("column").isin(times) & (F.col("stat") != "count")
    return table.select(
        "column", "stat",
        F.when(~is_time, F.col("v")).alias("value"),
        F.when(is_time & (F.col("stat") != "std"), F.timestamp_micros(F.col("v").cast("bigint"))).alias("ts_value"),
    )


def describe_categories(df: DataFrame) -> DataFrame:
    """Count, distinct values, the most frequent value and its frequency for every column."""
    long = df.select(*[quoted(c).cast("string").alias(c) for c in df.columns])
    long = long.unpivot([], [quoted(c) for c in df.columns], "column", "v").filter(F.col("v").isNotNull())
    counts = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    # Smallest text wins a tie: order by (-n, v).
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("v").alias("v"))).alias("best")
    stats = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best)

    def cell(stat: str, value: Column | None = None, top: Column | None = None) -> Column:
        number, text = F.lit(None) if value is None else value, F.lit(None) if top is None else top
        return F.struct(F.lit(stat).alias("stat"), number.cast("double").alias("value"), text.cast("string").alias("top"))

    return stats.select("column", F.inline(F.array(
        cell("count", F.col("count")), cell("unique", F.col("unique")),
        cell("top", top=F.col("best.v")), cell("freq", -F.col("best.neg")),
    )))


def _tiles(count: int, width: int) -> list[list[tuple[int, int]]]:
    """All pairs i <= j in tiles of ``width`` columns against ``width`` columns."""
    starts = range(0, count, width)
    return [
        [(i, j) for i in range(a, min(a + width, count)) for j in range(max(i, b), min(b + width, count))]
        for a in starts for b in starts if b >= a
    ]


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, tile: int | None = None) -> DataFrame:
    """Pearson correlation of every column pair as (row, col, corr), pairwise complete.

    Co-moments of a tile of column pairs are aggregated side by side, merged from task to task in one row: rows are
    neither stacked nor shuffled, whatever the number of columns. A tile reads its own columns only, and its width bounds
    the size of the compiled aggregate: few columns make tiles of 4, which Spark compiles into one loop, many make
    tiles of 12, which read each column less often. A column without variance gives null.
    """
    columns = columns or [f.name for f in df.schema.fields if is_number(f.dataType)]
    tile = tile or (4 if len(columns) <= 12 else 12)
    doubles = df.select(*[_as_double(quoted(c), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(columns)])
    found = None
    for pairs in _tiles(len(columns), tile):
        moments, cells = [], []
        for k, (i, j) in enumerate(pairs):
            x, y = F.col(f"c{i}"), F.col(f"c{j}")
            if i == j:
                moments.append(F.var_pop(x).alias(f"xx{k}"))
                corr = F.try_divide(F.col(f"xx{k}"), F.col(f"xx{k}"))
            else:
                moments += [
                    F.covar_pop(x, y).alias(f"xy{k}"), F.var_pop(F.when(y.isNotNull(), x)).alias(f"xx{k}"),
                    F.var_pop(F.when(x.isNotNull(), y)).alias(f"yy{k}"),
                ]
                # The built-in corr divides by zero, and so raises, for a column without variance.
                corr = F.try_divide(F.col(f"xy{k}"), F.sqrt(F.col(f"xx{k}")) * F.sqrt(F.col(f"yy{k}")))
            cells += [
                F.struct(F.lit(columns[a]).alias("row"), F.lit(columns[b]).alias("col"), corr.alias("corr"))
                for a, b in sorted({(i, j), (j, i)})
            ]
        part = doubles.agg(*moments).select(F.inline(F.array(*cells)))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else df.sparkSession.createDataFrame([], "row string, col string, corr double")


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 20) -> DataFrame:
    """Equal-width bins per column as (column, bin, left, right, count), empty bins included.

    The last bin is closed. The bounds table has one row per column, so its
    broadcast is bounded by the width of the schema.
    """
    columns = columns or [f.name for f in df.schema.fields if is_number(f.dataType)]
    long = melted(df, columns)
    extremes = long.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")  # a constant column gets one unit around its value
    bounds = extremes.select(
        "column",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)

    def edge(k: Column) -> Column:
        return F.when(k == bins, F.col("hi")).otherwise(F.col("lo") + k * F.col("width"))

    guess = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    # Rounding can put a value one bin off its own edges.
    settled = (
        F.when(F.col("x") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("x") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counted = (
        long.join(F.broadcast(bounds), "column")
        .withColumn("guess", guess)
        .groupBy("column", settled.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    frame = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    return frame.join(counted, ["column", "bin"], "left").select(
        "column", "bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )
