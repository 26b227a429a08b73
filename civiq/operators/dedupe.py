"""Duplicates, ordering and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from civiq.functions.values import quoted
from civiq.session import scratch_dir


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_rare_duplicates(df: DataFrame, most: int = 4_000_000) -> DataFrame:
    """The rows of ``drop_exact_duplicates``, at less cost where rows are wide and few are repeated.

    Digests are counted first: 16 bytes a row are shuffled, whatever its width. Rows whose digest stands alone are unlike
    all others and stay where they are; only the rest is shuffled whole, and compared by value. The repeated digests are
    counted when this is called and broadcast up to ``most`` of them; beyond that, all rows are shuffled as usual.
    The rows are read twice.
    """
    own = "_digest"
    while any(c.lower().startswith(own) for c in df.columns):
        own += "_"
    cells = [quoted(c) for c in df.columns]
    # Two hashes of one row: the second starts from a constant, so that they differ.
    keys = [own + "a", own + "b"]
    marked = df.withColumns(dict(zip(keys, (F.xxhash64(*cells), F.xxhash64(F.lit(own), *cells)))))
    counts = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias(own + "n"))
    stored = scratch_dir(df.sparkSession, "digests")
    counts.filter(F.col(own + "n") > 1).select(*keys, F.lit(True).alias(own + "r")).write.parquet(stored)
    repeated = df.sparkSession.read.parquet(stored)
    if repeated.count() > most:
        return drop_exact_duplicates(df)
    told = marked.join(F.broadcast(repeated), keys, "left")
    alone = told.filter(F.col(own + "r").isNull()).select(*cells)
    return alone.unionByName(told.filter(F.col(own + "r")).select(*cells).dropDuplicates())


def keep_first(df: DataFrame, subset: list[str], order_by: list[str]) -> DataFrame:
    """One row per ``subset``: the first in ``order_by`` order.

    An aggregate, so each task sends at most one row per key into the shuffle
    and a hot key cannot pile up; ``dropDuplicates(subset)`` keeps an arbitrary row.
    """
    if not order_by:
        raise ValueError("keep_first needs order_by: rows have no order of their own")
    row = F.struct(*[quoted(c) for c in df.columns])
    rank = F.struct(*[quoted(c) for c in order_by])
    first = F.min_by(row, rank).alias("row")
    picked = df.groupBy(*[quoted(c) for c in subset]).agg(first)
    return picked.select(*[F.col("row").getField(c).alias(c) for c in df.columns])


def sort_descending(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Descending, with the tie columns ascending so the order is fixed."""
    return df.orderBy(quoted(column).desc(), *[quoted(t).asc() for t in ties])


def first_rows(df: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """The first ``n`` rows in the given order."""
    columns = [quoted(c) if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*columns).limit(n) if columns else df.limit(n)
