"""Renaming, choosing and ordering columns: schema work only, no job."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from civiq.functions.values import is_number, quoted


def _unique(names: list[str]) -> list[str]:
    """Number empty and repeated names, since Spark would call the repeated ones ambiguous."""
    taken: set[str] = set()
    out = []
    for position, name in enumerate(names, 1):
        base = name or f"col_{position}"
        candidate, suffix = base, 2
        while candidate in taken:
            candidate, suffix = f"{base}_{suffix}", suffix + 1
        taken.add(candidate)
        out.append(candidate)
    return out


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower snake case: every run outside a-z and 0-9 becomes one underscore, none at the ends."""
    return df.toDF(*_unique([re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") for c in df.columns]))


def clean_names(df: DataFrame) -> DataFrame:
    """Lower case, each space an underscore, other blanks stripped from the ends."""
    return df.toDF(*_unique([c.lower().replace(" ", "_").strip() for c in df.columns]))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns; a missing one is an error (Spark alone would ignore it)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"no such columns: {missing}")
    return df.drop(*[quoted(c) for c in columns])


def select_renamed(df: DataFrame, columns: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """A subset of columns in the given order, some under a new name."""
    renames = renames or {}
    return df.select(*[quoted(c).alias(renames.get(c, c)) for c in columns])


def order_columns(df: DataFrame, first: list[str]) -> DataFrame:
    """``first`` in front, the others sorted by name; names may hold dots."""
    rest = sorted(c for c in df.columns if c not in first)
    return df.select(*[quoted(c) for c in [*first, *rest]])


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_number(f.dataType) and f.name not in exclude]


def select_numeric(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Numeric columns only; booleans do not count."""
    return df.select(*[quoted(c) for c in numeric_columns(df, exclude)])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is null there."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
