"""Tag-set text such as ``{a,b}``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_tags(column: Column) -> Column:
    """Brackets and quotes removed, split on commas, blanks trimmed, empties dropped; null gives [].

    Runs of commas and blanks are cut in the regular expressions, so no
    per-element lambda is needed and the expression stays in generated code.
    """
    bare = F.regexp_replace(F.translate(column, "{}'\"", ""), r"(?U)^[\s,]+|[\s,]+$", "")
    empty = F.array().cast("array<string>")
    return F.when(bare != "", F.split(bare, r"(?U)\s*,[\s,]*")).otherwise(empty)


def split_tag_literal(column: Column) -> Column:
    """Brackets stripped from both ends, split on commas; blanks, quotes and empties stay."""
    return F.split(F.regexp_replace(column, r"^[{}]+|[{}]+$", ""), ",", -1)
