"""Tag explosion and co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civiq.functions.tags import parse_tags, split_tag_literal
from civiq.functions.values import quoted
from civiq.operators.stats import value_counts


def explode_tags(df: DataFrame, column: str = "type", name: str = "type_list") -> DataFrame:
    """One row per tag; a set without tags keeps one row with a null tag, a null set goes."""
    present = df.filter(quoted(column).isNotNull())
    return present.withColumn(name, F.explode_outer(parse_tags(quoted(column))))


def cooccurrence(df: DataFrame, tag: str, column: str = "type") -> DataFrame:
    """How often each other tag shares a set with ``tag``, most frequent first.

    Sets are counted first, so the explode runs over distinct sets only. The
    filter is a regular-expression search; a one-tag set that passes counts for
    ``tag`` itself, and a tag repeated within a set counts each time.
    """
    sets = value_counts(df, column, "tag_set").filter(F.col("tag_set").rlike(tag))
    tags = split_tag_literal(F.col("tag_set"))
    others = F.when(F.size(tags) == 1, F.array(F.lit(tag))).otherwise(F.filter(tags, lambda t: t != tag))
    return (
        sets.select(F.explode(others).alias("tag"), "count")
        .groupBy("tag")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "tag")
    )
