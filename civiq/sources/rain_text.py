"""Landed rain reports: one text file per date, the date in the file's path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Line ends that a text scan does not split on but Python's splitlines does.
_MORE_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def date_in_path(path: Column) -> Column:
    """The first ``yyyy-MM-dd`` or ``dd-MM-yyyy`` of a path as ``dd/MM/yyyy`` text; null without one."""
    iso = F.regexp_extract(path, r"(\d{4})-(\d{2})-(\d{2})", 0)
    day_first = F.regexp_extract(path, r"(?<!\d)(\d{2})-(\d{2})-(\d{4})", 0)
    return F.when(
        iso != "", F.concat_ws("/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4))
    ).when(day_first != "", F.regexp_replace(day_first, "-", "/"))


def as_report_lines(text: DataFrame, path: Column) -> DataFrame:
    """(Date, day, line): the date as text and as a date."""
    return text.select(
        date_in_path(path).alias("Date"),
        F.explode(F.split("value", _MORE_LINE_ENDS)).alias("line"),
    ).select("Date", F.try_to_timestamp("Date", F.lit("dd/MM/yyyy")).cast("date").alias("day"), "line")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).text(path)
    return as_report_lines(text, F.col("_metadata.file_path"))
