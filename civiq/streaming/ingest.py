"""Each landed file is taken in exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from civiq.functions.values import quoted
from civiq.operators.rain import DATE_PATTERN, extract_readings, pivot_stations
from civiq.session import scratch_dir
from civiq.sources.rain_text import as_report_lines

Transform = Callable[[DataFrame], DataFrame]


def ingest_landed(
    spark: SparkSession, source: str, target: str, checkpoint: str,
    schema: str, fmt: str = "parquet", transform: Transform | None = None, files_per_batch: int = 10000,
) -> None:
    """Append the files landed since the last run to a Parquet table, then stop.

    The checkpoint remembers the files, and the file sink's log makes a rerun
    after a failure write nothing twice. A backlog is worked off in batches of
    ``files_per_batch`` files. Empty files carry no rows.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", True)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    landed = reader.load(source).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    present = landed.filter(F.col("_size") > 0).drop("_size")
    rows = transform(present) if transform else present.drop("_path")
    query = (
        rows.writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def ingest_rain_reports(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """New report files as (Date, Station, WaterLevel) rows; pivot the target when a wide table is wanted."""
    ingest_landed(
        spark, source, target, checkpoint, "value string", "text",
        lambda text: extract_readings(as_report_lines(text, F.col("_path"))),
    )


def ingest_wide_history(
    spark: SparkSession, source: str, target: str, checkpoint: str, stations: list[str], files_per_batch: int = 10000,
) -> None:
    """New report files into the wide table, one row per date and one column per station, kept in a folder per ``month``.

    A date that is landed, or landed again, replaces its row; only the months of such dates are read and written, once a run,
    by a dynamic partition overwrite. Batches are stored beside the checkpoint until they are merged: one that is repeated
    after a failure writes the same rows again, and a run goes on with those an earlier one left. Two readings for one date and
    station in one batch raise, as does a station that isn't listed; batches before that one are merged by the run that succeeds.
    """
    staged = f"{checkpoint}/staged"

    def stage(batch: DataFrame, number: int) -> None:
        rows = pivot_stations(extract_readings(as_report_lines(batch, F.col("_path"))), stations)
        rows.write.mode("overwrite").parquet(f"{staged}/batch={number}")

    reader = spark.readStream.format("text").schema("value string").option("recursiveFileLookup", True)
    landed = reader.option("maxFilesPerTrigger", files_per_batch).load(source)
    present = landed.select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    query = (
        present.filter(F.col("_size") > 0).drop("_size").writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if _exists(spark, staged):
        _merge_history(spark, staged, target)
        _delete(spark, staged)


def _merge_history(spark: SparkSession, staged: str, target: str) -> None:
    """The staged rows into the months of the wide table; of several rows for a date that of the latest batch."""
    rows = spark.read.parquet(staged)
    rest = [quoted(c) for c in rows.columns if c not in ("Date", "batch")]
    fresh = rows.groupBy("Date").agg(F.max_by(F.struct(*rest), "batch").alias("row")).select("Date", "row.*")
    stored = scratch_dir(spark, "wide")
    fresh.withColumn("month", F.date_format(F.to_date("Date", DATE_PATTERN), "yyyy-MM")).write.parquet(f"{stored}/new")
    rows = fresh = spark.read.parquet(f"{stored}/new")
    # One value per month of the new dates.
    months = sorted(r["month"] for r in fresh.select("month").distinct().collect())
    if not months:
        return
    if _exists(spark, target):
        kept = spark.read.schema(fresh.schema).parquet(target).filter(F.col("month").isin(months))
        kept.join(fresh.select("Date"), "Date", "left_anti").unionByName(fresh).write.parquet(f"{stored}/merged")
        rows = spark.read.parquet(f"{stored}/merged")
    # Few files per month.
    rows.hint("rebalance", "month").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("month").parquet(target)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
