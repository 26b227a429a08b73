"""Reading tables, cutting lineage, and texts as code points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiq.session import scratch_dir


_VALUES = 100_000  # counts that are broadcast


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage is cut, a lost executor costs nothing.

    Shuffle files of finished jobs are deleted when the driver's JVM collects what refers to them, which it is asked to do here.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete rows that ``materialize`` stored and nothing will read again."""
    for rows in stored:
        context = rows.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(rows.scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(key, divisor: int):
    """crc32 of the key as text, modulo ``divisor``; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % divisor


def code_points(text: str) -> np.ndarray:
    """A text's code points; a lone surrogate counts as one."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a blank where it is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def free_name(df: DataFrame, base: str) -> str:
    """A column name the table doesn't have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def draw(rows: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, those with the least hashes of the key; with ``drawn``, the hash.

    Values with more rows are thinned by their count first, so that about twice ``most`` of each are ranked in one place.
    The counts, one for each value, are broadcast up to ``_VALUES`` of them: no row is dealt by its value before it is thinned.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("rows_of_value"))
    if counts.count() <= _VALUES:
        counts = F.broadcast(counts)
    thinned = rows.join(counts, by).withColumn("drawn", F.pmod(F.xxhash64(key, F.lit("draw")), F.lit(1 << 40))).where(
        F.col("drawn") * F.col("rows_of_value").cast("double") < 2.0 * (most + 100) * (1 << 40))
    place = F.row_number().over(Window.partitionBy(by).orderBy("drawn", key))
    return thinned.withColumn("place", place).where(F.col("place") <= most).drop("place", "rows_of_value")
