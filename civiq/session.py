"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Folders are listed by so many tasks at most; the default gives each of 10,000 folders a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}
_made: set[str] = set()


def build_session(app_name: str, master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's runtime settings, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings the operators assume on a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under a folder all executors share, removed when the driver's process ends.

    The cluster names that folder in ``spark.checkpoint.dir``; where it names none, the warehouse folder serves, unless
    that is a local one and the executors are on other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", None)
        alone = spark.conf.get("spark.master", "local").split("[")[0] == "local"
        if not base or not alone and (":" not in base or base.startswith("file:")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove, spark)
    _made.add(path)
    return path


def _remove(spark: SparkSession) -> None:
    """Delete the scratch paths while the session still lives; one that has ended leaves them to its owner."""
    jvm, context = getattr(spark, "_jvm", None), getattr(getattr(spark, "sparkContext", None), "_jsc", None)
    if jvm is None or context is None:
        return
    with contextlib.suppress(Exception):  # the gateway may have ended first
        for path in () if context.sc().isStopped() else sorted(_made):
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context.hadoopConfiguration()).delete(place, True)
