"""Sessions with the settings that the exact semantics rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session in UTC with ANSI arithmetic, so overflow is an error."""
    builder = SparkSession.builder.appName("chronolith")
    if master:
        builder = builder.master(master)
    settings = SETTINGS | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}) | more
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_exact_settings(spark: SparkSession) -> None:
    """Raise unless ANSI arithmetic is on; results are never silently wrapped."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("exact operators need spark.sql.ansi.enabled=true")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, as in local tests, a temporary folder is made
    once for the session.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="chronolith-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own
