"""The event table as market ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR, DAY = 3_600_000, 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str, series: str = "event_type") -> DataFrame:
    """event_id, t (epoch ms), series, cents, buy (taker side) of every event.

    ``series`` names the column that keeps series apart; ``ALL`` makes one.
    """
    e = table(spark, sf_dir, "events")
    key = F.lit("ALL") if series == "ALL" else F.col(series)
    return e.select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("t"), key.alias("series"), F.round(F.col("value") * 100).cast("long").alias("cents"), (F.col("event_type") == "purchase").alias("buy")
    )
