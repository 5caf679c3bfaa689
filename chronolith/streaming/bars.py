"""Bars and duplicate removal on streams of events.

A window is emitted once the watermark has passed it, so a bar never changes;
rows later than the watermark are dropped, as a closed bucket takes no more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.session import shared_dir


def bars(events: DataFrame, step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Bars of a stream of (event_id, ts, event_type, value)."""
    cents = F.round(F.col("value") * 100).cast("long")
    order = F.struct("ts", "event_id")
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", step), F.col("event_type").alias("series")).agg(
        F.min_by(cents, order).alias("open"), F.max(cents).alias("high"), F.min(cents).alias("low"), F.max_by(cents, order).alias("close"), F.sum(cents).alias("volume"), F.count(F.lit(1)).alias("trades")
    ).select("series", F.unix_millis("window.start").alias("open_ms"), "open", "high", "low", "close", "volume", "trades")


def deduplicated(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """First row of each key within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def parquet_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of a Parquet table that is a folder or a single file."""
    stored = spark.read.parquet(path)
    reader = spark.readStream.schema(stored.schema)
    folder, _, name = path.rstrip("/").rpartition("/")
    single = any(f.rstrip("/").endswith(f"/{name}") for f in stored.inputFiles())
    return reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)


def run_available(spark: SparkSession, path: str, step: str = "1 hour") -> DataFrame:
    """All files under ``path`` through the stream until none is left; the bars
    of the windows that closed, read back from the sink's table."""
    root = f"{shared_dir(spark)}/chronolith/stream-{uuid.uuid4().hex}"
    source = parquet_stream(spark, path)
    query = bars(source, step).writeStream.outputMode("append").format("parquet").option("path", f"{root}/bars").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("series string, open_ms long, open long, high long, low long, close long, volume long, trades long").parquet(f"{root}/bars")
