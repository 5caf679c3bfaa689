"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.plans import bars_sql, joins_sql, research_sql, scans_sql

QUERIES = bars_sql.Q | research_sql.Q | joins_sql.Q | scans_sql.Q
SQL = bars_sql.S | research_sql.S | joins_sql.S | scans_sql.S


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to hourly bars to returns, summed up by series and day: one scan,
    one shuffle for bars, one for windows."""
    from chronolith.operators.features import by_time, ret_1

    rows = bars_sql.hour_bars(spark, sf_dir).withColumn("ret", ret_1(by_time()))
    day = F.timestamp_millis(F.col("open_ms") - F.pmod("open_ms", F.lit(86_400_000))).cast("date")
    return rows.groupBy("series", day.alias("day")).agg(F.count(F.lit(1)).alias("bars"), F.min("ret").alias("lowest"), F.max("ret").alias("highest"))
