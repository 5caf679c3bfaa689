"""Resampling, completeness, gaps and the order checks around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket(t: Column | str, step: int) -> Column:
    """Start of the epoch-aligned bucket of ``step`` ms that holds ``t``."""
    t = F.col(t) if isinstance(t, str) else t
    return t - F.pmod(t, F.lit(step))


def ticks_to_bars(ticks: DataFrame, step: int) -> DataFrame:
    """Open, high, low, close, volume, count and taker side of ticks by bucket.

    First and last go by (t, event_id), which is unique, so no partitioning
    changes them. One partial aggregation and one shuffle on (series, bucket).
    """
    order = F.struct("t", "event_id")
    return ticks.groupBy("series", bucket("t", step).alias("open_ms")).agg(
        F.min_by("cents", order).alias("open"), F.max("cents").alias("high"), F.min("cents").alias("low"), F.max_by("cents", order).alias("close"),
        F.sum("cents").alias("volume"), F.count(F.lit(1)).alias("trades"), F.sum(F.when(F.col("buy"), F.col("cents")).otherwise(0)).alias("taker"),
    )


def resample(bars: DataFrame, step: int) -> DataFrame:
    """Coarser bars from finer ones; sums are exact and overflow is an error."""
    return bars.groupBy("series", bucket("open_ms", step).alias("bucket_ms")).agg(
        F.min_by("open", "open_ms").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_ms").alias("close"),
        F.sum("volume").alias("volume"), F.sum("trades").alias("trades"), F.sum("taker").alias("taker"), F.count(F.lit(1)).alias("members"),
    ).withColumnRenamed("bucket_ms", "open_ms")


def resample_decimal(bars: DataFrame, step: int, keys: list[str], ignore_col: str = "source_ignore") -> DataFrame:
    """Canonical decimal bars to a coarser step, with what makes a group fail.

    ``open_ms`` is the row's start. A group is complete when it has step /
    finer members without gap, and clean when every ignore field is 0.
    """
    grouped = bars.groupBy(*keys, bucket("open_ms", step).alias("bucket_ms")).agg(
        F.min_by("open", "open_ms").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_ms").alias("close"),
        *[F.sum(c).cast("decimal(38,18)").alias(c) for c in ("base_asset_volume", "quote_asset_volume")], F.sum("trade_count").alias("trade_count"),
        *[F.sum(c).cast("decimal(38,18)").alias(c) for c in ("taker_buy_base_volume", "taker_buy_quote_volume")],
        F.count(F.lit(1)).alias("members"), F.count_distinct("open_ms").alias("distinct_members"), F.min("open_ms").alias("first_ms"), F.max("open_ms").alias("last_ms"),
        F.count_if(F.col(ignore_col) != "0").alias("nonzero_ignore"),
    )
    return grouped.withColumnRenamed("bucket_ms", "open_ms")


def group_failure(step: int, finer: int) -> Column:
    """Why a group of :func:`resample_decimal` may not become a bar; null if it may."""
    whole = (F.col("members") == step // finer) & (F.col("first_ms") == F.col("open_ms")) & (F.col("last_ms") == F.col("open_ms") + step - finer)
    return F.when(F.col("members") != F.col("distinct_members"), "duplicate_open_time").when(~whole, "incomplete_group").when(F.col("nonzero_ignore") > 0, "nonzero_source_ignore_in_group")


def completeness(bars: DataFrame, step: int, finer: int) -> DataFrame:
    """Members, span and completeness of each coarser bucket."""
    grouped = bars.groupBy("series", bucket("open_ms", step).alias("bucket_ms")).agg(F.count(F.lit(1)).alias("members"), F.min("open_ms").alias("first_ms"), F.max("open_ms").alias("last_ms"))
    whole = (F.col("members") == step // finer) & (F.col("first_ms") == F.col("bucket_ms")) & (F.col("last_ms") == F.col("bucket_ms") + step - finer)
    return grouped.withColumn("complete", whole)


def gaps(bars: DataFrame, step: int) -> DataFrame:
    """Grid positions between a series' first and last bar that have none.

    The grid is exploded by series and day, so a long series is many rows of
    work, and anti-joined on its key.
    """
    span = bars.groupBy("series").agg(F.min("open_ms").alias("lo"), F.max("open_ms").alias("hi"))
    days = span.select("series", "lo", "hi", F.explode(F.sequence(bucket("lo", 86_400_000), bucket("hi", 86_400_000), F.lit(86_400_000))).alias("day"))
    grid = days.select("series", F.explode(F.sequence(F.greatest("lo", "day"), F.least(F.col("hi"), F.col("day") + 86_400_000 - step), F.lit(step))).alias("open_ms"))
    return grid.join(bars.select("series", "open_ms"), ["series", "open_ms"], "left_anti")


def order_findings(rows: DataFrame, position: str, step: int) -> DataFrame:
    """Per series: rows, duplicates, rows not after the one before them in
    ingest order, and neighbours in time that are not ``step`` apart."""
    ingest = Window.partitionBy("series").orderBy(position)
    time = Window.partitionBy("series").orderBy("t", position)
    seen = rows.withColumn("back", F.col("t") <= F.lag("t").over(ingest)).withColumn("apart", F.col("t") - F.lag("t").over(time))
    return seen.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.count_distinct("t")).alias("duplicates"), F.count_if("back").alias("not_ascending"), F.count_if(F.col("apart") != step).alias("not_adjacent")
    )


def dedup_conflicts(rows: DataFrame, keys: list[str], content: Column, position: Column) -> DataFrame:
    """Per key: copies of the same bytes collapse, different bytes conflict.

    Returns keys, copies, variants, conflict, kept (the first content; at the
    same position the one with the least digest).
    """
    digest = F.sha2(F.encode(content, "UTF-8"), 256)
    by_content = rows.groupBy(*keys, digest.alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("at"))
    return by_content.groupBy(*keys).agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("variants"), F.min_by("digest", F.struct("at", "digest")).alias("kept")).withColumn("conflict", F.col("variants") > 1)


def longest_run(flags: DataFrame, keys: list[str], position: str, flag: str) -> DataFrame:
    """Per key, the longest run of positions where ``flag`` holds (0 if none)."""
    w = Window.partitionBy(*keys).orderBy(position)
    islands = flags.withColumn("island", F.sum(F.when(F.col(flag), 0).otherwise(1)).over(w)).filter(F.col(flag)).groupBy(*keys, "island").agg(F.count(F.lit(1)).alias("run"))
    longest = islands.groupBy(*keys).agg(F.max("run").alias("longest"))
    return flags.select(*keys).distinct().join(longest, keys, "left").select(*keys, F.coalesce("longest", F.lit(0)).alias("longest"))


def coverage(grid: DataFrame, reasons: tuple[str, ...]) -> DataFrame:
    """Per year and pooled (year null): positions, eligible, share, counts of
    each reason of the closed list, longest run of ineligible positions."""
    run = longest_run(grid.withColumn("missing", ~F.col("eligible")), ["year"], "hour_idx", "missing")
    counted = grid.groupBy("year").agg(F.count(F.lit(1)).alias("positions"), F.count_if("eligible").alias("n_eligible"), *[F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in reasons])
    by_year = counted.join(run, "year")
    names = ["positions", "n_eligible", *[f"n_{r}" for r in reasons]]
    pooled = by_year.agg(*[F.sum(c).alias(c) for c in names], F.max("longest").alias("longest")).select(F.lit(None).cast("int").alias("year"), *names, "longest")
    return by_year.select("year", *names, "longest").union(pooled).withColumn("share", F.round(100.0 * F.col("n_eligible") / F.col("positions"), 6))
