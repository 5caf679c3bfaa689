"""Anchored walk-forward folds, their statistics and leakage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: rows of a test range, least train range, embargo
TEST, TRAIN, EMBARGO = 72, 336, 24
FIRST_TEST = TRAIN + EMBARGO
LEAST_ROWS = FIRST_TEST + TEST


def folds(counted: DataFrame) -> DataFrame:
    """Folds of each series of ``counted`` (series, n).

    Series with fewer than 432 rows are an error. Test ranges tile the rows
    from 360 on; the last one takes the remainder.
    """
    n = F.col("n")
    many = F.floor((n - FIRST_TEST) / TEST).cast("int")
    checked = counted.withColumn("n", F.when(n >= LEAST_ROWS, n).otherwise(F.raise_error(F.concat(F.lit("undersized_parent_dataset: "), n.cast("string"))).cast("long")))
    rows = checked.withColumn("many", many).select("series", "n", "many", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("fold_id"))
    start = (F.lit(FIRST_TEST) + F.col("fold_id") * TEST).cast("long")
    end = F.when(F.col("fold_id") == F.col("many") - 1, F.col("n")).otherwise(start + TEST)
    return rows.select(
        "series", "fold_id", F.lit(0).cast("long").alias("train_start"), (start - EMBARGO).alias("train_end"), (start - EMBARGO).alias("embargo_start"), start.alias("embargo_end"), start.alias("test_start"), end.alias("test_end"), "n"
    )


def fold_of(row_index: Column, n: Column) -> Column:
    """The fold whose test range holds a row; arithmetic, no join. Null before
    the first test range."""
    many = F.floor((n - FIRST_TEST) / TEST)
    return F.when(row_index >= FIRST_TEST, F.least(F.floor((row_index - FIRST_TEST) / TEST), many - 1)).cast("int")


def train_rows(rows: DataFrame, n: Column) -> DataFrame:
    """Each row once for every fold that trains on it (``fold_id``).

    Row i trains fold k when i < 336 + 72 k; the fold numbers come from
    arithmetic, so this is an explode and not a theta join.
    """
    many = F.floor((n - FIRST_TEST) / TEST)
    first = F.greatest(F.lit(0), F.floor((F.col("row_index") - TRAIN) / TEST) + 1)
    return rows.withColumn("fold_id", F.explode(F.when(first <= many - 1, F.sequence(first.cast("int"), (many - 1).cast("int"))).otherwise(F.array().cast("array<int>"))))


def train_totals(rows: DataFrame, sums: dict[str, Column], greatest: dict[str, Column] | None = None) -> DataFrame:
    """Per series and fold, aggregates over all rows that train the fold.

    ``rows`` has series, n and row_index; ``sums`` are aggregates that add up
    (counts, sums), ``greatest`` such whose greatest holds. Rows are aggregated
    once, in blocks that end where train ranges end; running totals over blocks
    give every fold, so no row is copied for the folds that it trains.
    """
    greatest = greatest or {}
    block = F.greatest(F.lit(0), F.floor((F.col("row_index") - TRAIN) / TEST) + 1).cast("int")
    per = rows.groupBy("series", F.col("n").alias("rows__"), block.alias("fold_id")).agg(*[c.alias(k) for k, c in (sums | greatest).items()])
    many = F.floor((F.col("rows__") - FIRST_TEST) / TEST).cast("int")
    grid = per.groupBy("series", "rows__").agg(F.lit(1).alias("one")).filter(many > 0).select("series", F.explode(F.sequence(F.lit(0), many - 1)).alias("fold_id"))
    upto = Window.partitionBy("series").orderBy("fold_id").rowsBetween(Window.unboundedPreceding, 0)
    totals = [F.coalesce(F.sum(k).over(upto), F.lit(0)).alias(k) for k in sums] + [F.max(k).over(upto).alias(k) for k in greatest]
    return grid.join(per.drop("rows__"), ["series", "fold_id"], "left").select("series", "fold_id", *totals)


def fold_stats(research: DataFrame, n: Column) -> DataFrame:
    """Per series and fold: rows, time range, nulls, signs, range of the return."""
    tested = research.withColumn("fold_id", fold_of(F.col("row_index"), n)).filter("fold_id is not null")
    columns = ("f_ret_1", "f_roc_60", "f_rvol_20", "f_volratio_20", "l_fwdret_24", "l_fwddir_24")
    return tested.groupBy("series", "fold_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("open_ms").alias("first_ms"), F.max("open_ms").alias("last_ms"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        *[F.count_if(F.col("l_fwddir_24") == s).alias(name) for name, s in (("down", -1), ("flat", 0), ("up", 1))],
        F.min("f_ret_1").alias("min_ret"), F.max("f_ret_1").alias("max_ret"), F.avg("f_ret_1").alias("mean_ret"),
    )


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Length of the overlap of [a, b) and [c, d)."""
    return F.greatest(F.lit(0), F.least(b, d) - F.greatest(a, c))


def expected_nulls(plan: DataFrame) -> DataFrame:
    """Structural nulls that a fold's test range has, by column."""
    from chronolith.operators.features import HORIZON, ROC, VOL, VOLUME

    a, b, n = F.col("test_start"), F.col("test_end"), F.col("n")
    zero = F.lit(0)
    return plan.select(
        "series", "fold_id", overlap(a, b, zero, F.lit(1)).alias("f_ret_1"), overlap(a, b, zero, F.lit(ROC)).alias("f_roc_60"), overlap(a, b, zero, F.lit(VOL)).alias("f_rvol_20"), overlap(a, b, zero, F.lit(VOLUME - 1)).alias("f_volratio_20"),
        overlap(a, b, n - HORIZON, n).alias("l_fwdret_24"), overlap(a, b, n - HORIZON, n).alias("l_fwddir_24"),
    )


def leakage(plan: DataFrame, horizon: int = 24) -> DataFrame:
    """The four range predicates of every fold, and whether all hold."""
    checks = {
        "train_before_embargo": F.col("train_end") <= F.col("embargo_start"),
        "embargo_before_test": F.col("embargo_end") <= F.col("test_start"),
        "label_inside_embargo": F.col("train_end") - 1 + horizon < F.col("test_start"),
        "test_not_empty": F.col("test_start") < F.col("test_end"),
    }
    passed = plan.select("series", "fold_id", *[c.alias(k) for k, c in checks.items()])
    return passed.withColumn("holds", F.expr(" and ".join(checks)))


def year_folds(origins: DataFrame, years: tuple[int, ...], train_from: int, horizon_ms: int = 86_400_000) -> DataFrame:
    """Rows by test year with their side: train if the label closes by the year's
    start (purge), test inside the year."""
    start = F.unix_millis(F.make_timestamp_ltz(F.col("test_year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    end = F.unix_millis(F.make_timestamp_ltz(F.col("test_year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    t = F.col("t")
    side = F.when((t >= start) & (t < end), "test").when((t >= train_from) & (t + horizon_ms <= start), "train")
    # the years are a short closed list, so each row meets them in an explode
    spread = origins.withColumn("test_year", F.explode(F.array(*map(F.lit, years))))
    return spread.withColumn("side", side).filter("side is not null")
