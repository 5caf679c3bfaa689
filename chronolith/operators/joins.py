"""Point-in-time joins and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: list[str], values: list[str], tiebreak: str, strict: bool = True) -> DataFrame:
    """Each left row with the latest right row of its key before it.

    ``strict`` takes ``right_ts < left_ts``; equal times never match. Both
    sides go through one shuffle on the key and one window; ties on the right
    go to the greatest ``tiebreak``. Values are null where nothing came before.
    """
    packed = F.struct(F.col(right_ts).alias("ts__"), *[F.col(v).alias(v) for v in values])
    # at one time, a strict join reads left rows before right rows take effect
    sides = left.select(*by, F.col(left_ts).alias("at__"), F.lit(0 if strict else 1).alias("side__"), F.lit(None).cast("long").alias("tie__"), F.struct(*[F.col(c) for c in left.columns]).alias("left__"), F.lit(None).cast(right.select(packed).schema[0].dataType).alias("right__"))
    other = right.select(*by, F.col(right_ts).alias("at__"), F.lit(1 if strict else 0).alias("side__"), F.col(tiebreak).cast("long").alias("tie__"), F.lit(None).cast(sides.schema["left__"].dataType).alias("left__"), packed.alias("right__"))
    w = Window.partitionBy(*by).orderBy("at__", "side__", "tie__").rowsBetween(Window.unboundedPreceding, 0)
    found = sides.unionByName(other).withColumn("last__", F.last("right__", ignorenulls=True).over(w)).filter("left__ is not null")
    return found.select("left__.*", F.col("last__.ts__").alias("matched_ts"), *[F.col(f"last__.{v}").alias(v) for v in values])


#: How long an open-interest snapshot is kept back, in milliseconds.
OI_DELAY_MS = 300_000


def latest_oi_open(boundary: Column) -> Column:
    """The latest snapshot time that is eligible at a boundary."""
    return boundary - OI_DELAY_MS


def asof_bucketed(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: list[str], values: list[str], tiebreak: str, width: int) -> DataFrame:
    """As :func:`asof` (strict) for keys too long for one task: time is cut into
    buckets of ``width``; each bucket also gets the last right row of the
    buckets before it, which one row per bucket and a window give."""
    lb = left.withColumn("bucket__", F.floor(F.col(left_ts) / width))
    rb = right.withColumn("bucket__", F.floor(F.col(right_ts) / width))
    last = rb.groupBy(*by, "bucket__").agg(F.max_by(F.struct(*right.columns), F.struct(F.col(right_ts), F.col(tiebreak))).alias("row__"))
    touched = lb.select(*by, "bucket__").union(rb.select(*by, "bucket__")).distinct()
    before = Window.partitionBy(*by).orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.join(last, [*by, "bucket__"], "left").withColumn("carry__", F.last("row__", ignorenulls=True).over(before)).filter("carry__ is not null").select("carry__.*", "bucket__")
    return asof(lb, rb.select(*right.columns, "bucket__").union(carried.select(*right.columns, "bucket__")), left_ts, right_ts, [*by, "bucket__"], values, tiebreak).drop("bucket__")


def exact_offset(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: list[str], offset: int, values: list[str]) -> DataFrame:
    """Right values exactly ``offset`` before each left row, without tolerance."""
    keyed = right.select(*by, (F.col(right_ts) + offset).alias(left_ts), *[F.col(v).alias(f"{v}_before") for v in values])
    return left.join(keyed, [*by, left_ts], "left")


def interval_sum(rows: DataFrame, by: list[str], ts: str, value: str, width: int, least: int = 0) -> DataFrame:
    """Sum and count of ``value`` over ``(t - width, t]`` at each row; the sum is
    null unless the interval holds ``least`` rows."""
    w = Window.partitionBy(*by).orderBy(ts).rangeBetween(-(width - 1), 0)
    n = F.count(value).over(w)
    return rows.withColumns({"in_interval": n, "interval_sum": F.when(n >= least, F.sum(value).over(w))})


def paired(candidate: DataFrame, comparator: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Both predictions at the identical keys, the difference of their scores."""
    return candidate.select(*keys, F.col(value).alias("candidate")).join(comparator.select(*keys, F.col(value).alias("comparator")), keys).withColumn("difference", F.col("candidate") - F.col("comparator"))


def reconcile(source: DataFrame, stored: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows missing on either side and columns that differ, null-safe.

    One row: source_only, stored_only, equal, and differing counts by column.
    """
    a = source.select(*keys, F.lit(1).alias("in_a__"), *[F.col(c).alias(f"a_{c}") for c in columns])
    b = stored.select(*keys, F.lit(1).alias("in_b__"), *[F.col(c).alias(f"b_{c}") for c in columns])
    j = a.join(b, keys, "full_outer")
    both = F.col("in_a__").isNotNull() & F.col("in_b__").isNotNull()

    def differs(c: str) -> Column:
        return ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))

    any_ = F.lit(False)
    for c in columns:
        any_ = any_ | differs(c)
    return j.agg(F.count_if(F.col("in_b__").isNull()).alias("source_only"), F.count_if(F.col("in_a__").isNull()).alias("stored_only"), F.count_if(both & ~any_).alias("equal"), *[F.count_if(both & differs(c)).alias(f"diff_{c}") for c in columns])


def match_approvals(warnings: DataFrame, approvals: DataFrame) -> DataFrame:
    """Warnings and approvals one to one on check, count and evidence digest."""
    w = warnings.select("check_id", F.col("count").alias("found"), F.col("digest").alias("found_digest"))
    a = approvals.select("check_id", F.col("count").alias("approved"), F.col("digest").alias("approved_digest"))
    exact = (F.col("found") == F.col("approved")) & (F.col("found_digest") == F.col("approved_digest"))
    return w.join(a, "check_id", "full_outer").withColumn("matches", F.coalesce(exact, F.lit(False)))
