"""Causal features, forward labels and ranks.

Windows go by series and row index; a series of bars is one task and series are
many. For one very long series ``with_halo`` cuts time into chunks that carry
the rows they look back and ahead to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.functions import exact

# fixed values: lookbacks and horizon
ROC, VOL, VOLUME, HORIZON = 60, 20, 20, 24


def by_time(keys: tuple[str, ...] = ("series",)) -> Window:
    return Window.partitionBy(*keys).orderBy("open_ms")


def with_index(bars: DataFrame, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """Add ``row_index``, the 0-based position in the series by time."""
    return bars.withColumn("row_index", (F.row_number().over(by_time(keys)) - 1).cast("long"))


def with_halo(indexed: DataFrame, chunk: int, back: int = ROC, ahead: int = HORIZON) -> DataFrame:
    """Rows of each chunk of ``chunk`` row indices, and the ``back`` rows before
    and ``ahead`` rows after it with ``halo`` true. Windows by (series, chunk)
    then equal windows by series on all rows with ``halo`` false."""
    i = F.col("row_index")
    first = F.floor((i - ahead) / chunk)
    last = F.floor((i + back) / chunk)
    spread = indexed.withColumn("chunk", F.explode(F.sequence(F.greatest(first, F.lit(0)), last)))
    return spread.withColumn("halo", F.floor(i / chunk) != F.col("chunk"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def ret_1(w: Window) -> Column:
    c = F.col("close")
    return _ratio(c, F.lag(c, 1).over(w)) - 1


def roc_60(w: Window) -> Column:
    c = F.col("close")
    return _ratio(c, F.lag(c, ROC).over(w)) - 1


def rvol_20(w: Window, ret: str = "ret") -> Column:
    """Sample deviation of the last 20 one-bar returns, from index 20 on."""
    frame = w.rowsBetween(-(VOL - 1), 0)
    return F.when(F.count(ret).over(frame) == VOL, F.stddev_samp(ret).over(frame))


def volratio_20(w: Window) -> Column:
    frame = w.rowsBetween(-(VOLUME - 1), 0)
    v = F.col("volume")
    return F.when(F.count(v).over(frame) == VOLUME, _ratio(v, F.avg(v).over(frame)))


def fwdret_24(w: Window) -> Column:
    c = F.col("close")
    return _ratio(F.lead(c, HORIZON).over(w), c) - 1


def fwddir_24(w: Window) -> Column:
    """Sign of the raw close difference, not of the stored return."""
    d = F.lead("close", HORIZON).over(w) - F.col("close")
    return F.signum(d).cast("int")


def research_table(bars: DataFrame, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """Features and labels as doubles; exact values come from
    :func:`research_table_exact`."""
    w = by_time(keys)
    rows = with_index(bars, keys).withColumn("ret", ret_1(w))
    return rows.select(
        *keys, "row_index", "open_ms", F.col("ret").alias("f_ret_1"), roc_60(w).alias("f_roc_60"), rvol_20(w).alias("f_rvol_20"), volratio_20(w).alias("f_volratio_20"), fwdret_24(w).alias("l_fwdret_24"), fwddir_24(w).alias("l_fwddir_24")
    )


def research_table_exact(bars: DataFrame, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """The research table with 50 digits in flight and 18 places at rest.

    Lags, leads, sums and the arrays of closes are windows; only the divisions
    and the deviation run in Arrow batches.
    """
    w = by_time(keys)
    rows = with_index(bars, keys).withColumns({"c": exact.decimal18(F.col("close")), "v": exact.decimal18(F.col("volume"))})
    frame = w.rowsBetween(-(VOLUME - 1), 0)
    closes = w.rowsBetween(-VOL, 0)
    rows = rows.withColumns(
        {
            "c1": F.lag("c", 1).over(w), "c60": F.lag("c", ROC).over(w), "c24": F.lead("c", HORIZON).over(w),
            "closes": F.when(F.count("c").over(closes) == VOL + 1, F.collect_list("c").over(closes)),
            "vsum": F.when(F.count("v").over(frame) == VOLUME, F.sum("v").over(frame).cast("decimal(38,18)")),
        }
    )
    return rows.select(
        *keys, "row_index", "open_ms", exact.rate18("c", "c1").alias("f_ret_1"), exact.rate18("c", "c60").alias("f_roc_60"), exact.returns_deviation18("closes").alias("f_rvol_20"),
        exact.mean_ratio18("v", "vsum", F.when(F.col("vsum").isNotNull(), F.lit(VOLUME))).alias("f_volratio_20"), exact.rate18("c24", "c").alias("l_fwdret_24"), F.signum(F.col("c24") - F.col("c")).cast("tinyint").alias("l_fwddir_24"),
    )


def average_rank(value: str, *keys: str) -> Column:
    """1-based rank with ties at their mean."""
    order = Window.partitionBy(*keys).orderBy(value)
    ties = Window.partitionBy(*keys, value)
    return F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / 2


def realised_volatility(w: Window, hours: int, ret: str = "ret") -> Column:
    """Square root of the sum of squared returns over complete windows only."""
    frame = w.rowsBetween(-(hours - 1), 0)
    r = F.col(ret)
    return F.when(F.count(r).over(frame) == hours, F.sqrt(F.sum(r * r).over(frame)))


FEATURES = ("f_ret_1", "f_roc_60", "f_rvol_20", "f_volratio_20")


def null_budget(n: int) -> dict[str, int]:
    """Nulls that each column has by design in a table of n rows."""
    return {"f_ret_1": min(n, 1), "f_roc_60": min(n, ROC), "f_rvol_20": min(n, VOL), "f_volratio_20": min(n, VOLUME - 1), "l_fwdret_24": min(n, HORIZON), "l_fwddir_24": min(n, HORIZON)}
