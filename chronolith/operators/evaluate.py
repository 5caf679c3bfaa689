"""Information coefficients by fold and feature, and their summaries.

The double forms are built-in aggregates; the exact forms run the 50-digit
arithmetic in one task per (series, fold, feature), whose rows a fold bounds.
"""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.functions.exact import CTX, q18
from chronolith.operators.features import FEATURES, average_rank


class MetricDomainError(ValueError):
    """metric_domain_error: a metric is not defined on its input."""


def pearson(xs: list[Decimal], ys: list[Decimal]) -> Decimal:
    """Two-pass correlation, 18 places; too few pairs or no variance is an error."""
    n = len(xs)
    if n < 2 or n != len(ys):
        raise MetricDomainError("fewer than two pairs")
    count = Decimal(n)
    add, sub, mul, div = CTX.add, CTX.subtract, CTX.multiply, CTX.divide

    def total(values) -> Decimal:
        out = Decimal(0)
        for v in values:
            out = add(out, v)
        return out

    mx, my = div(total(xs), count), div(total(ys), count)
    dx, dy = [sub(x, mx) for x in xs], [sub(y, my) for y in ys]
    sx, sy = total(mul(d, d) for d in dx), total(mul(d, d) for d in dy)
    if sx.is_zero() or sy.is_zero():
        raise MetricDomainError("zero variance")
    out = q18(div(total(mul(a, b) for a, b in zip(dx, dy, strict=True)), mul(CTX.sqrt(sx), CTX.sqrt(sy))))
    if abs(out) > 1:
        raise MetricDomainError("correlation outside [-1, 1]")
    return out


def ranks(xs: list[Decimal]) -> list[Decimal]:
    """1-based ranks, ties at their mean."""
    many = Counter(xs)
    values = sorted(many)
    upto = accumulate(many[v] for v in values)
    middle = {v: CTX.divide(Decimal(2 * end - many[v] + 1), Decimal(2)) for v, end in zip(values, upto, strict=True)}
    return [middle[x] for x in xs]


def spearman(xs: list[Decimal], ys: list[Decimal]) -> Decimal:
    return pearson(ranks(xs), ranks(ys))


def by_feature(tested: DataFrame, target: str = "l_fwdret_24") -> DataFrame:
    """Long form: series, fold_id, feature, x, y."""
    pairs = ", ".join(f"'{f}', {f}" for f in FEATURES)
    return tested.select("series", "fold_id", "row_index", F.col(target).alias("y"), F.expr(f"stack({len(FEATURES)}, {pairs}) as (feature, x)"))


def ic_records(tested: DataFrame) -> DataFrame:
    """Per series, fold and feature: row, pair and null counts, Pearson and
    Spearman in doubles (null without variance)."""
    long = by_feature(tested)
    keys = ("series", "fold_id", "feature")
    counts = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("x").isNull()).alias("x_nulls"), F.count_if(F.col("y").isNull()).alias("y_nulls"))
    valid = long.filter("x is not null and y is not null").withColumns({"rx": average_rank("x", *keys), "ry": average_rank("y", *keys)})

    def corr(a: str, b: str):
        return F.when((F.stddev_pop(a) > 0) & (F.stddev_pop(b) > 0), F.corr(a, b))

    metrics = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_pairs"), corr("x", "y").alias("pearson_ic"), corr("rx", "ry").alias("spearman_ic"))
    return counts.join(metrics, list(keys), "left").withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)))


def ic_records_exact(tested: DataFrame) -> DataFrame:
    """As :func:`ic_records` with exact coefficients of 18 places."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_index")
        ok = pdf[pdf["x"].notna() & pdf["y"].notna()]
        xs, ys = list(ok["x"]), list(ok["y"])
        head = pdf.iloc[0]
        return pd.DataFrame([{"series": head["series"], "fold_id": head["fold_id"], "feature": head["feature"], "n_rows": len(pdf), "n_pairs": len(ok), "x_nulls": int(pdf["x"].isna().sum()), "y_nulls": int(pdf["y"].isna().sum()), "pearson_ic": pearson(xs, ys), "spearman_ic": spearman(xs, ys)}])

    return by_feature(tested).groupBy("series", "fold_id", "feature").applyInPandas(run, "series string, fold_id int, feature string, n_rows long, n_pairs long, x_nulls long, y_nulls long, pearson_ic decimal(38,18), spearman_ic decimal(38,18)")


def summarise(records: DataFrame, metric: str, keys: tuple[str, ...] = ("series", "feature")) -> DataFrame:
    """Across folds: extremes, signs, median and equal-weight mean of a metric."""
    m = F.col(metric)
    return records.groupBy(*keys).agg(
        F.count(m).alias("n_folds"), F.min(m).alias("lowest"), F.max(m).alias("highest"), F.count_if(m < 0).alias("negative"), F.count_if(m == 0).alias("zero"), F.count_if(m > 0).alias("positive"),
        F.median(m).alias("median"), F.avg(m).alias("mean"),
    )


def median_exact(values: list[Decimal]) -> Decimal:
    """An odd count's middle value as it is; an even count's mean of two, 18 places."""
    ordered = sorted(values)
    half = len(ordered) // 2
    return ordered[half] if len(ordered) % 2 else q18(CTX.divide(CTX.add(ordered[half - 1], ordered[half]), Decimal(2)))
