"""Rank-AUC, block and iid bootstraps, permutation tests, Holm and gates."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from decimal import Decimal
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.functions.exact import CTX, q18
from chronolith.operators.features import average_rank

# fixed values: block length, seeds, replicate counts
BLOCK_HOURS = 168
PHASES = 24
PHASE_SEED, IC_SEED = 20260830, 20260829
#: Replicates of the circular bootstrap that a task works on.
REPLICATES_PER_TASK = 100
M64 = 2**64 - 1


def auc(scored: DataFrame, keys: tuple[str, ...], score: str = "score", label: str = "label") -> DataFrame:
    """Mann-Whitney AUC with mid-ranks by group; null when one class is missing.

    Ranks are windows by group, so a group is split only by its keys; pooled
    AUC over everything goes through :func:`auc_by_value`.
    """
    ranked = scored.withColumn("rank__", average_rank(score, *keys))
    sums = ranked.groupBy(*keys).agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"), F.sum(F.when(F.col(label) == 1, F.col("rank__"))).alias("rank_sum"))
    p, n = F.col("positives"), F.col("negatives")
    return sums.withColumn("auc", F.when((p > 0) & (n > 0), (F.col("rank_sum") - p * (p + 1) / 2) / (p * n)))


def running_before(rows: DataFrame, order: str, value: str, out: str, ranges: int = 512) -> DataFrame:
    """Add ``out``, the sum of ``value`` over rows with a smaller ``order``.

    Rows are cut into ranges at approximate quantiles; the ranges' sums, one row
    a range, give offsets, and each range is ordered by itself, so no task holds
    all rows. Values of ``order`` must be distinct.
    """
    cuts = sorted(set(rows.approxQuantile(order, [i / ranges for i in range(1, ranges)], 0.5 / ranges)))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(order))) if cuts else F.lit(0)
    cut = rows.withColumn("part__", part)
    before = Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("part__").agg(F.sum(value).alias("sum__")).select("part__", F.coalesce(F.sum("sum__").over(before), F.lit(0)).alias("offset__"))
    within = Window.partitionBy("part__").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range, at most ``ranges``
    joined = cut.join(F.broadcast(offsets), "part__")
    return joined.withColumn(out, F.col("offset__") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("part__", "offset__")


def auc_by_value(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Pooled AUC from counts by distinct score: rows collapse before any order
    is needed, and distinct scores are accumulated range by range."""
    counts = scored.groupBy(F.col(score).alias("v")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    below = running_before(counts, "v", "n", "below")
    sums = below.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"), F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("wins"))
    return sums.withColumn("auc", F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("wins") / (F.col("positives") * F.col("negatives"))))


def auc_plain(scores: np.ndarray, labels: np.ndarray) -> float | None:
    p, n = int((labels == 1).sum()), int((labels == 0).sum())
    if not p or not n:
        return None
    r = pd.Series(scores).rank().to_numpy()
    return (r[labels == 1].sum() - p * (p + 1) / 2) / (p * n)


class SplitMix64:
    """The 64-bit generator of the block bootstrap, with unbiased bounded draws."""

    def __init__(self, seed: int):
        self.state = seed & M64

    def next(self) -> int:
        self.state = (self.state + 0x9E3779B97F4A7C15) & M64
        z = self.state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & M64
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & M64
        return z ^ (z >> 31)

    def below(self, bound: int) -> int:
        """Uniform in [0, bound): words at or above the last whole multiple of
        the bound are drawn again."""
        limit = 2**64 - 2**64 % bound
        while True:
            word = self.next()
            if word < limit:
                return word % bound


def stream_seed(label: str, year: int, domain: str = "chronolith-v1") -> int:
    """First 8 bytes, big-endian, of the SHA-256 of ``domain|label|year``."""
    return int.from_bytes(hashlib.sha256(f"{domain}|{label}|{year}".encode("ascii")).digest()[:8], "big")


def stream_seed_column(label: Column, year: Column, domain: str) -> Column:
    """The same seed as a column, a decimal(20,0)."""
    digest = F.sha2(F.encode(F.concat_ws("|", F.lit(domain), label, year.cast("string")), "UTF-8"), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")


def hours_in(year: int) -> int:
    return int((datetime(year + 1, 1, 1, tzinfo=timezone.utc) - datetime(year, 1, 1, tzinfo=timezone.utc)).total_seconds()) // 3600


def block_starts(spark_grid: DataFrame, comparison: str, replicates: int, block: int = BLOCK_HOURS, domain: str = "chronolith-v1") -> DataFrame:
    """Starts of all replicates: year, replicate, draw, start, take.

    A year's draws are one sequential stream, so a year is one task; years run
    side by side. ``spark_grid`` has year and hours. The last block of a
    replicate takes only what is left of the year.
    """
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for year, hours in zip(pdf["year"], pdf["hours"], strict=True):
                rng = SplitMix64(stream_seed(comparison, int(year), domain))
                draws = -(-int(hours) // block)
                take = np.minimum(block, hours - block * np.arange(draws))
                for low in range(0, replicates, 500):
                    many = min(500, replicates - low)
                    starts = [rng.below(int(hours) - block + 1) for _ in range(many * draws)]
                    yield pd.DataFrame({"year": year, "replicate": np.repeat(np.arange(low, low + many), draws), "draw": np.tile(np.arange(draws), many), "start": starts, "take": np.tile(take, many)})

    return spark_grid.select("year", "hours").repartition("year").mapInPandas(run, "year int, replicate int, draw int, start long, take long")


def prefix_sums(grid: DataFrame) -> DataFrame:
    """Sums of values and of valid positions before each position of each year:
    year, at, value_before, valid_before, for at from 0 to hours."""
    w = Window.partitionBy("year").orderBy("hour_idx").rowsBetween(Window.unboundedPreceding, 0)
    sums = grid.select("year", (F.col("hour_idx") + 1).cast("long").alias("at"), F.sum(F.coalesce("d", F.lit(0))).over(w).alias("value_before"), F.sum(F.when(F.col("d").isNotNull(), 1).otherwise(0)).over(w).alias("valid_before"))
    origin = grid.select("year").distinct().select("year", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("value_before"), F.lit(0).cast("long").alias("valid_before"))
    return sums.union(origin)


def block_means(starts: DataFrame, prefix: DataFrame) -> DataFrame:
    """Exact numerator and denominator of every replicate, pooled over years.

    A block's sum is a difference of two prefix sums, so a block costs two
    look-ups whatever its length.
    """
    low = prefix.select("year", F.col("at").alias("start"), F.col("value_before").alias("v0"), F.col("valid_before").alias("n0"))
    high = prefix.select("year", F.col("at").alias("stop"), F.col("value_before").alias("v1"), F.col("valid_before").alias("n1"))
    joined = starts.withColumn("stop", F.col("start") + F.col("take")).join(low, ["year", "start"]).join(high, ["year", "stop"])
    per_year = joined.groupBy("replicate", "year").agg(F.sum(F.col("v1") - F.col("v0")).alias("num"), F.sum(F.col("n1") - F.col("n0")).alias("den"))
    checked = per_year.withColumn("den", F.when(F.col("den") > 0, F.col("den")).otherwise(F.raise_error(F.lit("empty_resampled_required_year")).cast("long")))
    return checked.groupBy("replicate").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))


def nearest_rank(values: DataFrame, value: str, numerator: int, denominator: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """The value at rank ceil(numerator * n / denominator), without interpolation."""
    w = Window.partitionBy(*keys).orderBy(value)
    all_ = Window.partitionBy(*keys)
    ranked = values.withColumns({"rank__": F.row_number().over(w), "n__": F.count(F.lit(1)).over(all_)})
    return ranked.filter(F.col("rank__") == F.floor((F.lit(numerator) * F.col("n__") + denominator - 1) / denominator)).select(*keys, F.col("n__").alias("n"), F.col(value).alias("value"))


def bootstrap(grid: DataFrame, hours: DataFrame, comparison: str, replicates: int, block: int = BLOCK_HOURS, domain: str = "chronolith-v1") -> DataFrame:
    """Observed mean, interval at ranks ceil(n/40) and ceil(39n/40), and the
    exceedance p-value of a year-stratified moving-block bootstrap."""
    valid = grid.groupBy("year").agg(F.count("d").alias("valid"))
    guard = valid.select(F.min(F.when(F.col("valid") >= block, F.lit(True)).otherwise(F.raise_error(F.lit("insufficient_observed_paired_valid")).cast("boolean"))).alias("ok__"))
    observed = grid.agg(F.sum("d").alias("num0"), F.count("d").alias("den0")).join(F.broadcast(guard))
    means = block_means(block_starts(hours, comparison, replicates, block, domain), prefix_sums(grid))
    exceed = F.col("num") * F.col("den0") >= 2 * F.col("num0") * F.col("den")
    w = Window.orderBy(F.col("num") / F.col("den"), "replicate")
    ranked = means.join(F.broadcast(observed)).withColumns({"mean": F.col("num") / F.col("den"), "exceeds": exceed}).withColumn("rank__", F.row_number().over(w))
    low, high = -(-replicates // 40), -(-39 * replicates // 40)
    return ranked.agg(
        F.count(F.lit(1)).alias("replicates"), F.max(F.col("num0") / F.col("den0")).alias("observed"), F.max(F.when(F.col("rank__") == low, F.col("mean"))).alias("ci_low"), F.max(F.when(F.col("rank__") == high, F.col("mean"))).alias("ci_high"),
        ((F.count_if("exceeds") + 1) / (replicates + 1)).alias("p_value"),
    )


def multiplicity_digest(starts: DataFrame, hours: DataFrame) -> DataFrame:
    """SHA-256 by year over ``index:multiplicity`` lines of all drawn positions.

    Multiplicities come from a difference array: starts count up, stops down,
    and a running sum gives each position.
    """
    up = starts.groupBy("year", F.col("start").alias("at")).agg(F.count(F.lit(1)).alias("change"))
    down = starts.groupBy("year", (F.col("start") + F.col("take")).alias("at")).agg((-F.count(F.lit(1))).alias("change"))
    changes = up.union(down).groupBy("year", "at").agg(F.sum("change").alias("change"))
    grid = hours.select("year", F.explode(F.sequence(F.lit(0).cast("long"), F.col("hours").cast("long") - 1)).alias("at"))
    w = Window.partitionBy("year").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    counted = grid.join(changes, ["year", "at"], "left").withColumn("m", F.sum(F.coalesce("change", F.lit(0))).over(w))
    lines = counted.groupBy("year").agg(F.array_sort(F.collect_list(F.struct("at", "m"))).alias("xs"))
    text = F.concat(F.array_join(F.transform("xs", lambda x: F.concat_ws(":", x["at"], x["m"])), "\n"), F.lit("\n"))
    return lines.select("year", F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"))


def holm(tests: DataFrame, p: str = "p", name: str = "name", alpha: float = 0.05) -> DataFrame:
    """Holm step-down: reject in order of p until one misses alpha / (m - k)."""
    w = Window.orderBy(p, name)
    m = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = tests.withColumns({"rank": F.row_number().over(w), "threshold": F.lit(alpha) / (m - F.row_number().over(w) + 1)}).withColumn("passes", F.col(p) <= F.col("threshold"))
    return ranked.withColumn("rejected", F.min(F.col("passes").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1)


def percentile(ordered: list[Decimal], share: Decimal) -> Decimal:
    """Linear interpolation between the two nearest of sorted values."""
    whole, part = divmod(CTX.multiply(Decimal(len(ordered) - 1), share), 1)
    low, high = ordered[int(whole)], ordered[min(int(whole) + 1, len(ordered) - 1)]
    return CTX.add(low, CTX.multiply(CTX.subtract(high, low), part))


def ic_resampling(values: DataFrame, value: str = "ic", replicates: int = 10_000, seed: int = IC_SEED) -> DataFrame:
    """iid bootstrap interval of the mean (interpolated percentiles), and the
    share of sign flips whose mean is as far from 0, of one short list of fold
    values (a fold is a row). Means have 50 digits, results 18 places."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = [v if isinstance(v, Decimal) else Decimal(repr(float(v))) for v in pdf.sort_values("fold_id")[value]]
        n = len(x)
        total = lambda values: reduce(CTX.add, values, Decimal(0))
        rng = random.Random(seed)
        means = sorted(CTX.divide(total(x[rng.randrange(n)] for _ in range(n)), Decimal(n)) for _ in range(replicates))
        rng = random.Random(seed)
        observed = abs(total(x))
        flips = sum(abs(total(v if rng.random() < 0.5 else -v for v in x)) >= observed for _ in range(replicates))
        ends = [float(q18(percentile(means, p))) for p in (Decimal("0.025"), Decimal("0.975"))]
        return pd.DataFrame([{"n": n, "mean": float(q18(CTX.divide(total(x), Decimal(n)))), "ci_low": ends[0], "ci_high": ends[1], "p_value": flips / replicates}])

    return values.withColumn("all__", F.lit(0)).groupBy("all__").applyInPandas(run, "n long, mean double, ci_low double, ci_high double, p_value double")


def block_sign_flips(values: DataFrame, value: str = "ic", blocks: tuple[int, ...] = (1, 2, 4, 8), replicates: int = 20_000, seed: int = IC_SEED) -> DataFrame:
    """The sign-flip null of the mean of fold values, with one sign for each run
    of ``block`` folds: block, z of the observed mean, and the least p-value that
    the permutations can state, (k + 1) / (replicates + 1)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("fold_id")[value].to_numpy(float)
        out = []
        for block in blocks:
            sums = np.add.reduceat(x, np.arange(0, len(x), block))
            signs = np.random.default_rng((seed, block)).integers(0, 2, (replicates, len(sums))) * 2 - 1
            means = signs @ sums / len(x)
            out.append((block, float(x.mean() / means.std()), (int((np.abs(means) >= abs(x.mean())).sum()) + 1) / (replicates + 1)))
        return pd.DataFrame(out, columns=["block", "z", "p_value"])

    return values.withColumn("all__", F.lit(0)).groupBy("all__").applyInPandas(run, "block int, z double, p_value double")


def ar1_surrogates(rows: DataFrame, score: str = "score", label: str = "label", surrogates: int = 300, seed: int = 20260830) -> DataFrame:
    """Spread of per-fold correlations of skill-free AR(1) scores with the labels.

    Of rows (fold_id, row_index, score, label), the scores' lag-1 correlation is
    phi; each surrogate is a Gaussian AR(1) series of that phi over all rows.
    Returns phi, the model's standard deviation over folds, and the mean and the
    95 per cent range of the surrogates'.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_index")
        x, y, fold = pdf[score].to_numpy(float), pdf[label].to_numpy(float), pdf["fold_id"].to_numpy()
        phi = float(np.corrcoef(x[1:], x[:-1])[0, 1])
        parts = [np.flatnonzero(fold == f) for f in np.unique(fold)]

        def spread(s: np.ndarray) -> float:
            each = [np.corrcoef(s[p], y[p])[0, 1] for p in parts if len(p) > 1 and s[p].std() > 0 and y[p].std() > 0]
            return float(np.std(each))

        rng = np.random.default_rng(seed)
        null = []
        for _ in range(surrogates):
            noise = rng.standard_normal(len(x))
            s = np.empty(len(x))
            s[0] = noise[0] / np.sqrt(max(1e-12, 1 - phi * phi))
            for t in range(1, len(x)):
                s[t] = phi * s[t - 1] + noise[t]
            null.append(spread(s))
        return pd.DataFrame([(phi, spread(x), float(np.mean(null)), float(np.quantile(null, 0.025)), float(np.quantile(null, 0.975)))], columns=["phi", "model_sd", "null_sd", "null_low", "null_high"])

    return rows.withColumn("all__", F.lit(0)).groupBy("all__").applyInPandas(run, "phi double, model_sd double, null_sd double, null_low double, null_high double")


def circular_block_bootstrap(scored: DataFrame, replicates: int = 10_000, block: int = BLOCK_HOURS, seed: int = PHASE_SEED) -> DataFrame:
    """One-sided lower bound of the mean of AUC - 0.5 over phases, by circular
    blocks of whole rows (ceil(n / block) blocks, not cut to n). Replicates are
    spread over tasks in runs, each replicate with its own generator."""
    run = REPLICATES_PER_TASK
    packed = scored.select("row_index", "score", "label").agg(F.array_sort(F.collect_list(F.struct("row_index", "score", "label"))).alias("xs"))
    # one row, read once by every run
    spread = scored.sparkSession.range(0, replicates, run, -(-replicates // run)).crossJoin(F.broadcast(packed))

    @F.pandas_udf("array<double>")
    def statistics(xs: pd.Series, first: pd.Series) -> pd.Series:
        out = []
        for items, low in zip(xs, first.tolist(), strict=True):
            score = np.array([x["score"] for x in items])
            label = np.array([x["label"] for x in items])
            phase = np.array([x["row_index"] for x in items]) % PHASES
            n = len(score)
            values = []
            for k in range(low, min(low + run, replicates)):
                rng = random.Random(f"{seed}:{k}")
                at = np.concatenate([(np.arange(block) + rng.randrange(n)) % n for _ in range(-(-n // block))])
                cells = [auc_plain(score[at][phase[at] == h], label[at][phase[at] == h]) for h in range(PHASES)]
                known = [c - 0.5 for c in cells if c is not None]
                values.append(float(np.mean(known)) if known else None)
            out.append(values)
        return pd.Series(out)

    values = spread.select("id", F.posexplode(statistics("xs", "id")).alias("at", "t")).select((F.col("id") + F.col("at")).alias("replicate"), "t")
    w = Window.orderBy("t", "replicate")
    return values.withColumn("rank__", F.row_number().over(w) - 1).agg(F.count("t").alias("replicates"), F.max(F.when(F.col("rank__") == int(0.05 * replicates), F.col("t"))).alias("lower"), F.avg("t").alias("mean"))


def pooled_mean(pairs: list[tuple[int, int]]) -> Fraction:
    """Sum of numerators over sum of denominators, exactly."""
    return Fraction(sum(a for a, _ in pairs), sum(b for _, b in pairs))
