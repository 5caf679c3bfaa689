"""Ridge and logistic walk-forward models, their baselines, metrics and gates.

Each fold is one task over the rows it trains and tests on; the exact solvers
work on 50-digit decimals. Ridge can also be solved from sufficient statistics,
which blocks of rows give by running sums and which no fold has to gather.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.functions.exact import CTX, mean, q18
from chronolith.operators.evaluate import MetricDomainError, pearson
from chronolith.operators.features import FEATURES
from chronolith.operators.folds import TEST, TRAIN

ZERO, ONE = Decimal(0), Decimal(1)
# fixed values: penalty, iteration and clamp settings, least training rows
PENALTY = Decimal(1)
MOST_ITERATIONS = 50
TOLERANCE = Decimal("0.000000000001")
ETA_LIMIT = Decimal(24)
MU_LIMIT = Decimal("0.000000000001")
LEAST_TRAIN = 200
# fixed values: registered thresholds of the kill gate
KILL = {"directional_accuracy": (">=", "0.534900284900284900"), "direction_ic": (">=", "0.02"), "log_loss": ("<=", "0.7625"), "brier": ("<=", "0.25")}


def solve(matrix: list[list[Decimal]], vector: list[Decimal]) -> list[Decimal]:
    """Solution of a small dense system; the pivot is the largest in its column."""
    n = len(vector)
    rows = [[*row, v] for row, v in zip(matrix, vector, strict=True)]
    for k in range(n):
        best = max(range(k, n), key=lambda i: abs(rows[i][k]))
        if rows[best][k].is_zero():
            raise MetricDomainError("singular system")
        rows[k], rows[best] = rows[best], rows[k]
        top = rows[k] = [CTX.divide(x, rows[k][k]) if j >= k else x for j, x in enumerate(rows[k])]
        for i in range(n):
            if i != k and not rows[i][k].is_zero():
                f = rows[i][k]
                rows[i] = [CTX.subtract(x, CTX.multiply(f, t)) if j >= k else x for j, (x, t) in enumerate(zip(rows[i], top, strict=True))]
    return [row[n] for row in rows]


def _dot(a: list[Decimal], b: list[Decimal]) -> Decimal:
    out = ZERO
    for x, y in zip(a, b, strict=True):
        out = CTX.add(out, CTX.multiply(x, y))
    return out


class Scale(NamedTuple):
    means: list[Decimal]
    deviations: list[Decimal]

    def of(self, row: list[Decimal]) -> list[Decimal]:
        return [CTX.divide(CTX.subtract(x, m), s) for x, m, s in zip(row, self.means, self.deviations, strict=True)]


def scale_of(rows: list[list[Decimal]]) -> Scale:
    """Means and population deviations by column; no variance is an error."""
    means, deviations = [], []
    for column in zip(*rows, strict=True):
        m = mean(list(column))
        s = CTX.sqrt(mean([CTX.multiply(CTX.subtract(x, m), CTX.subtract(x, m)) for x in column]))
        if s.is_zero():
            raise MetricDomainError("zero deviation of a feature")
        means.append(m)
        deviations.append(s)
    return Scale(means, deviations)


class TrainingError(ValueError):
    """A fold that can't be trained."""


def _enough(n: int, fold: object) -> None:
    if n < LEAST_TRAIN:
        raise TrainingError(f"fold {fold} has {n} usable train rows of at least {LEAST_TRAIN}")


class Ridge(NamedTuple):
    scale: Scale
    weights: list[Decimal]
    target_mean: Decimal

    def predict(self, row: list[Decimal]) -> Decimal:
        return q18(CTX.add(self.target_mean, _dot(self.weights, self.scale.of(row))))


def fit_ridge(rows: list[list[Decimal]], target: list[Decimal], penalty: Decimal = PENALTY) -> Ridge:
    scale = scale_of(rows)
    z = [scale.of(r) for r in rows]
    middle = mean(target)
    y = [CTX.subtract(t, middle) for t in target]
    columns = [list(c) for c in zip(*z, strict=True)]
    gram = [[CTX.add(_dot(a, b), penalty) if i == j else _dot(a, b) for j, b in enumerate(columns)] for i, a in enumerate(columns)]
    return Ridge(scale, solve(gram, [_dot(c, y) for c in columns]), middle)


class Logistic(NamedTuple):
    scale: Scale
    weights: list[Decimal]
    iterations: int
    converged: bool
    clamped: int

    def probability(self, row: list[Decimal]) -> Decimal:
        return q18(_sigmoid(_dot(self.weights, [ONE, *self.scale.of(row)]))[0])


def _sigmoid(eta: Decimal) -> tuple[Decimal, int]:
    """Probability, and how many of the two clamps were hit."""
    held = max(-ETA_LIMIT, min(ETA_LIMIT, eta))
    mu = CTX.divide(ONE, CTX.add(ONE, CTX.exp(CTX.minus(held))))
    inside = max(MU_LIMIT, min(CTX.subtract(ONE, MU_LIMIT), mu))
    return inside, (held != eta) + (inside != mu)


def fit_logistic(rows: list[list[Decimal]], labels: list[int], penalty: Decimal = PENALTY) -> Logistic:
    """Iteratively reweighted least squares with an unpenalised intercept;
    weights that do not settle raise :class:`TrainingError`."""
    scale = scale_of(rows)
    x = [[ONE, *scale.of(r)] for r in rows]
    width = len(x[0])
    w = [ZERO] * width
    hits = 0
    for step in range(1, MOST_ITERATIONS + 1):
        gram = [[ZERO] * width for _ in range(width)]
        right = [ZERO] * width
        for row, label in zip(x, labels, strict=True):
            raw = _dot(w, row)
            eta = max(-ETA_LIMIT, min(ETA_LIMIT, raw))
            mu, hit = _sigmoid(raw)
            hits += hit
            v = CTX.multiply(mu, CTX.subtract(ONE, mu))
            z = CTX.add(eta, CTX.divide(CTX.subtract(Decimal(label), mu), v))
            weighted = [CTX.multiply(v, a) for a in row]
            for i in range(width):
                right[i] = CTX.add(right[i], CTX.multiply(weighted[i], z))
                for j in range(i + 1):
                    gram[i][j] = CTX.add(gram[i][j], CTX.multiply(weighted[i], row[j]))
        for i in range(width):
            for j in range(i):
                gram[j][i] = gram[i][j]
            if i:
                gram[i][i] = CTX.add(gram[i][i], penalty)
        new = solve(gram, right)
        moved = max(abs(CTX.subtract(a, b)) for a, b in zip(new, w, strict=True))
        w = new
        if moved < TOLERANCE:
            return Logistic(scale, w, step, True, hits)
    raise TrainingError(f"irls_did_not_converge after {MOST_ITERATIONS} steps")


def log_loss(p: list[Decimal], labels: list[int]) -> Decimal:
    high = CTX.subtract(ONE, MU_LIMIT)
    held = [max(MU_LIMIT, min(high, x)) for x in p]
    return q18(CTX.minus(mean([CTX.ln(x if y else CTX.subtract(ONE, x)) for x, y in zip(held, labels, strict=True)])))


def brier(p: list[Decimal], labels: list[int]) -> Decimal:
    return q18(mean([CTX.multiply(CTX.subtract(x, Decimal(y)), CTX.subtract(x, Decimal(y))) for x, y in zip(p, labels, strict=True)]))


def climatology(up: int, down: int) -> Decimal:
    return q18(CTX.divide(Decimal(up), Decimal(up + down)))


def _or_zero(xs: list[Decimal], ys: list[Decimal]) -> Decimal:
    try:
        return pearson(xs, ys)
    except MetricDomainError:
        return q18(ZERO)


def sides(research: DataFrame, n: Column) -> DataFrame:
    """Complete rows of the research table, once for each fold they train or
    test in (``side``)."""
    from chronolith.operators.folds import fold_of, train_rows

    complete = research.dropna(subset=[*FEATURES, "l_fwdret_24", "l_fwddir_24"])
    tests = complete.withColumn("fold_id", fold_of(F.col("row_index"), n)).filter("fold_id is not null").withColumn("side", F.lit("test"))
    trains = train_rows(complete, n).withColumn("side", F.lit("train"))
    return trains.select(*complete.columns, "fold_id", "side").union(tests.select(*complete.columns, "fold_id", "side"))


def _matrix(pdf: pd.DataFrame) -> list[list[Decimal]]:
    return [list(r) for r in pdf[list(FEATURES)].itertuples(index=False, name=None)]


RIDGE_SCHEMA = "series string, fold_id int, n_train long, n_test long, mse decimal(38,18), directional_accuracy decimal(38,18), return_ic decimal(38,18), deterministic boolean, majority_accuracy decimal(38,18), sign_accuracy decimal(38,18)"
LOGISTIC_SCHEMA = "series string, fold_id int, n_train long, n_test long, iterations int, converged boolean, clamped long, directional_accuracy decimal(38,18), log_loss decimal(38,18), brier decimal(38,18), direction_ic decimal(38,18), climatology_p decimal(38,18), climatology_log_loss decimal(38,18), climatology_brier decimal(38,18)"


def _share(hits: int, n: int) -> Decimal:
    return q18(CTX.divide(Decimal(hits), Decimal(n)))


def ridge_walk_forward(sided: DataFrame) -> DataFrame:
    """Per fold: metrics of ridge and of the majority and sign baselines. A fold
    with test rows but too few usable train rows fails the job."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_index")
        train, test = pdf[pdf["side"] == "train"], pdf[pdf["side"] == "test"]
        if test.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in RIDGE_SCHEMA.split(", ")])
        _enough(len(train), pdf["fold_id"].iloc[0])
        x, y = _matrix(train), list(train["l_fwdret_24"])
        model, again = fit_ridge(x, y), fit_ridge(x, y)
        actual, direction = list(test["l_fwdret_24"]), [int(d) for d in test["l_fwddir_24"]]
        p = [model.predict(r) for r in _matrix(test)]
        sign = [(v > 0) - (v < 0) for v in p]
        up, down = int((train["l_fwddir_24"] == 1).sum()), int((train["l_fwddir_24"] == -1).sum())
        majority = 1 if up >= down else -1
        now = [(v > 0) - (v < 0) for v in test["f_ret_1"]]
        n = len(test)
        return pd.DataFrame([(pdf["series"].iloc[0], pdf["fold_id"].iloc[0], len(train), n, q18(mean([CTX.multiply(CTX.subtract(a, b), CTX.subtract(a, b)) for a, b in zip(p, actual, strict=True)])), _share(sum(a == b for a, b in zip(sign, direction, strict=True)), n), _or_zero(p, actual), model == again, _share(sum(d == majority for d in direction), n), _share(sum(a == b for a, b in zip(now, direction, strict=True)), n))], columns=[c.split()[0] for c in RIDGE_SCHEMA.split(", ")])

    return sided.groupBy("series", "fold_id").applyInPandas(run, RIDGE_SCHEMA)


def logistic_walk_forward(sided: DataFrame) -> DataFrame:
    """Per fold: fit on rows with a direction, metrics on test rows with one. A
    fold with test rows but too few usable train rows fails the job."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["l_fwddir_24"] != 0].sort_values("row_index")
        train, test = pdf[pdf["side"] == "train"], pdf[pdf["side"] == "test"]
        names = [c.split()[0] for c in LOGISTIC_SCHEMA.split(", ")]
        if test.empty:
            return pd.DataFrame(columns=names)
        _enough(len(train), pdf["fold_id"].iloc[0])
        model = fit_logistic(_matrix(train), [int(d == 1) for d in train["l_fwddir_24"]])
        labels = [int(d == 1) for d in test["l_fwddir_24"]]
        p = [model.probability(r) for r in _matrix(test)]
        half = Decimal("0.5")
        up = int((train["l_fwddir_24"] == 1).sum())
        base = climatology(up, len(train) - up)
        n = len(test)
        row = (pdf["series"].iloc[0], pdf["fold_id"].iloc[0], len(train), n, model.iterations, model.converged, model.clamped, _share(sum((x >= half) == (y == 1) for x, y in zip(p, labels, strict=True)), n), log_loss(p, labels), brier(p, labels), _or_zero(p, [Decimal(1 if y else -1) for y in labels]), base, log_loss([base] * n, labels), brier([base] * n, labels))
        return pd.DataFrame([row], columns=names)

    return sided.groupBy("series", "fold_id").applyInPandas(run, LOGISTIC_SCHEMA)


# fixed values: the stages of the model ladder, by what each adds to its base
LADDER = {
    "B0": (None, ()),
    "B1": (None, ("log(RV_1d)",)),
    "B2": (None, ("log(RV_1d)", "log(RV_7d)", "log(RV_30d)")),
    "M1": ("B2", ("funding_24h_sum", "dlog_oi_24h", "native_premium_1h_mean")),
    "M2": ("M1", ("spot_perp_dislocation",)),
    "M2K": ("M2", ("kraken_ret_1h", "kraken_rv_24h", "binance_kraken_ret_divergence_1h", "binance_kraken_cross_quote_log_ratio")),
    "M3": ("M2", ("eth_ret_1h", "eth_rv_24h", "eth_funding_24h_sum", "eth_native_premium_1h_mean", "eth_btc_relative_ret_24h")),
    "M3b": ("M3", ("eth_dlog_oi_24h",)),
    "M4": ("M3", ("kraken_ret_1h", "kraken_rv_24h", "binance_kraken_ret_divergence_1h", "binance_kraken_cross_quote_log_ratio")),
}


def ladder_features(stage: str) -> tuple[str, ...]:
    """All features of a stage of the ladder, its bases' first."""
    base, adds = LADDER[stage]
    return (ladder_features(base) if base else ()) + adds


def ladder_walk_forward(sided: DataFrame, stages: tuple[str, ...], label: str = "label") -> DataFrame:
    """Per fold and stage: log-loss and Brier score of the stage's logistic model
    on the rows (series, fold_id, side, row_index, label 0 or 1, features) that
    are complete for it; without features, of the climatology. Fewer usable train
    rows than the minimum fail the job."""
    schema = "series string, fold_id int, stage string, features int, n_train long, n_test long, log_loss decimal(38,18), brier decimal(38,18)"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for stage in stages:
            names = list(ladder_features(stage))
            own = pdf.dropna(subset=[*names, label]).sort_values("row_index")
            train, test = own[own["side"] == "train"], own[own["side"] == "test"]
            if test.empty:
                continue
            _enough(len(train), pdf["fold_id"].iloc[0])
            y, truth = [int(v) for v in train[label]], [int(v) for v in test[label]]
            rows = lambda part: [list(r) for r in part[names].itertuples(index=False, name=None)]  # noqa: B023, E731
            if names:
                model = fit_logistic(rows(train), y)
                p = [model.probability(r) for r in rows(test)]
            else:
                p = [climatology(sum(y), len(y) - sum(y))] * len(truth)
            out.append((pdf["series"].iloc[0], pdf["fold_id"].iloc[0], stage, len(names), len(train), len(test), log_loss(p, truth), brier(p, truth)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return sided.groupBy("series", "fold_id").applyInPandas(run, schema)


def kill_gate(means: DataFrame) -> DataFrame:
    """Every criterion of the gate on mean metrics, and whether all pass."""
    checks = {k: (F.col(k) >= float(v) if op == ">=" else F.col(k) <= float(v)) for k, (op, v) in KILL.items()}
    passed = means.select("*", *[c.alias(f"pass_{k}") for k, c in checks.items()])
    return passed.withColumn("passes", F.expr(" and ".join(f"pass_{k}" for k in checks)))


def ridge_blocks(research: DataFrame, x: str, y: str) -> DataFrame:
    """Sufficient statistics of one feature for all anchored train windows.

    Rows fall into blocks at the folds' train ends; running sums over blocks
    give every fold's statistics in one pass, however many folds there are.
    """
    valid = research.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    block = F.greatest(F.lit(0), F.floor((F.col("row_index") - TRAIN) / TEST) + 1).cast("int")
    sums = valid.groupBy("series", block.alias("fold_id")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(F.col(x) * F.col(x)).alias("sxx"), F.sum(F.col(x) * F.col(y)).alias("sxy")
    )
    w = Window.partitionBy("series").orderBy("fold_id").rowsBetween(Window.unboundedPreceding, 0)
    return sums.select("series", "fold_id", *[F.sum(c).over(w).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])


def ridge_one_feature(stats: DataFrame, penalty: float = 1.0) -> DataFrame:
    """Closed form of ridge with one standardised feature, from its statistics."""
    n = F.col("n")
    mx, my = F.col("sx") / n, F.col("sy") / n
    sd = F.sqrt(F.col("sxx") / n - mx * mx)
    return stats.withColumns({"mean_x": mx, "mean_y": my, "sd_x": sd}).withColumn("weight", (F.col("sxy") - n * F.col("mean_x") * F.col("mean_y")) / F.col("sd_x") / (n + penalty))
