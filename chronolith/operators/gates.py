"""Pre-registered gates as projections, the retention graph, and calibration."""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolith.functions.exact import CTX, q18
from chronolith.operators.models import MOST_ITERATIONS, MU_LIMIT, ONE, TOLERANCE, ZERO, _dot, _sigmoid, solve

# fixed values: registered thresholds and closed lists
HYPOTHESES = ("H_ETH", "H_K_M2", "H_K_M3")
CALIBRATION_BAND = (0.8, 1.2)
FAIL_CLOSED = ("single_class_training_outcome", "constant_train_feature", "zero_pivot", "non_convergence", "binary_float_input", "calibration_single_class_outcome", "calibration_degenerate_logit")


def _all(df: DataFrame, checks: dict[str, Column], name: str) -> DataFrame:
    marked = df.withColumns(checks)
    return marked.withColumn(name, F.expr(" and ".join(f"`{k}`" for k in checks)))


def ic_gate(summaries: DataFrame) -> DataFrame:
    """Of sd, ci_low, ci_high, p_value: stop, proceed, or proceed with a caveat."""
    stop = (F.col("sd") > 0.20) | F.lit(0).between(F.col("ci_low"), F.col("ci_high")) | (F.col("p_value") > 0.05)
    return summaries.withColumn("verdict", F.when(stop, "STOP_PUBLISH_NEGATIVE").when(F.col("sd") < 0.10, "PROCEED").otherwise("PROCEED_WITH_CAVEAT"))


def phase_gate(results: DataFrame, least_year: float = 0.5) -> DataFrame:
    """The lower bound must be positive and every year's mean AUC high enough."""
    return _all(results, {"bound_positive": F.col("lower") > 0, "years_pass": F.col("min_year_auc") >= least_year}, "continues")


def replication_gate(evidence: DataFrame) -> DataFrame:
    """Five conditions on bss, ci_low, bias, slope and calibrated."""
    checks = {
        "bss_at_least": F.col("bss") >= 0.02, "ci_above_zero": F.col("ci_low") > 0, "bias_within": F.abs("bias") <= 0.02,
        "slope_in_band": F.col("slope").between(*CALIBRATION_BAND), "calibration_defined": F.col("calibrated"),
    }
    return _all(evidence, checks, "holds").withColumn("outcome", F.when(F.col("holds"), "REPLICATED").otherwise("DID_NOT_REPLICATE")).drop("holds")


def hypothesis_gate(evidence: DataFrame) -> DataFrame:
    """Five conjunctive retention criteria; ``rejected`` comes from Holm."""
    checks = {
        "improvement_at_least": F.col("improvement") >= 0.01, "ci_above_zero": F.col("ci_low") > 0, "holm_rejected": F.col("rejected"),
        "two_years_improve": F.col("improved_years") >= 2, "no_year_far_worse": F.col("worst_year") >= -0.02,
    }
    return _all(evidence, checks, "passes")


def retained_model(decisions: DataFrame) -> DataFrame:
    """The model that a complete family of decisions (name, passes) retains."""
    passed = {h: F.coalesce(F.bool_or((F.col("name") == h) & F.col("passes")), F.lit(False)) for h in HYPOTHESES}
    deep = F.when(passed["H_K_M3"], "M4").otherwise("M3")
    flat = F.when(passed["H_K_M2"], "M2K").otherwise("M2")
    return decisions.agg(F.when(F.count_distinct("name") != len(HYPOTHESES), F.raise_error(F.lit("incomplete family")).cast("string")).when(passed["H_ETH"], deep).otherwise(flat).alias("retained"))


class Calibration(NamedTuple):
    intercept: Decimal
    slope: Decimal
    iterations: int


def calibrate(probabilities: list[Decimal], labels: list[int]) -> Calibration | str:
    """Unpenalised logistic fit on the logit, in raw units; or the cause that
    forbids one."""
    if any(isinstance(p, float) for p in probabilities):
        return "binary_float_input"
    if len(set(labels)) < 2:
        return "calibration_single_class_outcome"
    high = CTX.subtract(ONE, MU_LIMIT)
    held = [max(MU_LIMIT, min(high, p)) for p in probabilities]
    logits = [CTX.ln(CTX.divide(p, CTX.subtract(ONE, p))) for p in held]
    n = Decimal(len(logits))
    center = CTX.divide(_dot(logits, [ONE] * len(logits)), n)
    spread = [CTX.subtract(x, center) for x in logits]
    sd = CTX.sqrt(CTX.divide(_dot(spread, spread), n))
    if sd.is_zero():
        return "calibration_degenerate_logit"
    rows = [[ONE, CTX.divide(x, sd)] for x in spread]
    w = [ZERO, ZERO]
    for step in range(1, MOST_ITERATIONS + 1):
        gram, right = [[ZERO, ZERO], [ZERO, ZERO]], [ZERO, ZERO]
        for row, y in zip(rows, labels, strict=True):
            eta = _dot(w, row)
            mu, _ = _sigmoid(eta)
            v = CTX.multiply(mu, CTX.subtract(ONE, mu))
            z = CTX.add(eta, CTX.divide(CTX.subtract(Decimal(y), mu), v))
            for i in (0, 1):
                right[i] = CTX.add(right[i], CTX.multiply(CTX.multiply(v, row[i]), z))
                for j in (0, 1):
                    gram[i][j] = CTX.add(gram[i][j], CTX.multiply(CTX.multiply(v, row[i]), row[j]))
        new = solve(gram, right)
        moved = max(abs(CTX.subtract(a, b)) for a, b in zip(new, w, strict=True))
        w = new
        if moved <= TOLERANCE:
            slope = CTX.divide(w[1], sd)
            return Calibration(q18(CTX.subtract(w[0], CTX.multiply(slope, center))), q18(slope), step)
    return "non_convergence"
