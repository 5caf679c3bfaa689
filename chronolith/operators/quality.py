"""Expectation suites: each is one aggregation, unpivoted into findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HARD, WARNING = "hard", "warning"


def findings(rows: DataFrame, checks: dict[str, tuple[str, Column]], keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, check_id, severity, violations, outcome from one scan of ``rows``.

    ``checks`` maps an id to its severity and the aggregate that counts its
    violations; null means not evaluated.
    """
    counted = rows.groupBy(*keys).agg(*[c.cast("long").alias(k) for k, (_, c) in checks.items()])
    parts = ", ".join(f"'{k}', '{s}', `{k}`" for k, (s, _) in checks.items())
    long = counted.select(*keys, F.expr(f"stack({len(checks)}, {parts}) as (check_id, severity, violations)"))
    bad = F.when(F.col("severity") == HARD, "fail").otherwise("warn")
    return long.withColumn("outcome", F.when(F.col("violations").isNull(), "not_evaluated").when(F.col("violations") == 0, "pass").otherwise(bad))


def state(found: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """FAIL if any check failed or was not evaluated, else WARN_BLOCKED if any
    warned, else PASS."""
    failed = F.count_if(F.col("outcome").isin("fail", "not_evaluated"))
    warned = F.count_if(F.col("outcome") == "warn")
    return found.groupBy(*keys).agg(failed.alias("failed"), warned.alias("warned")).withColumn("state", F.when(F.col("failed") > 0, "FAIL").when(F.col("warned") > 0, "WARN_BLOCKED").otherwise("PASS"))


def effective_state(found: DataFrame, matches: DataFrame) -> DataFrame:
    """WARN_APPROVED only if all warnings and all approvals match one to one."""
    base = state(found)
    open_ = matches.agg(F.count_if(~F.col("matches")).alias("unmatched"), F.count(F.lit(1)).alias("rows"))
    return base.withColumn("k__", F.lit(1)).join(open_.withColumn("k__", F.lit(1)), "k__").drop("k__").withColumn(
        "effective", F.when(F.col("state") != "WARN_BLOCKED", F.col("state")).when((F.col("unmatched") == 0) & (F.col("rows") > 0), "WARN_APPROVED").otherwise("WARN_BLOCKED")
    )


def with_neighbours(bars: DataFrame, key: str = "series", t: str = "open_ms") -> DataFrame:
    return bars.withColumn("prev__", F.lag(t).over(Window.partitionBy(key).orderBy(t)))


def bar_checks(step: int, start: int, end: int, prefix: str = "", derived: bool = False, t: str = "open_ms") -> dict[str, tuple[str, Column]]:
    """The checks of a bar table over [start, end), by id."""
    tt = F.col(t)
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    rows = F.count(F.lit(1))
    expected = (end - start) // step
    negative = (F.count_if(F.col("volume") < 0) + F.count_if(F.col("trades") < 0)) if not derived else F.count_if((F.col("volume") < 0) | (F.col("trades") < 0))
    whole = rows == expected
    return {
        f"{prefix}row_count_matches_expected": (HARD, F.abs(rows - expected)),
        f"{prefix}first_boundary_exact": (HARD, F.when(whole, (F.min(tt) != start).cast("int")) if derived else F.when(whole & (F.min(tt) != start), 1).otherwise(0)),
        f"{prefix}last_boundary_exact": (HARD, F.when(whole, (F.max(tt) != end - step).cast("int")) if derived else F.when(whole & (F.max(tt) != end - step), 1).otherwise(0)),
        f"{prefix}unique_open_times": (HARD, rows - F.count_distinct(tt)),
        f"{prefix}adjacency_exact": (HARD, F.count_if(tt - F.col("prev__") != step)),
        f"{prefix}period_membership_respected": (HARD, F.count_if(~((tt >= start) & (tt < end)))),
        f"{prefix}ohlc_bounds_hold": (HARD, F.count_if(~((h >= o) & (h >= c) & (lo <= o) & (lo <= c) & (h >= lo)))),
        f"{prefix}prices_strictly_positive": (HARD, F.count_if(~(F.least(o, h, lo, c) > 0))),
        f"{prefix}volumes_and_counts_nonnegative": (HARD, negative),
        f"{prefix}taker_within_total": (HARD, F.count_if(F.col("taker") > F.col("volume"))),
        f"{prefix}zero_volume_candle": (WARNING, F.count_if((F.col("volume") == 0) & (F.col("taker") == 0))),
    }


def research_checks(n: int) -> dict[str, tuple[str, Column]]:
    """Null budgets, positivity and sign consistency of a research table."""
    from chronolith.operators.features import null_budget

    checks: dict[str, tuple[str, Column]] = {f"research_null_budget_{c}": (HARD, F.abs(F.count_if(F.col(c).isNull()) - b)) for c, b in null_budget(n).items()}
    ret, way = F.col("l_fwdret_24"), F.col("l_fwddir_24")
    return checks | {
        "research_row_count_matches_parent": (HARD, F.abs(F.count(F.lit(1)) - n)),
        "research_unique_open_times": (HARD, F.count(F.lit(1)) - F.count_distinct("open_ms")),
        "research_rvol_strictly_positive": (HARD, F.count_if(F.col("f_rvol_20") <= 0)),
        "research_fwddir_sign_consistent": (HARD, F.count_if((ret.isNull() != way.isNull()) | (F.signum(ret) != way))),
    }


def fold_findings(plan: DataFrame, stats: DataFrame, expected: DataFrame) -> DataFrame:
    """The seven checks of a fold plan against its statistics."""
    columns = ("f_ret_1", "f_roc_60", "f_rvol_20", "f_volratio_20", "l_fwdret_24", "l_fwddir_24")
    want = expected.select("series", "fold_id", *[F.col(c).alias(f"want_{c}") for c in columns])
    j = plan.join(stats, ["series", "fold_id"], "left").join(want, ["series", "fold_id"], "left")
    w = Window.partitionBy("series").orderBy("fold_id")
    j = j.withColumns({"last_end__": F.lag("test_end").over(w), "last_ms__": F.lag("last_ms").over(w)})
    nulls = F.lit(False)
    for c in columns:
        nulls = nulls | (F.col(f"null_{c}") != F.col(f"want_{c}"))
    tiled = F.coalesce(F.col("last_end__") != F.col("test_start"), F.col("test_start") != 360) | (F.col("n_rows") != F.col("test_end") - F.col("test_start"))
    return findings(
        j,
        {
            "validation_coverage_partition": (HARD, F.count_if(tiled) + F.abs(F.sum("n_rows") + 360 - F.max("n"))),
            "validation_fold_count": (HARD, F.abs(F.count(F.lit(1)) - F.floor((F.max("n") - 360) / 72))),
            "validation_fold_leakage_invariants": (HARD, F.count_if(~((F.col("train_end") - 1 + 24 < F.col("test_start")) & (F.col("train_end") <= F.col("embargo_start")) & (F.col("embargo_end") <= F.col("test_start"))))),
            "validation_structural_nulls": (HARD, F.count_if(nulls)),
            "validation_sign_distribution_sum": (HARD, F.count_if(F.col("down") + F.col("flat") + F.col("up") != F.col("n_rows") - F.col("null_l_fwddir_24"))),
            "validation_returns_bounds": (HARD, F.count_if(~((F.col("min_ret") <= F.col("mean_ret")) & (F.col("mean_ret") <= F.col("max_ret"))))),
            "validation_time_bounds": (HARD, F.count_if((F.col("first_ms") > F.col("last_ms")) | (F.col("first_ms") <= F.col("last_ms__")))),
        },
        ("series",),
    )


def evaluation_findings(records: DataFrame, folds: int, features: int) -> DataFrame:
    """Matrix, pair counts and bounds of information-coefficient records."""
    p, s = F.col("pearson_ic"), F.col("spearman_ic")
    return findings(
        records,
        {
            "evaluation_record_matrix": (HARD, F.abs(F.count(F.lit(1)) - folds * features) + F.count(F.lit(1)) - F.count_distinct("fold_id", "feature")),
            "evaluation_pair_counts": (HARD, F.count_if((F.col("n_pairs") > F.col("n_rows")) | (F.col("n_pairs") < F.col("n_rows") - F.col("x_nulls") - F.col("y_nulls")))),
            "evaluation_numeric_domain": (HARD, F.count_if(p.isNull() | s.isNull() | F.isnan(p) | F.isnan(s))),
            "evaluation_metric_bounds": (HARD, F.count_if((F.abs(p) > 1) | (F.abs(s) > 1))),
        },
        ("series",),
    )


def training_findings(records: DataFrame, folds: int) -> DataFrame:
    """Matrix, bounds, baselines and determinism of walk-forward training
    records, of ridge or of the logistic model by the columns that they have."""
    has = set(records.columns)
    missing, unsure, outside = F.lit(False), F.lit(False), F.lit(False)
    for c in ("majority_accuracy", "sign_accuracy", "climatology_p", "climatology_log_loss", "climatology_brier"):
        missing = missing | F.col(c).isNull() if c in has else missing
    for c in ("deterministic", "converged"):
        unsure = unsure | ~F.coalesce(F.col(c), F.lit(False)) if c in has else unsure
    for c, low in (("return_ic", -1), ("direction_ic", -1), ("brier", 0), ("majority_accuracy", 0), ("sign_accuracy", 0), ("climatology_p", 0)):
        outside = outside | ~F.coalesce(F.col(c).between(low, 1), F.lit(True)) if c in has else outside
    return findings(
        records,
        {
            "training_record_matrix": (HARD, F.abs(F.count(F.lit(1)) - folds) + F.count(F.lit(1)) - F.count_distinct("fold_id")),
            "training_train_rows": (HARD, F.count_if(F.col("n_train") < 200)),
            "training_metric_bounds": (HARD, F.count_if(~F.coalesce(F.col("directional_accuracy").between(0, 1), F.lit(False)) | outside)),
            "training_baseline_presence": (HARD, F.count_if(missing)),
            "training_determinism": (HARD, F.count_if(unsure)),
            "training_test_rows": (HARD, F.count_if(~F.coalesce(F.col("n_test") > 0, F.lit(False)))),
        },
        ("series",),
    )


def series_checks(step: int) -> dict[str, tuple[str, Column]]:
    """Grid, duplicate, conflict and close checks of an auxiliary series
    (t, close_ms, copies, variants, prev__)."""
    return {
        "grid_alignment": (HARD, F.count_if(F.pmod("t", F.lit(step)) != 0)),
        "grid_completeness": (WARNING, F.coalesce(F.sum(F.floor((F.col("t") - F.col("prev__")) / step) - 1), F.lit(0))),
        "duplicate_exact_bytes": (WARNING, F.sum(F.when(F.col("variants") == 1, F.col("copies") - 1).otherwise(0))),
        "conflict_same_key": (HARD, F.count_if(F.col("variants") > 1)),
        "source_order": (WARNING, F.lit(0) * F.count(F.lit(1))),
        "derived_close": (HARD, F.count_if(F.col("close_ms") != F.col("t") + step - 1)),
    }


# fixed values: the closed list of exclusion reasons
EXCLUSION_REASONS = (
    "missing_native_interval",
    "incomplete_feature_window",
    "funding_cadence_incomplete",
    "oi_snapshot_gap",
    "invalid_label_endpoint",
    "buffer_bar_missing",
    "pre_archive_period",
    "eth_oi_pre_2021_12_01",
    "same_key_conflict",
)


def gap_disposition(reason: Column) -> Column:
    """The reason if it is of the closed list; a conflict has none and fails."""
    known = F.when(reason.isin(*EXCLUSION_REASONS), reason).otherwise("unclassified_pending_review")
    return F.when(reason == "same_key_conflict", F.raise_error(F.lit("same-key conflicts have no approval disposition")).cast("string")).otherwise(known)
