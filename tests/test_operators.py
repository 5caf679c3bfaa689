"""Operators against literal expectations, plain-Python loops and invariants."""

import random
from decimal import Decimal
from fractions import Fraction
from math import log

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronolith import schemas
from chronolith.functions import exact, parse
from chronolith.operators import bars as B
from chronolith.operators import diagnostics as D
from chronolith.operators import evaluate as V
from chronolith.operators import features as X
from chronolith.operators import folds as W
from chronolith.operators import joins as J
from chronolith.operators import models as M
from chronolith.operators import nested
from chronolith.operators import quality as QE

HOUR = 3_600_000
T0 = 1_704_067_200_000


def bars_of(spark, closes, volumes=None, series="S"):
    volumes = volumes or [10 + i % 7 for i in range(len(closes))]
    return spark.createDataFrame([(series, T0 + i * HOUR, c, c + 5, c - 5, c, v, 3, 1) for i, (c, v) in enumerate(zip(closes, volumes))], "series string, open_ms long, open long, high long, low long, close long, volume long, trades long, taker long")


def exact_rows(spark, closes, volumes=None):
    return {r.row_index: r for r in X.research_table_exact(bars_of(spark, closes, volumes)).collect()}


def test_exact_features_literals(spark):
    assert exact_rows(spark, [100, 101])[1].f_ret_1 == Decimal("0.010000000000000000")
    rows = exact_rows(spark, [1, 2] * 11)
    assert rows[20].f_rvol_20 == exact.q18(exact.CTX.sqrt(exact.CTX.divide(Decimal(45), Decimal(76)))) and rows[19].f_rvol_20 is None
    assert exact_rows(spark, [5] * 21, [10] * 20 + [30])[20].f_volratio_20 == exact.q18(exact.CTX.divide(Decimal(30), Decimal(11)))
    assert exact_rows(spark, [100] * 60 + [200])[60].f_roc_60 == 1 and exact_rows(spark, [100] * 60 + [200])[59].f_roc_60 is None


def test_exact_equals_doubles_and_null_budget(spark):
    b = bars_of(spark, [100 + (i * 7) % 13 + i for i in range(90)])
    a, d = {r.row_index: r for r in X.research_table_exact(b).collect()}, {r.row_index: r for r in X.research_table(b).collect()}
    for i, r in a.items():
        for c in ("f_ret_1", "f_roc_60", "f_rvol_20", "f_volratio_20", "l_fwdret_24"):
            assert (getattr(r, c) is None) == (getattr(d[i], c) is None)
            assert getattr(r, c) is None or float(getattr(r, c)) == pytest.approx(getattr(d[i], c), abs=1e-9)
    for c, n in X.null_budget(90).items():
        assert sum(getattr(r, c) is None for r in a.values()) == n


def test_causality(spark):
    rng = random.Random(1)
    closes = [rng.randint(50, 150) for _ in range(120)]
    cut = 80
    changed = closes[: cut + 1] + [c + rng.randint(1, 9) for c in closes[cut + 1 :]]
    earlier = [c + rng.randint(1, 9) for c in closes[:cut]] + closes[cut:]
    get = lambda c: {r.row_index: r for r in X.research_table(bars_of(spark, c, [7] * 120)).collect()}
    base, later, before = get(closes), get(changed), get(earlier)
    for i in range(cut + 1):
        assert [base[i][c] for c in X.FEATURES] == [later[i][c] for c in X.FEATURES]
    for i in range(cut, 120):
        assert (base[i].l_fwdret_24, base[i].l_fwddir_24) == (before[i].l_fwdret_24, before[i].l_fwddir_24)


def test_halo_equals_whole_series(spark):
    b = X.with_index(bars_of(spark, [100 + (i * 37) % 29 for i in range(300)]))
    whole = {r.row_index: r.x for r in b.select("row_index", X.roc_60(X.by_time()).alias("x")).collect()}
    cut = X.with_halo(b, 90)
    got = {r.row_index: r.x for r in cut.select("row_index", "halo", X.roc_60(X.by_time(("series", "chunk"))).alias("x")).filter("not halo").collect()}
    assert got == whole


@given(st.integers(432, 2500))
@settings(max_examples=6, deadline=None)
def test_fold_invariants(spark, n):
    rows = W.folds(spark.createDataFrame([("S", n)], "series string, n long")).orderBy("fold_id").collect()
    assert len(rows) == (n - 360) // 72 and rows[0].test_start == 360 and rows[-1].test_end == n
    for a, b in zip(rows, rows[1:]):
        assert a.test_end == b.test_start
    assert all(r.train_end + 24 == r.test_start and r.train_end - 1 + 24 < r.test_start for r in rows)
    of = {r.i: r.f for r in spark.range(n).select(F.col("id").alias("i"), W.fold_of(F.col("id"), F.lit(n)).alias("f")).collect()}
    for r in rows:
        assert of[r.test_start] == of[r.test_end - 1] == r.fold_id
    trained = {r.fold_id: r.n for r in W.train_rows(spark.range(n).select(F.col("id").alias("row_index")), F.lit(n)).groupBy("fold_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert trained == {r.fold_id: r.train_end for r in rows}


def test_fold_counts_and_small_series(spark):
    counted = spark.createDataFrame([("a", 744), ("b", 2184), ("c", 8784)], "series string, n long")
    assert {r.series: r["count"] for r in W.folds(counted).groupBy("series").count().collect()} == {"a": 5, "b": 25, "c": 117}
    with pytest.raises(Exception, match="undersized"):
        W.folds(spark.createDataFrame([("S", 431)], "series string, n long")).collect()


def test_resample_completeness_and_exact_sums(spark):
    big = Decimal("9999999999.123456789012345678")
    rows = [("S", T0 + i * 60_000, Decimal(100), Decimal(110), Decimal(90), Decimal(105), big, big, 10, big, big, "0") for i in range(60)]
    schema = "series string, open_ms long, open decimal(38,18), high decimal(38,18), low decimal(38,18), close decimal(38,18), base_asset_volume decimal(38,18), quote_asset_volume decimal(38,18), trade_count long, taker_buy_base_volume decimal(38,18), taker_buy_quote_volume decimal(38,18), source_ignore string"
    hour = B.resample_decimal(spark.createDataFrame(rows, schema), HOUR, ["series"])
    r = hour.withColumn("why", B.group_failure(HOUR, 60_000)).first()
    assert r.base_asset_volume == Decimal("599999999947.407407340740740680") and r.trade_count == 600 and r.why is None
    short = B.resample_decimal(spark.createDataFrame(rows[:-1], schema), HOUR, ["series"]).withColumn("why", B.group_failure(HOUR, 60_000)).first()
    assert short.why == "incomplete_group"
    flagged = [(*x[:-1], "1") for x in rows]
    assert B.resample_decimal(spark.createDataFrame(flagged, schema), HOUR, ["series"]).withColumn("why", B.group_failure(HOUR, 60_000)).first().why == "nonzero_source_ignore_in_group"


def test_partitioning_does_not_matter(spark):
    rng = random.Random(2)
    ticks = spark.createDataFrame([(i, T0 + rng.randrange(5) * 1000, f"s{i % 3}", rng.randrange(100), i % 2 == 0) for i in range(300)], "event_id long, t long, series string, cents long, buy boolean")
    a = sorted(map(tuple, B.ticks_to_bars(ticks.repartition(1), 2000).collect()))
    assert a == sorted(map(tuple, B.ticks_to_bars(ticks.repartition(7), 2000).collect()))


def test_gaps_runs_and_conflicts(spark):
    b = bars_of(spark, [1, 2, 3, 4, 5, 6]).filter((F.col("close") != 3) & (F.col("close") != 4))
    assert sorted(r.open_ms for r in B.gaps(b, HOUR).collect()) == [T0 + 2 * HOUR, T0 + 3 * HOUR]
    flags = spark.createDataFrame([("a", i, x) for i, x in enumerate([0, 1, 1, 0, 1, 1, 1, 0])] + [("b", 0, 0)], "k string, i int, f int").withColumn("f", F.col("f") == 1)
    assert {r.k: r.longest for r in B.longest_run(flags, ["k"], "i", "f").collect()} == {"a": 3, "b": 0}
    d = spark.createDataFrame([(1, "x", 0), (1, "x", 1), (2, "x", 0), (2, "y", 1)], "k int, c string, at int")
    out = {r.k: r for r in B.dedup_conflicts(d, ["k"], F.col("c"), F.col("at")).collect()}
    assert (out[1].copies, out[1].conflict) == (2, False) and (out[2].variants, out[2].conflict) == (2, True)


def test_parsers(spark):
    texts = ["0", "1.50", "01", "1.", ".5", "-1", "8.4E-7", "1e3", "0.5E1", "1" * 21, "0." + "1" * 19, "0.1" + "0" * 30, None, "1" * 20 + "." + "1" * 18]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse.decimal_reason(F.col("t")).alias("r"), parse.expand_scientific(F.col("t")).alias("e"), parse.exact_decimal(F.col("t")).alias("v")).collect()
    got = {r.t: (r.r, r.e, r.v) for r in rows}
    assert got["0"][0] is None and got["1.50"][2] == Decimal("1.5") and got["01"][0] == got["1."][0] == got[".5"][0] == got["-1"][0] == got[None][0] == "malformed"
    assert got["8.4E-7"][1] == "0.00000084" and got["1e3"][1] == "1000" and got["0.5E1"][1] == "05"
    assert got["1" * 21][0] == "integer_overflow" and got["0." + "1" * 19][0] == "fraction_overflow" and got["0.1" + "0" * 30][0] is None
    assert got["1" * 20 + "." + "1" * 18][0] is None
    r = spark.createDataFrame([("1704067200000", "1704067200", "2024-01-01 00:00:00", "9" * 19, "-0.5")], "a string, b string, c string, d string, e string").select(
        parse.fixed_epoch_ms(F.col("a")).alias("a"), parse.fixed_epoch_ms(F.col("b")).alias("b"), parse.datetime_ms(F.col("c")).alias("c"), parse.int64(F.col("d")).alias("d"), parse.signed_decimal(F.col("e")).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (T0, T0, T0, None, Decimal("-0.5"))


def test_ranks_and_coefficients():
    d = lambda *xs: [Decimal(x) for x in xs]
    assert V.ranks(d(30, 10, 20, 20)) == d("4", "1", "2.5", "2.5")
    assert V.pearson(d(1, 2, 3), d(2, 4, 7)) == Decimal("0.993399267798782855")
    assert V.spearman(d(1, 2, 3), d(2, 4, 7)) == 1
    with pytest.raises(V.MetricDomainError):
        V.pearson(d(1, 1), d(1, 2))
    assert V.median_exact(d(1, 2)) == Decimal("1.5")


def test_model_metrics():
    half = [Decimal("0.5")] * 2
    assert float(M.log_loss(half, [1, 0])) == pytest.approx(log(2)) and M.brier(half, [1, 0]) == Decimal("0.25")
    assert M.climatology(3, 1) == Decimal("0.75")


def test_solver_and_models():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = x @ [0.5, -1.0, 2.0] + 0.3
    rows = [[Decimal(repr(v)) for v in r] for r in x.tolist()]
    fit = M.fit_ridge(rows, [Decimal(repr(v)) for v in y.tolist()])
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
    assert [float(w) for w in fit.weights] == pytest.approx(list(want))
    labels = (y + rng.normal(size=60) > 0).astype(int).tolist()
    logistic = M.fit_logistic(rows, labels)
    assert logistic.converged
    w = np.array([float(v) for v in logistic.weights])
    a = np.hstack([np.ones((60, 1)), z])
    p = 1 / (1 + np.exp(-(a @ w)))
    gradient = a.T @ (np.array(labels) - p) - np.array([0, 1, 1, 1]) * w
    assert np.abs(gradient).max() < 1e-8


def test_splitmix_and_geometry():
    rng = D.SplitMix64(0)
    assert [rng.next() for _ in range(5)] == [16294208416658607535, 7960286522194355700, 487617019471545679, 17909611376780542444, 1961750202426094747]
    assert D.hours_in(2022) == 8760 and D.hours_in(2024) == 8784
    assert exact.fraction18(1, 3) == "0.333333333333333333" and exact.fraction18(-1, 2 * 10**18) == "0.000000000000000000"
    assert D.pooled_mean([(1, 2), (2, 4)]) == Fraction(1, 2)


def test_block_means_equal_plain_sums(spark):
    values = [None if i % 29 in (0, 1) else ((i * 17) % 41) - 18 for i in range(500)]
    grid = spark.createDataFrame([(2024, i, v) for i, v in enumerate(values)], "year int, hour_idx long, d long")
    hours = spark.createDataFrame([(2024, 500)], "year int, hours int")
    starts = D.block_starts(hours, "c", 20)
    got = {r.replicate: (r.num, r.den) for r in D.block_means(starts, D.prefix_sums(grid)).collect()}
    rng = D.SplitMix64(D.stream_seed("c", 2024))
    for k in range(20):
        at = []
        for take in (168, 168, 164):
            s = rng.below(500 - 168 + 1)
            at += range(s, s + take)
        drawn = [values[i] for i in at if values[i] is not None]
        assert got[k] == (sum(drawn), len(drawn))


def test_auc_against_pairs(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(6), rng.randrange(2)) for _ in range(80)] + [("c", 1, 1)]
    df = spark.createDataFrame(rows, "g string, score int, label int")

    def brute(xs):
        p, n = [s for s, y in xs if y], [s for s, y in xs if not y]
        return sum((a > b) + (a == b) / 2 for a in p for b in n) / (len(p) * len(n)) if p and n else None

    for r in D.auc(df, ("g",)).collect():
        assert r.auc == pytest.approx(brute([(s, y) for g, s, y in rows if g == r.g]))
    assert D.auc_by_value(df).first().auc == pytest.approx(brute([(s, y) for _, s, y in rows]))


def test_holm_and_nearest_rank(spark):
    out = {r.name: r.rejected for r in D.holm(spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03)], "name string, p double")).collect()}
    assert out == {"a": True, "b": False, "c": False}
    v = spark.createDataFrame([(i,) for i in range(1, 101)], "x int")
    assert D.nearest_rank(v, "x", 1, 40).first().value == 3 and D.nearest_rank(v, "x", 39, 40).first().value == 98


def test_asof_is_strict_and_buckets_agree(spark):
    rng = random.Random(9)
    left = [(k, i, rng.randrange(50)) for k in "ab" for i in range(40)]
    right = [(k, rng.randrange(50), i, i * 10) for k in "ab" for i in range(25)]
    L, R = spark.createDataFrame(left, "k string, i int, t long"), spark.createDataFrame(right, "k string, rt long, tie long, v int")
    for out in (J.asof(L, R, "t", "rt", ["k"], ["v"], "tie"), J.asof_bucketed(L, R, "t", "rt", ["k"], ["v"], "tie", 7)):
        for r in out.collect():
            before = [(rt, tie, v) for k, rt, tie, v in right if k == r.k and rt < r.t]
            assert r.v == (max(before)[2] if before else None)
    loose = {(r.k, r.i): r.v for r in J.asof(L, R, "t", "rt", ["k"], ["v"], "tie", strict=False).collect()}
    for k, i, t in left:
        upto = [(rt, tie, v) for kk, rt, tie, v in right if kk == k and rt <= t]
        assert loose[k, i] == (max(upto)[2] if upto else None)


def test_expectations(spark):
    b = QE.with_neighbours(bars_of(spark, [10, 11, 12, 13]).filter("close <> 12"))
    found = {r.check_id: r for r in QE.findings(b, QE.bar_checks(HOUR, T0, T0 + 4 * HOUR)).collect()}
    assert found["row_count_matches_expected"].violations == 1 and found["adjacency_exact"].violations == 1 and found["ohlc_bounds_hold"].outcome == "pass"
    assert QE.state(QE.findings(b, QE.bar_checks(HOUR, T0, T0 + 4 * HOUR))).first().state == "FAIL"
    derived = {r.check_id: r.outcome for r in QE.findings(b, QE.bar_checks(HOUR, T0, T0 + 4 * HOUR, "derived_", True)).collect()}
    assert derived["derived_first_boundary_exact"] == "not_evaluated"
    warned = spark.createDataFrame([("w", "warning", 1, "warn")], "check_id string, severity string, violations long, outcome string")
    ok = spark.createDataFrame([("w", True)], "check_id string, matches boolean")
    assert QE.effective_state(warned, ok).first().effective == "WARN_APPROVED"
    assert QE.effective_state(warned, ok.withColumn("matches", F.lit(False))).first().effective == "WARN_BLOCKED"


def test_schemas(spark, tmp_path):
    assert len(schemas.CANONICAL) == 23 and len(schemas.RESEARCH) == 7 and len(schemas.SCALAR_SERIES) == 22 and len(schemas.KLINE_SERIES) == 30
    assert schemas.fingerprint(schemas.RESEARCH) != schemas.fingerprint(schemas.RESEARCH, "v2")
    df = X.research_table_exact(bars_of(spark, list(range(100, 130)))).withColumnRenamed("open_ms", "open_time_ms")
    schemas.write_exact(df, str(tmp_path / "r"), schemas.RESEARCH)
    assert schemas.read_exact(spark, str(tmp_path / "r"), schemas.RESEARCH).count() == 30
    with pytest.raises(schemas.SchemaDrift):
        schemas.read_exact(spark, str(tmp_path / "r"), schemas.FOLDS)


def test_ladder_and_training_errors(spark, monkeypatch):
    rng = np.random.default_rng(3)
    names = M.ladder_features("M4")
    assert [len(M.ladder_features(s)) for s in ("B0", "B1", "B2", "M1", "M2", "M2K", "M3", "M3b", "M4")] == [0, 1, 3, 6, 7, 11, 12, 13, 16]
    rows = []
    for k in range(290):
        x = [Decimal(str(round(v, 6))) for v in rng.normal(size=len(names))]
        rows.append(("s", 0, "train" if k < 240 else "test", k, int(float(x[0]) + rng.normal() > 0), *x))
    frame = spark.createDataFrame(rows, "series string, fold_id int, side string, row_index long, label int, " + ", ".join(f"`{c}` decimal(38,18)" for c in names))
    out = {r.stage: r for r in M.ladder_walk_forward(frame, ("B0", "B1", "M1")).collect()}
    assert out["B1"].log_loss < out["B0"].log_loss and out["M1"].features == 6 and out["B0"].n_train == 240
    with pytest.raises(Exception, match="150 usable train rows"):
        M.ladder_walk_forward(frame.filter("row_index < 150 or side = 'test'"), ("B1",)).collect()
    monkeypatch.setattr(M, "MOST_ITERATIONS", 1)
    with pytest.raises(M.TrainingError, match="irls_did_not_converge"):
        M.fit_logistic([[Decimal(k)] for k in range(8)], [0, 0, 1, 0, 1, 0, 1, 1])


def test_percentile_and_flips(spark):
    assert D.percentile([Decimal(k) for k in (1, 2, 4, 8)], Decimal("0.25")) == Decimal("1.75")
    ics = spark.createDataFrame([(k, 0.1) for k in range(9)], "fold_id int, ic double")
    r = D.ic_resampling(ics, replicates=400).first()
    assert r.ci_low == r.ci_high == r.mean == pytest.approx(0.1) and r.p_value * 400 == round(r.p_value * 400) and r.p_value < 0.05
    out = {r.block: r for r in D.block_sign_flips(ics, replicates=2000).collect()}
    assert out[1].z == pytest.approx(3, rel=0.1) and out[1].p_value < out[4].p_value
    one = spark.createDataFrame([(k // 20, k, float(np.sin(k / 3)), k % 2) for k in range(200)], "fold_id int, row_index long, score double, label int")
    r = D.ar1_surrogates(one, surrogates=40).first()
    assert r.phi == pytest.approx(np.cos(1 / 3), abs=0.02) and r.null_low < r.null_sd < r.null_high


def test_nested_leaves(spark):
    docs = spark.createDataFrame([('{"a": [1, {"b": "2025-03-01"}, "7"], "c": {}, "d": true}',), (None,), ("no json",), ("5",)], "doc string")
    assert sorted(map(tuple, nested.leaves(docs, "doc").select("path", "value").collect())) == [("$", "5"), ("$.a[0]", "1"), ("$.a[1].b", "2025-03-01"), ("$.a[2]", "7"), ("$.d", "true")]
    assert {r.path: r.n for r in nested.value_range(docs, "doc", 5, 8, 2025).collect()} == {"$": 1, "$.a[1].b": 1, "$.a[2]": 1}
