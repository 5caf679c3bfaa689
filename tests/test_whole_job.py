"""Registered queries do the whole job: all replicates, all rows, all hours."""

import hashlib
import os

import pytest

from chronolith.operators import diagnostics as D
from chronolith.plans import catalogue
from chronolith.plans import research_sql as R

DATA = "/root/testdata/sf0.001"
small_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="the small tables are not here")


@small_tables
def test_all_replicates(spark):
    run = lambda name: catalogue.QUERIES[name](spark, DATA).first()
    assert run("bootstrap_moving_block").replicates == 20_000
    assert run("phase_bootstrap").replicates == 10_000
    # the p-value's denominator is the replicates
    times = run("ic_resampling").p_value * 10_000
    assert times == pytest.approx(round(times), abs=1e-6)


@small_tables
def test_multiplicity_of_all_replicates(spark):
    hours = R.hours(spark, DATA).first().hours
    rng, many = D.SplitMix64(D.stream_seed("candidate-vs-b2", 2024)), [0] * hours
    for _ in range(20_000):
        for low in range(0, hours, D.BLOCK_HOURS):
            start = rng.below(hours - D.BLOCK_HOURS + 1)
            for at in range(start, start + min(D.BLOCK_HOURS, hours - low)):
                many[at] += 1
    want = hashlib.sha256("".join(f"{i}:{m}\n" for i, m in enumerate(many)).encode()).hexdigest()
    assert catalogue.QUERIES["bootstrap_multiplicity"](spark, DATA).first().digest == want


def test_circular_bootstrap_runs(spark):
    rows = spark.createDataFrame([(i, float((i * 7) % 31), i % 7 % 2) for i in range(400)], "row_index long, score double, label int")
    whole = D.circular_block_bootstrap(rows, replicates=150).first()
    D_run, D.REPLICATES_PER_TASK = D.REPLICATES_PER_TASK, 7
    try:
        cut = D.circular_block_bootstrap(rows, replicates=150).first()
        assert (cut.replicates, cut.lower) == (150, whole.lower) and cut.mean == pytest.approx(whole.mean)
    finally:
        D.REPLICATES_PER_TASK = D_run
