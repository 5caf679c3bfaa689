"""Registered queries on joins, expectations, identity, protocol features and
relational plumbing, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronolith.operators import bars as B
from chronolith.operators import features as X
from chronolith.operators import folds as W
from chronolith.operators import joins as J
from chronolith.operators import quality as QE
from chronolith.plans.bars_sql import START, bars_sql, hour_bars, ticks_sql
from chronolith.plans.research_sql import FOLDS, RECORDS, RESEARCH, counted, r9, research, sql9, tested, with_n
from chronolith.sources.ticks import DAY, HOUR, table, ticks

Q: dict = {}
S: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql is not None:
            S[name] = sql
        return f

    return put


_ORDERS = "(select o_custkey, o_orderkey, (epoch_us(o_orderdate) // 1000) as o_ts, round(o_totalprice * 100)::bigint as cents from orders)"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("o_ts"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


_ASOF = f"""with r as (select o_custkey, o_ts, max(o_orderkey) as k, arg_max(cents, o_orderkey) as cents from {_ORDERS} group by all)
  select l.o_custkey, l.o_orderkey, l.o_ts, r.o_ts as matched_ts, r.cents as last_cents from {_ORDERS} l asof left join r on l.o_custkey = r.o_custkey and l.o_ts > r.o_ts"""


@query("asof_strict", _ASOF)
def asof_strict(spark, sf_dir):
    """Each order with its customer's last order before it, never at its time."""
    o = _orders(spark, sf_dir)
    return J.asof(o.select("o_custkey", "o_orderkey", "o_ts"), o.select("o_custkey", "o_ts", "o_orderkey", F.col("cents").alias("last_cents")), "o_ts", "o_ts", ["o_custkey"], ["last_cents"], "o_orderkey")


@query("asof_bucketed", _ASOF)
def asof_bucketed(spark, sf_dir):
    """The same through time buckets, for keys too long for one task."""
    o = _orders(spark, sf_dir)
    return J.asof_bucketed(o.select("o_custkey", "o_orderkey", "o_ts"), o.select("o_custkey", "o_ts", "o_orderkey", F.col("cents").alias("last_cents")), "o_ts", "o_ts", ["o_custkey"], ["last_cents"], "o_orderkey", 90 * DAY)


@query(
    "asof_eligible",
    f"select l.open_ms, l.open_ms + {HOUR} + 2 as prediction_ts, r.eligibility_ts as matched_ts, r.close as signup_close from ({bars_sql(HOUR, 'ALL')}) l asof left join (select close, open_ms + 300000 as eligibility_ts from ({bars_sql(HOUR)}) where series = 'signup') r on l.open_ms + {HOUR} + 2 > r.eligibility_ts",
)
def asof_eligible(spark, sf_dir):
    """The last value that was eligible strictly before each prediction."""
    left = hour_bars(spark, sf_dir, "ALL").select(F.lit(1).alias("k"), "open_ms", (F.col("open_ms") + HOUR + 2).alias("prediction_ts"))
    right = hour_bars(spark, sf_dir).filter("series = 'signup'").select(F.lit(1).alias("k"), (F.col("open_ms") + 300_000).alias("eligibility_ts"), F.col("close").alias("signup_close"), F.col("open_ms").alias("tie"))
    return J.asof(left, right, "prediction_ts", "eligibility_ts", ["k"], ["signup_close"], "tie").drop("k")


@query("exact_offset", f"select a.series, a.open_ms, a.close, b.close as close_before from ({bars_sql(HOUR)}) a left join ({bars_sql(HOUR)}) b on b.series = a.series and b.open_ms = a.open_ms - {DAY}")
def exact_offset(spark, sf_dir):
    b = hour_bars(spark, sf_dir).select("series", "open_ms", "close")
    return J.exact_offset(b, b, "open_ms", "open_ms", ["series"], DAY, ["close"])


@query("interval_sum_24h", f"select series, open_ms, count(volume) over w as in_interval, (case when count(volume) over w >= 12 then sum(volume) over w end)::bigint as interval_sum from ({bars_sql(HOUR)}) window w as (partition by series order by open_ms range between {DAY - 1} preceding and current row)")
def interval_sum_24h(spark, sf_dir):
    return J.interval_sum(hour_bars(spark, sf_dir), ["series"], "open_ms", "volume", DAY, 12).select("series", "open_ms", "in_interval", "interval_sum")


@query("paired_sample", f"select a.open_ms, a.close as candidate, b.close as comparator, a.close - b.close as difference from ({bars_sql(HOUR)}) a join ({bars_sql(HOUR)}) b on a.open_ms = b.open_ms where a.series = 'purchase' and b.series = 'click'")
def paired_sample(spark, sf_dir):
    b = hour_bars(spark, sf_dir)
    return J.paired(b.filter("series = 'purchase'"), b.filter("series = 'click'"), ["open_ms"], "close")


@query(
    "reconcile",
    f"""with a as ({bars_sql(HOUR)}), b as (select series, open_ms, case when (open_ms // {HOUR}) % 50 = 0 then close + 1 else close end as close, volume from a where (open_ms // {HOUR}) % 97 <> 0), j as (select a.close as ac, b.close as bc, a.volume as av, b.volume as bv, a.series as s1, b.series as s2 from a full join b on a.series = b.series and a.open_ms = b.open_ms)
    select count(*) filter (where s2 is null) as source_only, count(*) filter (where s1 is null) as stored_only, count(*) filter (where s1 is not null and s2 is not null and ac is not distinct from bc and av is not distinct from bv) as equal,
    count(*) filter (where s1 is not null and s2 is not null and ac is distinct from bc) as diff_close, count(*) filter (where s1 is not null and s2 is not null and av is distinct from bv) as diff_volume from j""",
)
def reconcile(spark, sf_dir):
    a = hour_bars(spark, sf_dir)
    slot = F.floor(F.col("open_ms") / HOUR)
    b = a.filter(slot % 97 != 0).withColumn("close", F.when(slot % 50 == 0, F.col("close") + 1).otherwise(F.col("close")))
    return J.reconcile(a, b, ["series", "open_ms"], ["close", "volume"])


@query("time_identity", f"select count(*) as n_rows, count(*) filter (where a.open_ms is null or b.open_ms is null) as mismatches from (select open_ms from {RESEARCH}) a full join (select open_ms from ({bars_sql(HOUR, 'ALL')})) b on a.open_ms = b.open_ms")
def time_identity(spark, sf_dir):
    a = research(spark, sf_dir).select("open_ms", F.lit(1).alias("in_a"))
    b = hour_bars(spark, sf_dir, "ALL").select("open_ms", F.lit(1).alias("in_b"))
    return a.join(b, "open_ms", "full_outer").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull()).alias("mismatches"))


_END = START + 30 * DAY


def _bar_findings_sql(step: int, bars: str, prefix: str, derived: bool) -> str:
    expected = 30 * DAY // step
    whole = f"count(*) = {expected}"
    first = f"case when {whole} then (min(open_ms) <> {START})::int {'' if derived else 'else 0'} end"
    last = f"case when {whole} then (max(open_ms) <> {_END - step})::int {'' if derived else 'else 0'} end"
    negative = "count(*) filter (where volume < 0 or trades < 0)" if derived else "count(*) filter (where volume < 0) + count(*) filter (where trades < 0)"
    checks = {
        "row_count_matches_expected": f"abs(count(*) - {expected})", "first_boundary_exact": first, "last_boundary_exact": last, "unique_open_times": "count(*) - count(distinct open_ms)",
        "adjacency_exact": f"count(*) filter (where open_ms - prev <> {step})", "period_membership_respected": f"count(*) filter (where not (open_ms >= {START} and open_ms < {_END}))",
        "ohlc_bounds_hold": "count(*) filter (where not (high >= open and high >= close and low <= open and low <= close and high >= low))", "prices_strictly_positive": "count(*) filter (where not least(open, high, low, close) > 0)",
        "volumes_and_counts_nonnegative": negative, "taker_within_total": "count(*) filter (where taker > volume)", "zero_volume_candle": "count(*) filter (where volume = 0 and taker = 0)",
    }
    names = ", ".join(f"'{prefix}{k}'" for k in checks)
    sev = ", ".join("'warning'" if k == "zero_volume_candle" else "'hard'" for k in checks)
    vals = ", ".join(f"({v})::bigint" for v in checks.values())
    return f"""select series, check_id, severity, violations, case when violations is null then 'not_evaluated' when violations = 0 then 'pass' when severity = 'hard' then 'fail' else 'warn' end as outcome
      from (select series, unnest([{names}]) as check_id, unnest([{sev}]) as severity, unnest([{vals}]) as violations from (select *, lag(open_ms) over (partition by series order by open_ms) as prev from ({bars})) group by series)"""


@query("quality_base", _bar_findings_sql(HOUR, bars_sql(HOUR), "", False))
def quality_base(spark, sf_dir):
    return QE.findings(QE.with_neighbours(hour_bars(spark, sf_dir)), QE.bar_checks(HOUR, START, _END), ("series",))


@query("quality_derived", _bar_findings_sql(DAY, bars_sql(DAY), "derived_", True))
def quality_derived(spark, sf_dir):
    days = B.resample(hour_bars(spark, sf_dir), DAY)
    return QE.findings(QE.with_neighbours(days), QE.bar_checks(DAY, START, _END, "derived_", True), ("series",))


@query("quality_state", f"select series, count(*) filter (where outcome in ('fail', 'not_evaluated')) as failed, count(*) filter (where outcome = 'warn') as warned, case when count(*) filter (where outcome in ('fail', 'not_evaluated')) > 0 then 'FAIL' when count(*) filter (where outcome = 'warn') > 0 then 'WARN_BLOCKED' else 'PASS' end as state from ({_bar_findings_sql(HOUR, bars_sql(HOUR), '', False)}) group by series")
def quality_state(spark, sf_dir):
    return QE.state(quality_base(spark, sf_dir), ("series",))


_BUDGETS = {"f_ret_1": 1, "f_roc_60": 60, "f_rvol_20": 20, "f_volratio_20": 19, "l_fwdret_24": 24, "l_fwddir_24": 24}
_RC = {f"research_null_budget_{c}": f"abs(count(*) filter (where {c} is null) - {n})" for c, n in _BUDGETS.items()} | {
    "research_row_count_matches_parent": "abs(count(*) - any_value(n))", "research_unique_open_times": "count(*) - count(distinct open_ms)", "research_rvol_strictly_positive": "count(*) filter (where f_rvol_20 <= 0)",
    "research_fwddir_sign_consistent": "count(*) filter (where (l_fwdret_24 is null) <> (l_fwddir_24 is null) or sign(l_fwdret_24) <> l_fwddir_24)",
}


@query("quality_research", f"select check_id, 'hard' as severity, violations, case when violations = 0 then 'pass' else 'fail' end as outcome from (select unnest([{', '.join(repr(k) for k in _RC)}]) as check_id, unnest([{', '.join(f'({v})::bigint' for v in _RC.values())}]) as violations from {RESEARCH})")
def quality_research(spark, sf_dir):
    rows = research(spark, sf_dir)
    n = hour_bars(spark, sf_dir, "ALL").count()
    return QE.findings(rows, QE.research_checks(n))


@query("quality_folds", f"select series, unnest(['validation_coverage_partition','validation_fold_count','validation_fold_leakage_invariants','validation_structural_nulls','validation_sign_distribution_sum','validation_returns_bounds','validation_time_bounds']) as check_id, 'hard' as severity, 0::bigint as violations, 'pass' as outcome from (select distinct series from {FOLDS})")
def quality_folds(spark, sf_dir):
    plan = W.folds(counted(spark, sf_dir))
    stats = W.fold_stats(with_n(research(spark, sf_dir)), F.col("n"))
    return QE.fold_findings(plan, stats, W.expected_nulls(plan))


_EV = f"select series, count(*) as m, count(distinct (fold_id, feature)) as d, count(*) filter (where n_pairs > n_rows or n_pairs < n_rows - x_nulls - y_nulls) as p, count(*) filter (where pearson_ic is null or spearman_ic is null) as x, count(*) filter (where abs(pearson_ic) > 1 or abs(spearman_ic) > 1) as b from {RECORDS} group by series"


@query("quality_evaluation", f"select series, check_id, 'hard' as severity, violations, case when violations = 0 then 'pass' else 'fail' end as outcome from (select series, unnest(['evaluation_record_matrix','evaluation_pair_counts','evaluation_numeric_domain','evaluation_metric_bounds']) as check_id, unnest([abs(m - (select count(*) from {FOLDS}) * 4) + m - d, p, x, b]::bigint[]) as violations from ({_EV}))")
def quality_evaluation(spark, sf_dir):
    from chronolith.operators.evaluate import ic_records

    many = W.folds(counted(spark, sf_dir)).count()
    return QE.evaluation_findings(ic_records(tested(spark, sf_dir)), many, len(X.FEATURES))


_SER = f"""(select series, t, close_ms, copies, variants, lag(t) over (partition by series order by t) as prev from (select series, t, t + {HOUR - 1} as close_ms, count(*) as copies, count(distinct cents) as variants from (select series, t - t % {HOUR} as t, cents from ({ticks_sql()})) group by series, t))"""


@query(
    "quality_series",
    f"""select series, check_id, severity, violations, case when violations = 0 then 'pass' when severity = 'hard' then 'fail' else 'warn' end as outcome from (select series, unnest(['grid_alignment','grid_completeness','duplicate_exact_bytes','conflict_same_key','source_order','derived_close']) as check_id,
    unnest(['hard','warning','warning','hard','warning','hard']) as severity, unnest([count(*) filter (where t % {HOUR} <> 0), coalesce(sum((t - prev) // {HOUR} - 1), 0), sum(case when variants = 1 then copies - 1 else 0 end), count(*) filter (where variants > 1), 0, count(*) filter (where close_ms <> t + {HOUR - 1})]::bigint[]) as violations from {_SER} group by series)""",
)
def quality_series(spark, sf_dir):
    slots = ticks(spark, sf_dir).select("series", B.bucket("t", HOUR).alias("t"), "cents").groupBy("series", "t", "cents").agg(F.count(F.lit(1)).alias("n"))
    rows = slots.groupBy("series", "t").agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("variants")).withColumn("close_ms", F.col("t") + HOUR - 1)
    return QE.findings(QE.with_neighbours(rows, t="t"), QE.series_checks(HOUR), ("series",))


@query("approval_match", "select * from (values ('zero_volume_candle', 3::bigint, 'ab', 3::bigint, 'ab', true), ('source_order_invalid', 1::bigint, 'cd', 1::bigint, 'ce', false), ('nonzero_source_ignore', null, null, 2::bigint, 'ef', false)) t(check_id, found, found_digest, approved, approved_digest, matches)")
def approval_match(spark, sf_dir):
    w = spark.createDataFrame([("zero_volume_candle", 3, "ab"), ("source_order_invalid", 1, "cd")], "check_id string, count long, digest string")
    a = spark.createDataFrame([("zero_volume_candle", 3, "ab"), ("source_order_invalid", 1, "ce"), ("nonzero_source_ignore", 2, "ef")], "check_id string, count long, digest string")
    return J.match_approvals(w, a)


@query("rv_24_168", f"select open_ms, {sql9('case when n24 = 24 then sqrt(s24) end')} as rv_24, {sql9('case when n168 = 168 then sqrt(s168) end')} as rv_168 from (select open_ms, count(f_ret_1) over a as n24, sum(f_ret_1 * f_ret_1) over a as s24, count(f_ret_1) over b as n168, sum(f_ret_1 * f_ret_1) over b as s168 from {RESEARCH} window a as (order by open_ms rows between 23 preceding and current row), b as (order by open_ms rows between 167 preceding and current row))")
def rv_24_168(spark, sf_dir):
    w = X.by_time()
    rows = research(spark, sf_dir).withColumn("ret", F.col("f_ret_1"))
    return rows.select("open_ms", r9(X.realised_volatility(w, 24)).alias("rv_24"), r9(X.realised_volatility(w, 168)).alias("rv_168"))


_Z = f"(select open_ms, abs(l_fwdret_24) / f_rvol_20 as z from {RESEARCH} where l_fwdret_24 is not null and f_rvol_20 > 0)"


@query("z_label", f"with z as {_Z}, k as (select z as cut from (select z, row_number() over (order by z) as r, count(*) over () as n from z) where r = (4 * n + 4) // 5) select open_ms, {sql9('z')} as z, z > cut as label from z, k")
def z_label(spark, sf_dir):
    """Moves beyond the nearest-rank 0.80 quantile of their scaled size."""
    from chronolith.operators.diagnostics import nearest_rank

    z = research(spark, sf_dir).filter("l_fwdret_24 is not null and f_rvol_20 > 0").select("series", "open_ms", (F.abs("l_fwdret_24") / F.col("f_rvol_20")).alias("z"))
    cut = nearest_rank(z, "z", 4, 5, ("series",)).select("series", F.col("value").alias("cut"))
    return z.join(cut, "series").select("open_ms", r9("z").alias("z"), (F.col("z") > F.col("cut")).alias("label"))


@query("premium_mean_60", f"select open_ms, case when count(*) over w = 60 then {sql9('avg(close) over w')} end as premium_mean from ({bars_sql(60_000, 'ALL')}) window w as (order by open_ms range between {59 * 60_000} preceding and current row)")
def premium_mean_60(spark, sf_dir):
    w = Window.partitionBy("series").orderBy("open_ms").rangeBetween(-59 * 60_000, 0)
    return B.ticks_to_bars(ticks(spark, sf_dir, "ALL"), 60_000).select("open_ms", F.when(F.count(F.lit(1)).over(w) == 60, r9(F.avg("close").over(w))).alias("premium_mean"))


_ROW = "series || '|' || open_ms || '|' || open || '|' || high || '|' || low || '|' || close || '|' || volume || '|' || trades"


@query("row_digest", f"select series, open_ms, sha256({_ROW}) as digest from ({bars_sql(HOUR)})")
def row_digest(spark, sf_dir):
    b = hour_bars(spark, sf_dir)
    return b.select("series", "open_ms", F.sha2(F.encode(F.concat_ws("|", *[F.col(c).cast("string") for c in ("series", "open_ms", "open", "high", "low", "close", "volume", "trades")]), "UTF-8"), 256).alias("digest"))


@query("multiset_fingerprint", f"select series, count(*) as n, (sum(('0x' || substr(sha256({_ROW}), 1, 12))::bigint))::bigint as fingerprint from ({bars_sql(HOUR)}) group by series")
def multiset_fingerprint(spark, sf_dir):
    """An order-free fingerprint that adds up in parallel."""
    return row_digest(spark, sf_dir).groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.sum(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long")).alias("fingerprint"))


@query("q18_render", "select event_id, (round(value * 100)::bigint // 100)::varchar || '.' || lpad((round(value * 100)::bigint % 100)::varchar, 2, '0') || '0000000000000000' as text from events")
def q18_render(spark, sf_dir):
    from chronolith.functions.parse import q18_text

    cents = F.round(F.col("value") * 100).cast("decimal(18,0)")
    return table(spark, sf_dir, "events").select("event_id", q18_text((cents / 100).cast("decimal(20,2)")).alias("text"))


@query("cadence_profile", f"select series, count(delta) as n, min(delta) as low, max(delta) as high, {sql9('avg(delta)', 6)} as mean from (select series, t - lag(t) over (partition by series order by t, event_id) as delta from ({ticks_sql()})) group by series")
def cadence_profile(spark, sf_dir):
    w = Window.partitionBy("series").orderBy("t", "event_id")
    d = ticks(spark, sf_dir).withColumn("delta", F.col("t") - F.lag("t").over(w))
    return d.groupBy("series").agg(F.count("delta").alias("n"), F.min("delta").alias("low"), F.max("delta").alias("high"), r9(F.avg("delta"), 6).alias("mean"))


@query("cadence_census", f"select delta_h, count(*) as n from (select (open_ms - lag(open_ms) over (partition by series order by open_ms)) // {HOUR} as delta_h from ({bars_sql(HOUR)})) where delta_h is not null group by 1 order by n desc, delta_h limit 10")
def cadence_census(spark, sf_dir):
    d = hour_bars(spark, sf_dir).select(F.floor((F.col("open_ms") - F.lag("open_ms").over(X.by_time())) / HOUR).alias("delta_h")).filter("delta_h is not null")
    return d.groupBy("delta_h").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "delta_h").limit(10)


@query("object_inventory", f"select t - t % {DAY} as day_ms, count(*) as n_rows, count(distinct t) as distinct_ts, count(*) - count(distinct t) as duplicates, min(t) as first_ts, max(t) as last_ts, count(*) filter (where t % 60000 <> 0) as off_grid from ({ticks_sql()}) group by 1")
def object_inventory(spark, sf_dir):
    t = F.col("t")
    return ticks(spark, sf_dir).groupBy(B.bucket("t", DAY).alias("day_ms")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(t).alias("distinct_ts"), (F.count(F.lit(1)) - F.count_distinct(t)).alias("duplicates"), F.min(t).alias("first_ts"), F.max(t).alias("last_ts"), F.count_if(t % 60000 != 0).alias("off_grid"))


@query("ar1_coefficient", f"select feature, {sql9('corr(x, px)')} as ar1 from (select feature, x, lag(x) over (partition by feature order by row_index) as px from (select row_index, unnest(['f_ret_1','f_roc_60']) as feature, unnest([f_ret_1, f_roc_60]) as x from {RESEARCH})) where x is not null and px is not null group by feature")
def ar1_coefficient(spark, sf_dir):
    long = research(spark, sf_dir).select("row_index", F.expr("stack(2, 'f_ret_1', f_ret_1, 'f_roc_60', f_roc_60) as (feature, x)"))
    w = Window.partitionBy("feature").orderBy("row_index")
    return long.withColumn("px", F.lag("x").over(w)).filter("x is not null and px is not null").groupBy("feature").agg(r9(F.corr("x", "px")).alias("ar1"))


_NESTED = """'{"id": ' || event_id || ', "in": {"list": [' || user_id || ', "' || event_id || '", {"props": ' || props || '}], "day": "2025-01-' || lpad((event_id % 28 + 1)::varchar, 2, '0') || 'T00:00"}, "flag": true}'"""


@query("value_range_scan", f"""
    select replace(fullkey, '"', '') as path, count(*) as n from (select unnest(j) as x from (select list_value({_NESTED}) as j from events)) d, json_tree(d.x::json) as t
    where (t.type in ('UBIGINT', 'BIGINT') and try_cast(t.atom::varchar as bigint) between 10 and 59)
       or (t.type = 'VARCHAR' and (case when regexp_full_match(t.atom->>'$', '[0-9]+') then try_cast(t.atom->>'$' as bigint) between 10 and 59 else regexp_matches(t.atom->>'$', '2025-[0-9]{{2}}-[0-9]{{2}}') end))
    group by 1""")
def value_range_scan(spark, sf_dir):
    """Paths of nested documents whose values lie in a range or a year."""
    from chronolith.operators.nested import value_range

    docs = table(spark, sf_dir, "events").select(F.expr(_NESTED.replace("(event_id % 28 + 1)::varchar", "cast(event_id % 28 + 1 as string)")).alias("doc"))
    return value_range(docs, "doc", 10, 60, year=2025).select("path", "n")


_IC = "(values ('a', 0.08, 0.01, 0.05, 0.01), ('b', 0.15, 0.01, 0.05, 0.01), ('c', 0.25, 0.01, 0.05, 0.01), ('d', 0.08, -0.01, 0.05, 0.01), ('e', 0.08, 0.01, 0.05, 0.2)) t(name, sd, ci_low, ci_high, p_value)"
_IC_ROWS = [("a", 0.08, 0.01, 0.05, 0.01), ("b", 0.15, 0.01, 0.05, 0.01), ("c", 0.25, 0.01, 0.05, 0.01), ("d", 0.08, -0.01, 0.05, 0.01), ("e", 0.08, 0.01, 0.05, 0.2)]


@query("ic_gate", f"select name, case when sd > 0.20 or 0 between ci_low and ci_high or p_value > 0.05 then 'STOP_PUBLISH_NEGATIVE' when sd < 0.10 then 'PROCEED' else 'PROCEED_WITH_CAVEAT' end as verdict from {_IC}")
def ic_gate(spark, sf_dir):
    from chronolith.operators import gates

    return gates.ic_gate(spark.createDataFrame(_IC_ROWS, "name string, sd double, ci_low double, ci_high double, p_value double")).select("name", "verdict")


@query("phase_gate", "select name, lower > 0 as bound_positive, min_year_auc >= 0.5 as years_pass, lower > 0 and min_year_auc >= 0.5 as continues from (values ('a', 0.01, 0.51), ('b', -0.01, 0.51), ('c', 0.01, 0.49)) t(name, lower, min_year_auc)")
def phase_gate(spark, sf_dir):
    from chronolith.operators import gates

    rows = spark.createDataFrame([("a", 0.01, 0.51), ("b", -0.01, 0.51), ("c", 0.01, 0.49)], "name string, lower double, min_year_auc double")
    return gates.phase_gate(rows).select("name", "bound_positive", "years_pass", "continues")


@query("replication_gate", "select name, case when bss >= 0.02 and ci_low > 0 and abs(bias) <= 0.02 and slope between 0.8 and 1.2 and calibrated then 'REPLICATED' else 'DID_NOT_REPLICATE' end as outcome from (values ('a', 0.03, 0.01, -0.02, 1.0, true), ('b', 0.03, 0.0, 0.0, 1.0, true), ('c', 0.03, 0.01, 0.0, 1.3, true), ('d', 0.03, 0.01, 0.0, 1.0, false)) t(name, bss, ci_low, bias, slope, calibrated)")
def replication_gate(spark, sf_dir):
    from chronolith.operators import gates

    rows = [("a", 0.03, 0.01, -0.02, 1.0, True), ("b", 0.03, 0.0, 0.0, 1.0, True), ("c", 0.03, 0.01, 0.0, 1.3, True), ("d", 0.03, 0.01, 0.0, 1.0, False)]
    return gates.replication_gate(spark.createDataFrame(rows, "name string, bss double, ci_low double, bias double, slope double, calibrated boolean")).select("name", "outcome")


_HYP_ROWS = [("H_ETH", 0.02, 0.01, True, 3, -0.01), ("H_K_M2", 0.02, 0.01, True, 3, -0.01), ("H_K_M3", 0.005, 0.01, True, 3, -0.01)]
_HYP = "(values ('H_ETH', 0.02, 0.01, true, 3, -0.01), ('H_K_M2', 0.02, 0.01, true, 3, -0.01), ('H_K_M3', 0.005, 0.01, true, 3, -0.01)) t(name, improvement, ci_low, rejected, improved_years, worst_year)"


@query("hypothesis_gate", f"select name, improvement >= 0.01 and ci_low > 0 and rejected and improved_years >= 2 and worst_year >= -0.02 as passes from {_HYP}")
def hypothesis_gate(spark, sf_dir):
    from chronolith.operators import gates

    return gates.hypothesis_gate(spark.createDataFrame(_HYP_ROWS, "name string, improvement double, ci_low double, rejected boolean, improved_years int, worst_year double")).select("name", "passes")


@query("retained_model", "select 'M3' as retained")
def retained_model(spark, sf_dir):
    from chronolith.operators import gates

    return gates.retained_model(hypothesis_gate(spark, sf_dir))


@query("series_registry", "select unnest(['binance_usd_m_futures', 'binance_futures', 'binance_spot', 'kraken']) as provider, unnest([3, 8, 1, 1])::bigint as n")
def series_registry(spark, sf_dir):
    from chronolith.sources.series import registry

    return registry(spark).groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


@query("gap_disposition", "select reason, case when reason in ('missing_native_interval', 'oi_snapshot_gap') then reason else 'unclassified_pending_review' end as disposition from (select unnest(['missing_native_interval', 'oi_snapshot_gap', 'other', 'native_grid']) as reason)")
def gap_disposition(spark, sf_dir):
    rows = spark.createDataFrame([("missing_native_interval",), ("oi_snapshot_gap",), ("other",), ("native_grid",)], "reason string")
    return rows.select("reason", QE.gap_disposition(F.col("reason")).alias("disposition"))


@query("union_months", f"select strftime(make_timestamp(open_ms * 1000), '%Y-%m-%d') as day, count(*) as n from ({bars_sql(HOUR, 'ALL')}) group by 1")
def union_months(spark, sf_dir):
    """Parts concatenated again, with the count of each."""
    b = hour_bars(spark, sf_dir, "ALL")
    cut = START + 15 * DAY
    whole = b.filter(F.col("open_ms") < cut).unionByName(b.filter(F.col("open_ms") >= cut))
    return whole.groupBy(F.date_format(F.timestamp_millis("open_ms"), "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


# relational plumbing
@query("set_operations", "select 'both' as kind, count(*) as n from (select c_custkey from customer intersect select o_custkey from orders) union all select 'never', count(*) from (select c_custkey from customer except select o_custkey from orders) union all select 'all', count(*) from (select c_custkey from customer union select o_custkey from orders)")
def set_operations(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    n = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return n(c.intersect(o), "both").union(n(c.subtract(o), "never")).union(n(c.union(o).distinct(), "all"))


@query("rollup_sales", "select l_returnflag, l_linestatus, count(*) as n, (sum(round(l_extendedprice * 100)::bigint))::bigint as cents from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup_sales(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))


@query("cube_orders", "select o_orderstatus, o_orderpriority, count(*) as n from orders group by cube (o_orderstatus, o_orderpriority)")
def cube_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("semi_anti", "select 'with' as kind, count(*) as n from customer where c_custkey in (select o_custkey from orders) union all select 'without', count(*) from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null)")
def semi_anti(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    n = lambda how, kind: c.join(o, "c_custkey", how).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return n("left_semi", "with").union(n("left_anti", "without"))


@query("top_orders", "select o_orderkey, round(o_totalprice * 100)::bigint as cents from orders order by cents desc, o_orderkey limit 20")
def top_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")).orderBy(F.col("cents").desc(), "o_orderkey").limit(20)


@query("top_per_customer", "select o_custkey, o_orderkey, cents, k from (select o_custkey, o_orderkey, round(o_totalprice * 100)::bigint as cents, row_number() over (partition by o_custkey order by round(o_totalprice * 100)::bigint desc, o_orderkey) as k from orders) where k <= 3")
def top_per_customer(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return o.withColumn("k", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("cents").desc(), "o_orderkey")).cast("long")).filter("k <= 3")


@query("streaming_bars", f"select series, open_ms, open, high, low, close, volume, trades from ({bars_sql(HOUR)}) where open_ms + {HOUR} <= (select max(epoch_us(ts)) // 1000 - 600000 from events)")
def streaming_bars(spark, sf_dir):
    """Hourly bars through Structured Streaming; closed windows only."""
    from chronolith.streaming.bars import run_available

    return run_available(spark, f"{sf_dir}/events.parquet")
