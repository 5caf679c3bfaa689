"""Registered queries on scans, training records, subqueries and outcomes, with
their SQL. Faults are planted by a row's number, and SQL finds them by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolith.operators import diagnostics as D
from chronolith.operators import evaluate as V
from chronolith.operators import joins as J
from chronolith.operators import quality as QE
from chronolith.plans.bars_sql import bars_sql, hour_bars
from chronolith.plans.research_sql import tested
from chronolith.sources import series
from chronolith.sources.ticks import HOUR, table

Q: dict = {}
S: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql is not None:
            S[name] = sql
        return f

    return put


_T = "(1577836800 + (event_id % 40000) * 3600)"
#: Lines of seven columns, one in eleven whole and ten with a fault each.
LINE = f"""case event_id % 11
  when 0 then {_T} || ',10.5,12,9,11,1.5,7' when 1 then '"' || {_T} || '",10.5,12,9,11,1.5,7' when 2 then {_T} || ',10.5,12,9,11,1.5'
  when 3 then '12a4567890,10.5,12,9,11,1.5,7' when 4 then (1735689600 + event_id * 3600) || ',10.5,12,9,11,1.5,7' when 5 then ({_T} + 60) || ',10.5,12,9,11,1.5,7'
  when 6 then {_T} || ',010,12,9,11,1.5,7' when 7 then {_T} || ',10,10.5,9,11,1.5,7' when 8 then {_T} || ',10.5,12,9,11,1.5,x'
  when 9 then '-' || {_T} || ',10.5,12,9,11,1.5,7' else {_T} || ',10.5,12,9,11,1.0000000000000000001,7' end"""


@query("series_scan_reasons", f"""
    with f as (select string_split({LINE}, ',') as p, {LINE} as line from events),
    d as (select *, try_cast(p[1] as bigint) as t, len(list_filter(p[2:6], lambda x: not regexp_full_match(x, '(0|[1-9][0-9]*)(\\.[0-9]{{1,18}}0*)?'))) as bad from f)
    select case when contains(line, '"') then 'quoting_not_permitted' when len(p) <> 7 then 'field_count' when not regexp_full_match(p[1], '[0-9]{{10}}') then 'timestamp_malformed'
      when t < 1577836800 or t >= 1735689600 then 'outside_period' when t % 3600 <> 0 then 'off_grid' when bad > 0 then 'decimal_policy'
      when p[4]::double > least(p[2]::double, p[5]::double) or p[3]::double < greatest(p[2]::double, p[5]::double) then 'bar_bounds' when not regexp_full_match(p[7], '[0-9]{{1,19}}') then 'count' else 'none' end as reason, count(*) as n
    from d group by 1""")
def series_scan_reasons(spark, sf_dir):
    """Why lines of hourly bars break the policy; no line is dropped."""
    lines = table(spark, sf_dir, "events").select(F.lit("f").alias("source_file"), F.lit("0" * 64).alias("source_sha256"), F.col("event_id").cast("long").alias("line_no"), F.expr(LINE).alias("line"))
    return series.bar_rows(lines, series.REGISTRY[6]).groupBy(F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("nearest_oi_open", f"select open_ms, open_ms - 300000 as oi_open from ({bars_sql(HOUR, 'ALL')})")
def nearest_oi_open(spark, sf_dir):
    return hour_bars(spark, sf_dir, "ALL").select("open_ms", J.latest_oi_open(F.col("open_ms")).alias("oi_open"))


@query("terminal_states", "select o_orderstatus as state, count(*) as n from orders group by 1")
def terminal_states(spark, sf_dir):
    """How often each terminal state of a run's outcomes stands; an order's
    status stands for an outcome."""
    from chronolith.orchestrate import terminal_states as states

    return states(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("state")))


_RECORDS = """select case when id % 50 >= 25 then 'b' else 'a' end as series, id % 25 as fold_id, case when id = 30 then 150 else 300 + id end as n_train, case when id = 31 then 0 else 72 end as n_test,
  case when id = 32 then 1.5 when id = 33 then null else 0.5 end as directional_accuracy, case when id = 34 then null else 0.4 end as majority_accuracy, case when id = 35 then -2.0 else 0.1 end as return_ic, id <> 36 as deterministic from {ids}"""


@query("quality_training", f"""
    with r as ({_RECORDS.format(ids="(select unnest(range(49)) as id)")})
    select series, unnest(['training_record_matrix', 'training_train_rows', 'training_metric_bounds', 'training_baseline_presence', 'training_determinism', 'training_test_rows']) as check_id,
      unnest([abs(count(*) - 25) + count(*) - count(distinct fold_id), count(*) filter (where n_train < 200),
        count(*) filter (where directional_accuracy is null or directional_accuracy > 1 or return_ic < -1), count(*) filter (where majority_accuracy is null), count(*) filter (where not deterministic), count(*) filter (where n_test = 0)])::bigint as n
    from r group by series""")
def quality_training(spark, sf_dir):
    """Every check of the training suite, passing for one series, failing for
    the other."""
    records = spark.sql(_RECORDS.format(ids="range(49)"))
    found = QE.training_findings(records, 25)
    return found.select("series", "check_id", F.col("violations").cast("long").alias("n"))


_SUBQUERIES = """
    with totals as (select o_custkey, sum(o_totalprice) as spent, count(*) as n from orders group by o_custkey),
    rich as (select * from totals where spent > (select avg(spent) from totals))
    select c.c_nationkey as nation, count(*) as customers, sum(r.n) as orders
    from customer c join rich r on r.o_custkey = c.c_custkey
    where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'O')
      and c.c_nationkey in (select n_nationkey from nation where n_regionkey < 3)
      and c.c_custkey not in (select o_custkey from orders where o_totalprice > 400000 and o_custkey is not null)
    group by c.c_nationkey"""


@query("subqueries", f"select nation, customers, orders::bigint as orders from ({_SUBQUERIES})")
def subqueries(spark, sf_dir):
    """Common table expressions, and scalar, EXISTS, IN and NOT IN subqueries."""
    names = ("orders", "customer", "nation")
    return spark.sql(_SUBQUERIES.replace("from orders", "from {orders}").replace("from customer", "from {customer}").replace("from nation", "from {nation}"), **{n: table(spark, sf_dir, n) for n in names})


@query("block_sign_flips")
def block_sign_flips(spark, sf_dir):
    """Sign-flip nulls of fold correlations, by runs of 1, 2, 4 and 8 folds."""
    ics = V.ic_records(tested(spark, sf_dir)).filter("feature = 'f_roc_60'").select("fold_id", F.col("pearson_ic").alias("ic"))
    return D.block_sign_flips(ics)
