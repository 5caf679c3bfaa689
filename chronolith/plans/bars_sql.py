"""Registered queries on bars, order, gaps, filters and parsing, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.functions import parse
from chronolith.operators import bars as B
from chronolith.operators.quality import EXCLUSION_REASONS
from chronolith.sources.ticks import DAY, HOUR, table, ticks

#: 2024-01-01T00:00:00Z, where the events begin.
START = 1_704_067_200_000


def ticks_sql(series: str = "event_type") -> str:
    key = "'ALL'" if series == "ALL" else series
    return f"select event_id, (epoch_us(ts) // 1000) as t, {key} as series, round(value * 100)::bigint as cents, event_type = 'purchase' as buy from events"


def bars_sql(step: int, series: str = "event_type") -> str:
    return f"""select series, t - t % {step} as open_ms, arg_min(cents, row(t, event_id)) as open, max(cents) as high, min(cents) as low, arg_max(cents, row(t, event_id)) as close,
      sum(cents)::bigint as volume, count(*) as trades, sum(case when buy then cents else 0 end)::bigint as taker from ({ticks_sql(series)}) group by all"""


def hour_bars(spark: SparkSession, sf_dir: str, series: str = "event_type") -> DataFrame:
    return B.ticks_to_bars(ticks(spark, sf_dir, series), HOUR)


Q: dict = {}
S: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql is not None:
            S[name] = sql
        return f

    return put


@query("bars_1h", bars_sql(HOUR))
def bars_1h(spark, sf_dir):
    return hour_bars(spark, sf_dir)


@query("bars_1d", bars_sql(DAY))
def bars_1d(spark, sf_dir):
    return B.ticks_to_bars(ticks(spark, sf_dir), DAY)


@query("bars_1m", bars_sql(60_000, "ALL"))
def bars_1m(spark, sf_dir):
    return B.ticks_to_bars(ticks(spark, sf_dir, "ALL"), 60_000)


@query(
    "resample_1h_1d",
    f"""select series, open_ms - open_ms % {DAY} as open_ms, arg_min(open, open_ms) as open, max(high) as high, min(low) as low, arg_max(close, open_ms) as close,
    sum(volume)::bigint as volume, sum(trades)::bigint as trades, sum(taker)::bigint as taker, count(*) as members from ({bars_sql(HOUR)}) b group by series, b.open_ms - b.open_ms % {DAY}""",
)
def resample_1h_1d(spark, sf_dir):
    return B.resample(hour_bars(spark, sf_dir), DAY)


@query(
    "bars_completeness",
    f"""select series, d as bucket_ms, count(*) as members, min(open_ms) as first_ms, max(open_ms) as last_ms, count(*) = 24 and min(open_ms) = d and max(open_ms) = d + {DAY - HOUR} as complete
    from (select *, open_ms - open_ms % {DAY} as d from ({bars_sql(HOUR)})) group by series, d""",
)
def bars_completeness(spark, sf_dir):
    return B.completeness(hour_bars(spark, sf_dir), DAY, HOUR)


@query(
    "bucket_gaps",
    f"""with b as ({bars_sql(HOUR)}), g as (select series, unnest(generate_series(min(open_ms), max(open_ms), {HOUR})) as open_ms from b group by series)
    select series, open_ms from g anti join b using (series, open_ms)""",
)
def bucket_gaps(spark, sf_dir):
    return B.gaps(hour_bars(spark, sf_dir), HOUR)


@query(
    "order_findings",
    f"""with r as (select *, t <= lag(t) over (partition by series order by event_id) as back, t - lag(t) over (partition by series order by t, event_id) as apart from ({ticks_sql()}))
    select series, count(*) as n_rows, count(*) - count(distinct t) as duplicates, count(*) filter (where back) as not_ascending, count(*) filter (where apart <> {HOUR}) as not_adjacent from r group by series""",
)
def order_findings(spark, sf_dir):
    return B.order_findings(ticks(spark, sf_dir), "event_id", HOUR)


_CONTENT = ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


@query(
    "dup_conflict",
    f"""with d as (select l_orderkey, l_linenumber, sha256(concat_ws('|', {", ".join(f"{c}::varchar" for c in _CONTENT)})) as digest, l_partkey * 100000 + l_suppkey as pos from lineitem),
    c as (select l_orderkey, l_linenumber, digest, count(*) as n, min(pos) as at_ from d group by all)
    select l_orderkey, l_linenumber, sum(n)::bigint as copies, count(*) as variants, arg_min(digest, row(at_, digest)) as kept, count(*) > 1 as conflict from c group by l_orderkey, l_linenumber""",
)
def dup_conflict(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return B.dedup_conflicts(li, ["l_orderkey", "l_linenumber"], F.concat_ws("|", *[F.col(c).cast("string") for c in _CONTENT]), F.col("l_partkey") * 100000 + F.col("l_suppkey"))


@query("duplicate_count", "select count(*) as n_rows, count(distinct (l_orderkey, l_linenumber)) as n_keys, count(*) - count(distinct (l_orderkey, l_linenumber)) as surplus from lineitem")
def duplicate_count(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), (F.sum("n") - F.count(F.lit(1))).alias("surplus"))


@query("period_filter", f"select event_id, (epoch_us(ts) // 1000) as t, event_type as series from events where (epoch_us(ts) // 1000) >= {START + 5 * DAY} and (epoch_us(ts) // 1000) < {START + 8 * DAY}")
def period_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    lo, hi = (F.timestamp_millis(F.lit(START + d * DAY)).cast("timestamp_ntz") for d in (5, 8))
    # the bounds are compared with the stored column, so they reach the scan
    return e.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("t"), F.col("event_type").alias("series"))


@query(
    "buffer_truncate",
    f"""select count(*) filter (where t between {START + 10 * DAY} and {START + 20 * DAY}) as kept, count(*) filter (where t < {START + 10 * DAY}) as before_, count(*) filter (where t > {START + 20 * DAY}) as after_ from ({ticks_sql()})""",
)
def buffer_truncate(spark, sf_dir):
    t = F.col("t")
    lo, hi = START + 10 * DAY, START + 20 * DAY
    return ticks(spark, sf_dir).agg(F.count_if(t.between(lo, hi)).alias("kept"), F.count_if(t < lo).alias("before_"), F.count_if(t > hi).alias("after_"))


@query("buffer_origins", f"select series, open_ms as origin_ms from ({bars_sql(HOUR, 'ALL')}) where open_ms + {DAY} >= {START + 25 * DAY}")
def buffer_origins(spark, sf_dir):
    """Origins whose label closes at or after the buffer's start."""
    return hour_bars(spark, sf_dir, "ALL").filter(F.col("open_ms") + DAY >= START + 25 * DAY).select("series", F.col("open_ms").alias("origin_ms"))


@query("refit_eligible", f"select series, open_ms as origin_ms from ({bars_sql(HOUR, 'ALL')}) where open_ms >= {START} and open_ms + {DAY} <= {START + 20 * DAY} and (open_ms - {START}) % {6 * HOUR} = 0")
def refit_eligible(spark, sf_dir):
    """Origins in range, on the cadence, with labels closed by the refit."""
    o = F.col("open_ms")
    return hour_bars(spark, sf_dir, "ALL").filter((o >= START) & (o + DAY <= START + 20 * DAY) & ((o - START) % (6 * HOUR) == 0)).select("series", o.alias("origin_ms"))


def _texts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    s = i.cast("string")
    cents = F.format_string("%d.%02d", F.floor(F.round(F.col("value") * 100) / 100).cast("long"), F.pmod(F.round(F.col("value") * 100).cast("long"), F.lit(100)))
    sci = F.concat((i % 7).cast("string"), F.lit("E-"), (i % 9).cast("string"))
    return e.select("event_id", F.explode(F.array(cents, F.concat(F.lit("0"), cents), s, sci, F.concat(F.lit("-"), cents), F.concat(s, F.lit("."), F.repeat(F.lit("7"), (i % 24).cast("int"))))).alias("raw"))


_TEXTS_SQL = """select event_id, unnest([c, '0' || c, event_id::varchar, (event_id % 7)::varchar || 'E-' || (event_id % 9)::varchar, '-' || c, event_id::varchar || '.' || repeat('7', (event_id % 24)::int)]) as raw
  from (select event_id, (round(value * 100)::bigint // 100)::varchar || '.' || lpad((round(value * 100)::bigint % 100)::varchar, 2, '0') as c from events)"""
_REASON_SQL = r"""case when not regexp_full_match(raw, '(0|[1-9][0-9]*)(\.[0-9]+)?') then 'malformed'
  when length(rtrim(case when contains(raw, '.') then split_part(raw, '.', 2) else '' end, '0')) > 18 then 'fraction_overflow'
  when length(ltrim(split_part(raw, '.', 1), '0')) > 20 then 'integer_overflow'
  when length(ltrim(split_part(raw, '.', 1), '0')) + length(rtrim(case when contains(raw, '.') then split_part(raw, '.', 2) else '' end, '0')) > 38 then 'precision_overflow' end"""


@query("parse_numeric_policy", f"select coalesce(reason, 'accepted') as reason, count(*) as n from (select {_REASON_SQL} as reason from ({_TEXTS_SQL})) group by 1")
def parse_numeric_policy(spark, sf_dir):
    return _texts(spark, sf_dir).select(F.coalesce(parse.decimal_reason(F.col("raw")), F.lit("accepted")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("parse_exact_values", f"select event_id, raw, (case when ({_REASON_SQL}) is null then round(try_cast(raw as decimal(38,18))::double, 6) end) as value from ({_TEXTS_SQL})")
def parse_exact_values(spark, sf_dir):
    return _texts(spark, sf_dir).select("event_id", "raw", F.round(parse.exact_decimal(F.col("raw")).cast("double"), 6).alias("value"))


@query(
    "scientific_expansion",
    """select event_id, m || 'E-' || p as raw, case when p = 0 then m::varchar else '0.' || repeat('0', (p - 1)::int) || m end as plain from (select event_id, event_id % 7 as m, event_id % 9 as p from events)""",
)
def scientific_expansion(spark, sf_dir):
    raw = F.concat((F.col("event_id") % 7).cast("string"), F.lit("E-"), (F.col("event_id") % 9).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw"), parse.expand_scientific(raw).alias("plain"))


@query("parse_datetime", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as raw, (epoch_ms(date_trunc('second', ts)))::bigint as ms from events")
def parse_datetime(spark, sf_dir):
    raw = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw"), parse.datetime_ms(raw).alias("ms"))


@query("parse_epochs", "select event_id, (epoch_us(ts) // 1000000 * 1000)::bigint as from_seconds, (epoch_us(ts) // 1000) as from_millis, event_id as counted from events")
def parse_epochs(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", parse.fixed_epoch_ms(F.floor(ms / 1000).cast("string")).alias("from_seconds"), parse.fixed_epoch_ms(ms.cast("string")).alias("from_millis"), parse.int64(F.col("event_id").cast("string")).alias("counted"))


@query("signed_decimals", "select event_id, (-round(value * 100)::bigint) as cents from events")
def signed_decimals(spark, sf_dir):
    cents = F.round(F.col("value") * 100).cast("long")
    text = F.concat(F.lit("-"), cents.cast("string"))
    return table(spark, sf_dir, "events").select("event_id", parse.signed_decimal(text).cast("long").alias("cents"))


@query("canonical_projection", f"select 'events' as provider, 'ALL' as instrument_id, '1h' as interval, open_ms, open_ms + {HOUR - 1} as close_ms, open_ms + {HOUR} as available_ms, close from ({bars_sql(HOUR, 'ALL')})")
def canonical_projection(spark, sf_dir):
    o = F.col("open_ms")
    return hour_bars(spark, sf_dir, "ALL").select(F.lit("events").alias("provider"), F.col("series").alias("instrument_id"), F.lit("1h").alias("interval"), o.alias("open_ms"), (o + HOUR - 1).alias("close_ms"), (o + HOUR).alias("available_ms"), "close")


@query(
    "series_projection",
    f"select series, open_ms, case when series = 'purchase' then open_ms + 1 when series = 'signup' then open_ms + 300000 else open_ms + {HOUR} end as eligibility_ts, case when series = 'click' then null else trades end as trade_count from ({bars_sql(HOUR)})",
)
def series_projection(spark, sf_dir):
    """Eligibility by family, and no trade count for derived prices."""
    o = F.col("open_ms")
    when = F.when(F.col("series") == "purchase", o + 1).when(F.col("series") == "signup", o + 300_000).otherwise(o + HOUR)
    return hour_bars(spark, sf_dir).select("series", "open_ms", when.alias("eligibility_ts"), F.when(F.col("series") != "click", F.col("trades")).alias("trade_count"))


@query("phase_quarter", f"select open_ms, (i % 24)::bigint as phase, '2024-Q' || (least(i // 180, 3) + 1)::varchar as quarter from (select open_ms, row_number() over (order by open_ms) - 1 as i from ({bars_sql(HOUR, 'ALL')}))")
def phase_quarter(spark, sf_dir):
    from chronolith.operators.features import with_index

    i = F.col("row_index")
    return with_index(hour_bars(spark, sf_dir, "ALL")).select("open_ms", F.pmod(i, F.lit(24)).cast("long").alias("phase"), F.concat(F.lit("2024-Q"), (F.least(F.floor(i / 180), F.lit(3)) + 1).cast("string")).alias("quarter"))


@query("frequency_census", "select event_type, count(*) as n, count(distinct user_id) as users from events group by 1")
def frequency_census(spark, sf_dir):
    per_user = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("event_type").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))


_RUN = f"""with b as ({bars_sql(HOUR)}), g as (select series, unnest(generate_series(min(open_ms), max(open_ms), {HOUR})) as open_ms from b group by series),
  f as (select g.series, g.open_ms, b.open_ms is null as missing from g left join b on b.series = g.series and b.open_ms = g.open_ms),
  i as (select *, sum(case when missing then 0 else 1 end) over (partition by series order by open_ms) as island from f)"""


@query("longest_missing_run", f"{_RUN} select s.series, coalesce(max(n), 0)::bigint as longest from (select distinct series from f) s left join (select series, island, count(*) as n from i where missing group by all) r on r.series = s.series group by s.series")
def longest_missing_run(spark, sf_dir):
    b = hour_bars(spark, sf_dir)
    missing = B.gaps(b, HOUR).withColumn("missing", F.lit(True))
    flags = b.select("series", "open_ms").withColumn("missing", F.lit(False)).unionByName(missing)
    return B.longest_run(flags, ["series"], "open_ms", "missing")


_GRID = f"""select (2020 + (h // 240))::int as year, (h % 240)::bigint as hour_idx, h % 7 <> 0 and h % 11 <> 3 as eligible,
  case when h % 7 = 0 then '{EXCLUSION_REASONS[0]}' when h % 11 = 3 then '{EXCLUSION_REASONS[1]}' end as reason from (select (open_ms - {START}) // {HOUR} as h from ({bars_sql(HOUR, 'ALL')}))"""
_COUNTS = ", ".join(f"count(*) filter (where reason = '{r}') as n_{r}" for r in EXCLUSION_REASONS)


@query(
    "coverage_report",
    f"""with g as ({_GRID}), i as (select *, sum(case when eligible then 1 else 0 end) over (partition by year order by hour_idx) as island from g),
    r as (select year, max(n) as longest from (select year, island, count(*) as n from i where not eligible group by all) group by year),
    y as (select g.year, count(*) as positions, count(*) filter (where eligible) as n_eligible, {_COUNTS}, coalesce(max(r.longest), 0)::bigint as longest from g left join r on r.year = g.year group by g.year),
    a as (select * from y union all select null, {", ".join(f"sum({c})::bigint" for c in ["positions", "n_eligible", *[f"n_{r}" for r in EXCLUSION_REASONS]])}, max(longest) from y)
    select *, round(100.0::double * n_eligible / positions, 6) as share from a""",
)
def coverage_report(spark, sf_dir):
    h = F.floor((F.col("open_ms") - START) / HOUR)
    grid = hour_bars(spark, sf_dir, "ALL").select(h.alias("h")).select(
        (F.lit(2020) + F.floor(F.col("h") / 240)).cast("int").alias("year"), (F.col("h") % 240).alias("hour_idx"), ((F.col("h") % 7 != 0) & (F.col("h") % 11 != 3)).alias("eligible"),
        F.when(F.col("h") % 7 == 0, EXCLUSION_REASONS[0]).when(F.col("h") % 11 == 3, EXCLUSION_REASONS[1]).alias("reason"),
    )
    return B.coverage(grid, EXCLUSION_REASONS)


@query("inventory_months", "select strftime(d, '%Y-%m') as period, epoch_ms(d)::bigint as start_ms, epoch_ms(d + interval 1 month)::bigint as end_ms from (select unnest(generate_series(timestamp '2020-01-01', timestamp '2024-12-01', interval 1 month)) as d)")
def inventory_months(spark, sf_dir):
    from chronolith.sources.archives import inventory

    return inventory(spark, "2020-01-01", "2024-12-31", "month")


@query("inventory_days", "select strftime(d, '%Y-%m-%d') as period, epoch_ms(d)::bigint as start_ms, epoch_ms(d + interval 1 day)::bigint as end_ms from (select unnest(generate_series(timestamp '2020-09-01', timestamp '2024-12-31', interval 1 day)) as d)")
def inventory_days(spark, sf_dir):
    from chronolith.sources.archives import inventory

    return inventory(spark, "2020-09-01", "2024-12-31", "day")


@query("nominal_grid", "select y as year, count(*) as hours, min(epoch_ms(h))::bigint as first_ms, max(epoch_ms(h))::bigint as last_ms from (select y, unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0), make_timestamp(y + 1, 1, 1, 0, 0, 0) - interval 1 hour, interval 1 hour)) as h from (select unnest([2022, 2023, 2024, 2025]) as y)) group by y")
def nominal_grid(spark, sf_dir):
    from chronolith.sources.archives import hourly_grid

    return hourly_grid(spark, (2022, 2023, 2024, 2025)).groupBy("year").agg(F.count(F.lit(1)).alias("hours"), F.min("t").alias("first_ms"), F.max("t").alias("last_ms"))
