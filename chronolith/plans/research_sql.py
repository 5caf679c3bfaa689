"""Registered queries on features, folds, coefficients, models and diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolith.operators import diagnostics as D
from chronolith.operators import evaluate as V
from chronolith.operators import features as X
from chronolith.operators import folds as W
from chronolith.operators import models as M
from chronolith.plans.bars_sql import START, bars_sql, hour_bars
from chronolith.sources.ticks import DAY, HOUR, table

Q: dict = {}
S: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql is not None:
            S[name] = sql
        return f

    return put


def r9(c, places: int = 9):
    """Rounded for comparison between engines; adding 0 removes a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), places) + F.lit(0.0)


def sql9(c: str, places: int = 9) -> str:
    return f"(round(({c})::double, {places}) + 0.0)"


RESEARCH = f"""(select series, open_ms, i as row_index, n, close, volume, ret as f_ret_1, close / nullif(c60, 0) - 1 as f_roc_60,
    case when rn = 20 then rv end as f_rvol_20, case when vn = 20 then volume / nullif(va, 0) end as f_volratio_20, c24 / nullif(close, 0) - 1 as l_fwdret_24, sign(c24 - close)::int as l_fwddir_24
  from (select *, count(ret) over f as rn, stddev_samp(ret) over f as rv, count(volume) over f as vn, avg(volume) over f as va
    from (select *, close / nullif(lag(close) over w, 0) - 1 as ret, lag(close, 60) over w as c60, lead(close, 24) over w as c24, row_number() over w - 1 as i, count(*) over (partition by series) as n
      from (select series, open_ms, close::double as close, volume::double as volume from ({bars_sql(HOUR, 'ALL')})) window w as (partition by series order by open_ms))
    window f as (partition by series order by open_ms rows between 19 preceding and current row)))"""


def research(spark, sf_dir):
    return X.research_table(hour_bars(spark, sf_dir, "ALL"))


def counted(spark, sf_dir):
    return hour_bars(spark, sf_dir, "ALL").groupBy("series").agg(F.count(F.lit(1)).alias("n"))


def with_n(rows):
    """Rows of series with their count; the counts are one row a series."""
    from pyspark.sql import Window

    return rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("series")))


for _name, _column in (("ret_1", "f_ret_1"), ("roc_60", "f_roc_60"), ("rvol_20", "f_rvol_20"), ("volratio_20", "f_volratio_20"), ("fwdret_24", "l_fwdret_24")):
    S[_name] = f"select series, open_ms, {sql9(_column)} as {_column} from {RESEARCH}"
    Q[_name] = lambda spark, sf_dir, c=_column: research(spark, sf_dir).select("series", "open_ms", r9(c).alias(c))


@query("fwddir_24", f"select series, open_ms, l_fwddir_24 from {RESEARCH}")
def fwddir_24(spark, sf_dir):
    return research(spark, sf_dir).select("series", "open_ms", "l_fwddir_24")


_ALL = ("f_ret_1", "f_roc_60", "f_rvol_20", "f_volratio_20", "l_fwdret_24")


@query("research_table", f"select series, row_index, open_ms, {', '.join(f'{sql9(c)} as {c}' for c in _ALL)}, l_fwddir_24 from {RESEARCH}")
def research_table(spark, sf_dir):
    return research(spark, sf_dir).select("series", "row_index", "open_ms", *[r9(c).alias(c) for c in _ALL], "l_fwddir_24")


@query("research_table_exact", f"select series, row_index, open_ms, {', '.join(f'{sql9(c)} as {c}' for c in _ALL)}, l_fwddir_24 from {RESEARCH}")
def research_table_exact(spark, sf_dir):
    """50-digit values, published at 9 places for comparison."""
    return X.research_table_exact(hour_bars(spark, sf_dir, "ALL")).select("series", "row_index", "open_ms", *[r9(c).alias(c) for c in _ALL], F.col("l_fwddir_24").cast("int").alias("l_fwddir_24"))


@query("research_table_halo", f"select series, row_index, {', '.join(f'{sql9(c)} as {c}' for c in ('f_roc_60', 'f_rvol_20', 'l_fwdret_24'))} from {RESEARCH}")
def research_table_halo(spark, sf_dir):
    """The same windows over chunks of a long series with their halo rows."""
    keys = ("series", "chunk")
    cut = X.with_halo(X.with_index(hour_bars(spark, sf_dir, "ALL")), chunk=200)
    w = X.by_time(keys)
    rows = cut.withColumn("ret", X.ret_1(w))
    out = rows.select("series", "row_index", "halo", X.roc_60(w).alias("f_roc_60"), X.rvol_20(w).alias("f_rvol_20"), X.fwdret_24(w).alias("l_fwdret_24"))
    return out.filter(~F.col("halo")).select("series", "row_index", *[r9(c).alias(c) for c in ("f_roc_60", "f_rvol_20", "l_fwdret_24")])


_COLS = (*_ALL, "l_fwddir_24")


@query("null_budgets", f"select series, count(*) as n, {', '.join(f'count(*) filter (where {c} is null) as {c}' for c in _COLS)} from {RESEARCH} group by series")
def null_budgets(spark, sf_dir):
    return research(spark, sf_dir).groupBy("series").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in _COLS])


@query("row_index", f"select series, open_ms, row_number() over (partition by series order by open_ms) - 1 as row_index from ({bars_sql(HOUR)})")
def row_index(spark, sf_dir):
    return X.with_index(hour_bars(spark, sf_dir)).select("series", "open_ms", "row_index")


@query("year_feature_distribution", f"select feature, count(x) as n, {sql9('avg(x)')} as mean, {sql9('stddev_samp(x)')} as sd, {sql9('quantile_cont(x, 0.01)')} as p01, {sql9('quantile_cont(x, 0.99)')} as p99, {sql9('min(x)')} as low, {sql9('max(x)')} as high from (select unnest(['f_ret_1','f_roc_60','f_rvol_20','f_volratio_20']) as feature, unnest([f_ret_1, f_roc_60, f_rvol_20, f_volratio_20]) as x from {RESEARCH}) group by feature")
def year_feature_distribution(spark, sf_dir):
    long = research(spark, sf_dir).select(F.expr("stack(4, 'f_ret_1', f_ret_1, 'f_roc_60', f_roc_60, 'f_rvol_20', f_rvol_20, 'f_volratio_20', f_volratio_20) as (feature, x)"))
    return long.groupBy("feature").agg(F.count("x").alias("n"), r9(F.avg("x")).alias("mean"), r9(F.stddev_samp("x")).alias("sd"), r9(F.percentile("x", 0.01)).alias("p01"), r9(F.percentile("x", 0.99)).alias("p99"), r9(F.min("x")).alias("low"), r9(F.max("x")).alias("high"))


FOLDS = f"""(select series, n, many, k::int as fold_id, 0::bigint as train_start, (336 + 72 * k)::bigint as train_end, (336 + 72 * k)::bigint as embargo_start, (360 + 72 * k)::bigint as embargo_end, (360 + 72 * k)::bigint as test_start,
    (case when k = many - 1 then n else 432 + 72 * k end)::bigint as test_end
  from (select series, n, (n - 360) // 72 as many, unnest(range(0, (n - 360) // 72)) as k from (select series, count(*) as n from ({bars_sql(HOUR, 'ALL')}) group by series)))"""
_FOLD_COLS = "series, fold_id, train_start, train_end, embargo_start, embargo_end, test_start, test_end"


@query("folds", f"select {_FOLD_COLS} from {FOLDS}")
def folds(spark, sf_dir):
    return W.folds(counted(spark, sf_dir)).drop("n")


TESTED = f"(select *, least((row_index - 360) // 72, (n - 360) // 72 - 1)::int as fold_id from {RESEARCH} where row_index >= 360)"


def tested(spark, sf_dir):
    return with_n(research(spark, sf_dir)).withColumn("fold_id", W.fold_of(F.col("row_index"), F.col("n"))).filter("fold_id is not null")


@query("fold_rows", f"select series, fold_id, row_index, open_ms from {TESTED}")
def fold_rows(spark, sf_dir):
    return tested(spark, sf_dir).select("series", "fold_id", "row_index", "open_ms")


@query("fold_train_counts", f"select f.series, f.fold_id, count(*) as n_train, max(r.open_ms) as last_ms from {FOLDS} f join {RESEARCH} r on r.series = f.series and r.row_index < f.train_end group by f.series, f.fold_id")
def fold_train_counts(spark, sf_dir):
    return W.train_totals(with_n(research(spark, sf_dir)), {"n_train": F.count(F.lit(1))}, {"last_ms": F.max("open_ms")})


@query(
    "fold_stats",
    f"""select series, fold_id, count(*) as n_rows, min(open_ms) as first_ms, max(open_ms) as last_ms, {', '.join(f'count(*) filter (where {c} is null) as null_{c}' for c in _COLS)},
    count(*) filter (where l_fwddir_24 = -1) as down, count(*) filter (where l_fwddir_24 = 0) as flat, count(*) filter (where l_fwddir_24 = 1) as up, {sql9('min(f_ret_1)')} as min_ret, {sql9('max(f_ret_1)')} as max_ret, {sql9('avg(f_ret_1)')} as mean_ret from {TESTED} group by series, fold_id""",
)
def fold_stats(spark, sf_dir):
    s = W.fold_stats(with_n(research(spark, sf_dir)), F.col("n"))
    return s.select(*[r9(c).alias(c) if c.endswith("_ret") else c for c in s.columns])


@query("fold_leakage", f"select series, fold_id, train_end <= embargo_start as train_before_embargo, embargo_end <= test_start as embargo_before_test, train_end + 23 < test_start as label_inside_embargo, test_start < test_end as test_not_empty, train_end <= embargo_start and embargo_end <= test_start and train_end + 23 < test_start and test_start < test_end as holds from {FOLDS}")
def fold_leakage(spark, sf_dir):
    return W.leakage(W.folds(counted(spark, sf_dir)))


def _overlap(lo: str, hi: str) -> str:
    return f"greatest(0, least(test_end, {hi}) - greatest(test_start, {lo}))::bigint"


@query("expected_nulls", f"select series, fold_id, {_overlap('0', '1')} as f_ret_1, {_overlap('0', '60')} as f_roc_60, {_overlap('0', '20')} as f_rvol_20, {_overlap('0', '19')} as f_volratio_20, {_overlap('n - 24', 'n')} as l_fwdret_24, {_overlap('n - 24', 'n')} as l_fwddir_24 from {FOLDS}")
def expected_nulls(spark, sf_dir):
    return W.expected_nulls(W.folds(counted(spark, sf_dir)))


@query("year_folds", f"select open_ms as t, test_year::int as test_year, case when open_ms >= a and open_ms < b then 'test' else 'train' end as side from (select open_ms, y as test_year, epoch_ms(make_timestamp(y, 1, 1, 0, 0, 0))::bigint as a, epoch_ms(make_timestamp(y + 1, 1, 1, 0, 0, 0))::bigint as b from (select open_ms, unnest([2024, 2025]) as y from ({bars_sql(HOUR, 'ALL')}))) where (open_ms >= a and open_ms < b) or (open_ms >= {START} and open_ms + {DAY} <= a)")
def year_folds(spark, sf_dir):
    return W.year_folds(hour_bars(spark, sf_dir, "ALL").select(F.col("open_ms").alias("t")), (2024, 2025), START)


@query("average_rank", "select doc_id, lang, (rank() over (partition by lang order by n_chars) + (count(*) over (partition by lang, n_chars) - 1) / 2.0)::double as r from documents")
def average_rank(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", X.average_rank("n_chars", "lang").alias("r"))


LONG = f"(select series, fold_id, l_fwdret_24 as y, unnest(['f_ret_1','f_roc_60','f_rvol_20','f_volratio_20']) as feature, unnest([f_ret_1, f_roc_60, f_rvol_20, f_volratio_20]) as x from {TESTED})"
_K = "partition by series, fold_id, feature"
RECORDS = f"""(select c.series, c.fold_id, c.feature, n_rows, x_nulls, y_nulls, coalesce(n_pairs, 0) as n_pairs, pearson_ic, spearman_ic from
  (select series, fold_id, feature, count(*) as n_rows, count(*) filter (where x is null) as x_nulls, count(*) filter (where y is null) as y_nulls from {LONG} group by all) c
  left join (select series, fold_id, feature, count(*) as n_pairs, corr(x, y) as pearson_ic, corr(rx, ry) as spearman_ic from
    (select *, rank() over ({_K} order by x) + (count(*) over ({_K}, x) - 1) / 2.0 as rx, rank() over ({_K} order by y) + (count(*) over ({_K}, y) - 1) / 2.0 as ry from {LONG} where x is not null and y is not null) group by all) m
  on c.series = m.series and c.fold_id = m.fold_id and c.feature = m.feature)"""


@query("ic_records", f"select series, fold_id, feature, n_rows, x_nulls, y_nulls, n_pairs, {sql9('pearson_ic')} as pearson_ic, {sql9('spearman_ic')} as spearman_ic from {RECORDS}")
def ic_records(spark, sf_dir):
    return V.ic_records(tested(spark, sf_dir)).select("series", "fold_id", "feature", "n_rows", "x_nulls", "y_nulls", "n_pairs", r9("pearson_ic").alias("pearson_ic"), r9("spearman_ic").alias("spearman_ic"))


def exact_tested(spark, sf_dir):
    return with_n(X.research_table_exact(hour_bars(spark, sf_dir, "ALL"))).withColumn("fold_id", W.fold_of(F.col("row_index"), F.col("n"))).filter("fold_id is not null")


@query("ic_records_exact", f"select series, fold_id, feature, n_rows, x_nulls, y_nulls, n_pairs, {sql9('pearson_ic')} as pearson_ic, {sql9('spearman_ic')} as spearman_ic from {RECORDS}")
def ic_records_exact(spark, sf_dir):
    return V.ic_records_exact(exact_tested(spark, sf_dir)).select("series", "fold_id", "feature", "n_rows", "x_nulls", "y_nulls", "n_pairs", r9("pearson_ic").alias("pearson_ic"), r9("spearman_ic").alias("spearman_ic"))


@query("ic_summary", f"select series, feature, count(pearson_ic) as n_folds, {sql9('min(pearson_ic)')} as lowest, {sql9('max(pearson_ic)')} as highest, count(*) filter (where pearson_ic < 0) as negative, count(*) filter (where pearson_ic = 0) as zero, count(*) filter (where pearson_ic > 0) as positive, {sql9('median(pearson_ic)')} as median, {sql9('avg(pearson_ic)')} as mean from {RECORDS} group by series, feature")
def ic_summary(spark, sf_dir):
    s = V.summarise(V.ic_records(tested(spark, sf_dir)), "pearson_ic")
    return s.select(*[r9(c).alias(c) if c in ("lowest", "highest", "median", "mean") else c for c in s.columns])


@query("ic_stability", f"select feature, count(*) as n, {sql9('avg(ic)')} as mean, {sql9('median(ic)')} as median, {sql9('stddev_samp(ic)')} as sd, {sql9('quantile_cont(ic, 0.25)')} as p25, {sql9('quantile_cont(ic, 0.75)')} as p75, count(*) filter (where ic > 0) as above_0, count(*) filter (where ic > 0.1) as above_01 from (select feature, spearman_ic as ic from {RECORDS}) group by feature")
def ic_stability(spark, sf_dir):
    ic = F.col("spearman_ic")
    return V.ic_records(tested(spark, sf_dir)).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), r9(F.avg(ic)).alias("mean"), r9(F.median(ic)).alias("median"), r9(F.stddev_samp(ic)).alias("sd"), r9(F.percentile(ic, 0.25)).alias("p25"), r9(F.percentile(ic, 0.75)).alias("p75"), F.count_if(ic > 0).alias("above_0"), F.count_if(ic > 0.1).alias("above_01"))


@query("best_folds", f"select feature, fold_id, {sql9('pearson_ic')} as ic from {RECORDS} order by pearson_ic desc nulls last, feature, fold_id limit 10")
def best_folds(spark, sf_dir):
    return V.ic_records(tested(spark, sf_dir)).orderBy(F.col("pearson_ic").desc_nulls_last(), "feature", "fold_id").limit(10).select("feature", "fold_id", r9("pearson_ic").alias("ic"))


_TRAIN = f"(select f.series, f.fold_id, r.* exclude (series, n) from {FOLDS} f join {RESEARCH} r on r.series = f.series and r.row_index < f.train_end)"


@query("zscore_train", f"select series, fold_id, count(f_ret_1) as n, {sql9('avg(f_ret_1)')} as mean, {sql9('stddev_pop(f_ret_1)')} as sd from {_TRAIN} group by series, fold_id")
def zscore_train(spark, sf_dir):
    x = F.col("f_ret_1")
    t = W.train_totals(with_n(research(spark, sf_dir)), {"n": F.count(x), "s": F.sum(x), "ss": F.sum(x * x)})
    mean = F.col("s") / F.col("n")
    return t.select("series", "fold_id", "n", r9(mean).alias("mean"), r9(F.sqrt(F.greatest(F.lit(0.0), F.col("ss") / F.col("n") - mean * mean))).alias("sd"))


@query("ridge_one_feature", f"select series, fold_id, n, {sql9('mx', 7)} as mean_x, {sql9('my', 7)} as mean_y, {sql9('sd', 7)} as sd_x, {sql9('(sxy - n * mx * my) / sd / (n + 1)', 7)} as weight from (select series, fold_id, count(*)::double as n, avg(f_roc_60) as mx, avg(l_fwdret_24) as my, stddev_pop(f_roc_60) as sd, sum(f_roc_60 * l_fwdret_24) as sxy from {_TRAIN} where f_roc_60 is not null and l_fwdret_24 is not null group by series, fold_id)")
def ridge_one_feature(spark, sf_dir):
    """From running block statistics, not from every fold's rows."""
    fits = M.ridge_one_feature(M.ridge_blocks(research(spark, sf_dir), "f_roc_60", "l_fwdret_24")).join(W.folds(counted(spark, sf_dir)).select("series", "fold_id"), ["series", "fold_id"])
    return fits.select("series", "fold_id", "n", *[r9(c, 7).alias(c) for c in ("mean_x", "mean_y", "sd_x", "weight")])


@query("majority_baseline", f"select t.series, t.fold_id, case when up >= down then 1 else -1 end::int as majority, {sql9('avg(case when l_fwddir_24 = case when up >= down then 1 else -1 end then 1.0 else 0.0 end)')} as accuracy from {TESTED} t join (select series, fold_id, count(*) filter (where l_fwddir_24 = 1) as up, count(*) filter (where l_fwddir_24 = -1) as down from {_TRAIN} group by all) b on b.series = t.series and b.fold_id = t.fold_id where l_fwddir_24 is not null group by t.series, t.fold_id, up, down")
def majority_baseline(spark, sf_dir):
    r = with_n(research(spark, sf_dir))
    signs = W.train_totals(r, {"up": F.count_if(F.col("l_fwddir_24") == 1), "down": F.count_if(F.col("l_fwddir_24") == -1)})
    base = signs.select("series", "fold_id", F.when(F.col("up") >= F.col("down"), 1).otherwise(-1).cast("int").alias("majority"))
    t = tested(spark, sf_dir).filter("l_fwddir_24 is not null").join(base, ["series", "fold_id"])
    return t.groupBy("series", "fold_id", "majority").agg(r9(F.avg((F.col("l_fwddir_24") == F.col("majority")).cast("double"))).alias("accuracy"))


@query("sign_baseline", f"select series, fold_id, count(*) as n, {sql9('avg(case when sign(f_ret_1) = l_fwddir_24 then 1.0 else 0.0 end)')} as directional_accuracy, {sql9('avg((f_ret_1 - l_fwdret_24) * (f_ret_1 - l_fwdret_24))', 6)} as mse from {TESTED} where l_fwddir_24 is not null group by series, fold_id")
def sign_baseline(spark, sf_dir):
    d = F.col("f_ret_1") - F.col("l_fwdret_24")
    return tested(spark, sf_dir).filter("l_fwddir_24 is not null").groupBy("series", "fold_id").agg(F.count(F.lit(1)).alias("n"), r9(F.avg((F.signum("f_ret_1") == F.col("l_fwddir_24")).cast("double"))).alias("directional_accuracy"), r9(F.avg(d * d), 6).alias("mse"))


@query("climatology", f"select series, fold_id, count(*) filter (where l_fwddir_24 = 1) as up, count(*) filter (where l_fwddir_24 = -1) as down, {sql9('count(*) filter (where l_fwddir_24 = 1) / (count(*) filter (where l_fwddir_24 <> 0))::double')} as p from {_TRAIN} group by series, fold_id")
def climatology(spark, sf_dir):
    t = W.train_totals(with_n(research(spark, sf_dir)), {"up": F.count_if(F.col("l_fwddir_24") == 1), "down": F.count_if(F.col("l_fwddir_24") == -1)})
    return t.select("series", "fold_id", "up", "down", r9(F.col("up") / (F.col("up") + F.col("down"))).alias("p"))


_SCORED = "(select d.doc_id, d.lang, d.source, d.n_chars::double as score, l.quality as label, least(greatest(d.n_chars / 5000.0, 0.000000000001), 0.999999999999)::double as p from documents d join labels l on l.doc_id = d.doc_id)"


def scored(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("score"))
    p = F.least(F.greatest(F.col("score") / 5000.0, F.lit(0.000000000001)), F.lit(0.999999999999))
    return d.join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id").withColumn("p", p)


@query("brier_log_loss", f"select lang, count(*) as n, {sql9('avg((p - label) * (p - label))', 7)} as brier, {sql9('-avg(case when label = 1 then ln(p) else ln(1 - p) end)', 6)} as log_loss from {_SCORED} group by lang")
def brier_log_loss(spark, sf_dir):
    p, y = F.col("p"), F.col("label")
    return scored(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), r9(F.avg((p - y) * (p - y)), 7).alias("brier"), r9(-F.avg(F.when(y == 1, F.ln(p)).otherwise(F.ln(1 - p))), 6).alias("log_loss"))


def _auc_sql(keys: str, source: str = _SCORED) -> str:
    k = f"partition by {keys}" if keys else ""
    g = f"{keys}, " if keys else ""
    tie = f"partition by {keys}, score" if keys else "partition by score"
    return f"""select {g}count(*) filter (where label = 1) as positives, count(*) filter (where label = 0) as negatives,
      {sql9("case when count(*) filter (where label = 1) > 0 and count(*) filter (where label = 0) > 0 then (sum(r) filter (where label = 1) - count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2.0) / (count(*) filter (where label = 1) * (count(*) filter (where label = 0))::double) end")} as auc
      from (select *, rank() over ({k} order by score) + (count(*) over ({tie}) - 1) / 2.0 as r from {source}) {"group by " + keys if keys else ""}"""


@query("auc_within_group", _auc_sql("source"))
def auc_within_group(spark, sf_dir):
    return D.auc(scored(spark, sf_dir), ("source",)).select("source", "positives", "negatives", r9("auc").alias("auc"))


@query("auc_pooled", _auc_sql(""))
def auc_pooled(spark, sf_dir):
    return D.auc_by_value(scored(spark, sf_dir)).select("positives", "negatives", r9("auc").alias("auc"))


@query("auc_within_summary", f"select count(auc) as groups, {sql9('avg(auc)', 8)} as mean, {sql9('stddev_samp(auc)', 8)} as sd from ({_auc_sql('source')})")
def auc_within_summary(spark, sf_dir):
    a = D.auc(scored(spark, sf_dir), ("source",))
    return a.agg(F.count("auc").alias("groups"), r9(F.avg("auc"), 8).alias("mean"), r9(F.stddev_samp("auc"), 8).alias("sd"))


_PHASE = f"(select row_index % 24 as phase, f_roc_60 as score, case when l_fwddir_24 = 1 then 1 else 0 end as label from {RESEARCH} where f_roc_60 is not null and l_fwddir_24 is not null and l_fwddir_24 <> 0)"


def phased(spark, sf_dir):
    flat = research(spark, sf_dir).filter("f_roc_60 is not null and l_fwddir_24 is not null and l_fwddir_24 <> 0")
    return flat.select("row_index", F.pmod("row_index", F.lit(24)).cast("long").alias("phase"), F.col("f_roc_60").alias("score"), (F.col("l_fwddir_24") == 1).cast("int").alias("label"))


@query("auc_phase", _auc_sql("phase", _PHASE))
def auc_phase(spark, sf_dir):
    return D.auc(phased(spark, sf_dir), ("phase",)).select("phase", "positives", "negatives", r9("auc").alias("auc"))


@query("phase_statistic", f"select count(auc) as known, count(*) - count(auc) as undefined, {sql9('avg(auc - 0.5)', 8)} as t from ({_auc_sql('phase', _PHASE)})")
def phase_statistic(spark, sf_dir):
    a = D.auc(phased(spark, sf_dir), ("phase",))
    return a.agg(F.count("auc").alias("known"), (F.count(F.lit(1)) - F.count("auc")).alias("undefined"), r9(F.avg(F.col("auc") - 0.5), 8).alias("t"))


_SLOTS = f"(select (open_ms - {START}) // {HOUR} as hour_idx, (close - open)::bigint as d from ({bars_sql(HOUR, 'ALL')}))"
GRID = f"(select 2024::int as year, g.hour_idx, case when g.hour_idx % 29 in (0, 1) then null else d end as d from (select unnest(generate_series(0, (select max(hour_idx) from {_SLOTS}))) as hour_idx) g left join {_SLOTS} s on s.hour_idx = g.hour_idx)"


def grid(spark, sf_dir):
    """The nominal hours up to the last bar; hours without one are null."""
    h = F.floor((F.col("open_ms") - START) / HOUR)
    slots = hour_bars(spark, sf_dir, "ALL").select(h.alias("hour_idx"), (F.col("close") - F.col("open")).alias("d"))
    nominal = slots.agg(F.max("hour_idx").alias("last")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("hour_idx"))
    d = F.when(~(F.col("hour_idx") % 29).isin(0, 1), F.col("d")).cast("long")
    return nominal.join(slots, "hour_idx", "left").select(F.lit(2024).cast("int").alias("year"), "hour_idx", d.alias("d"))


def hours(spark, sf_dir):
    return grid(spark, sf_dir).groupBy("year").agg((F.max("hour_idx") + 1).cast("int").alias("hours"))


@query("prefix_sums", f"select year, hour_idx + 1 as at, (sum(coalesce(d, 0)) over w)::bigint as value_before, (sum((d is not null)::int) over w)::bigint as valid_before from {GRID} window w as (partition by year order by hour_idx) union all select distinct year, 0, 0, 0 from {GRID}")
def prefix_sums(spark, sf_dir):
    return D.prefix_sums(grid(spark, sf_dir))


@query("block_means", f"select s as start_at, (coalesce(sum(d), 0))::bigint as num, count(d) as den from (select unnest(range(0, (select max(hour_idx) + 1 from {GRID}) - 167, 24)) as s) b join {GRID} g on g.hour_idx >= s and g.hour_idx < s + 168 group by s")
def block_means(spark, sf_dir):
    """Blocks that start every 24 hours, as long as they lie in the grid whole;
    each is two prefix look-ups."""
    last = F.col("hours").cast("long") - 168
    starts = hours(spark, sf_dir).filter(last >= 0).select("year", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(24).cast("long"))).alias("start")).withColumns({"take": F.lit(168).cast("long"), "replicate": F.col("start").cast("int")})
    return D.block_means(starts, D.prefix_sums(grid(spark, sf_dir))).select(F.col("replicate").cast("long").alias("start_at"), "num", "den")


@query("pooled_mean", f"select (sum(d))::bigint as num, count(d) as den, {sql9('sum(d) / count(d)::double')} as mean from {GRID}")
def pooled_mean(spark, sf_dir):
    return grid(spark, sf_dir).agg(F.sum("d").alias("num"), F.count("d").alias("den")).withColumn("mean", r9(F.col("num") / F.col("den")))


@query("nearest_rank", f"select year, n, d as value from (select year, d, row_number() over (partition by year order by d) as k, count(*) over (partition by year) as n from {GRID} where d is not null) where k = (4 * n + 4) // 5")
def nearest_rank(spark, sf_dir):
    return D.nearest_rank(grid(spark, sf_dir).filter("d is not null"), "d", 4, 5, ("year",))


@query("holm", f"with p as (select name, p, row_number() over (order by p, name) as k, count(*) over () as m from (select unnest(['a', 'b', 'c']) as name, unnest([0.012, 0.041, 0.020]::double[]) as p)), t as (select *, 0.05::double / (m - k + 1) as threshold, p <= 0.05::double / (m - k + 1) as passes from p) select name, p, k as rank, {sql9('threshold')} as threshold, passes, min(passes::int) over (order by k) = 1 as rejected from t")
def holm(spark, sf_dir):
    tests = spark.createDataFrame([("a", 0.012), ("b", 0.041), ("c", 0.020)], "name string, p double")
    return D.holm(tests).select("name", "p", F.col("rank").cast("long").alias("rank"), r9("threshold").alias("threshold"), "passes", "rejected")


@query("stream_seeds", "select label, y::bigint as year, (('0x' || substr(sha256('chronolith-v1|' || label || '|' || y::varchar), 1, 15))::bigint) as seed60 from (select unnest(['candidate-vs-b2', 'm2', 'm4']) as label, 2022 as y union all select unnest(['candidate-vs-b2', 'm2', 'm4']), 2024)")
def stream_seeds(spark, sf_dir):
    """The seeds' upper 60 bits, which fit a signed long."""
    rows = spark.createDataFrame([(n, y) for n in ("candidate-vs-b2", "m2", "m4") for y in (2022, 2024)], "label string, year long")
    seed = D.stream_seed_column(F.col("label"), F.col("year"), "chronolith-v1")
    return rows.select("label", "year", F.floor(seed / 16).cast("long").alias("seed60"))


#: Replicates of the moving-block bootstrap, a fixed value; the other two have theirs as defaults.
BLOCK_REPLICATES = 20_000


@query("bootstrap_moving_block")
def bootstrap_moving_block(spark, sf_dir):
    return D.bootstrap(grid(spark, sf_dir), hours(spark, sf_dir), "candidate-vs-b2", BLOCK_REPLICATES)


@query("bootstrap_multiplicity")
def bootstrap_multiplicity(spark, sf_dir):
    h = hours(spark, sf_dir)
    return D.multiplicity_digest(D.block_starts(h, "candidate-vs-b2", BLOCK_REPLICATES), h)


@query("ic_resampling")
def ic_resampling(spark, sf_dir):
    ics = V.ic_records(tested(spark, sf_dir)).filter("feature = 'f_roc_60'").select("fold_id", F.col("pearson_ic").alias("ic"))
    return D.ic_resampling(ics)


@query("phase_bootstrap")
def phase_bootstrap(spark, sf_dir):
    return D.circular_block_bootstrap(phased(spark, sf_dir))


def sided(spark, sf_dir):
    return M.sides(with_n(X.research_table_exact(hour_bars(spark, sf_dir, "ALL"))), F.col("n"))


@query("ridge_walk_forward")
def ridge_walk_forward(spark, sf_dir):
    return M.ridge_walk_forward(sided(spark, sf_dir))


@query("logistic_walk_forward")
def logistic_walk_forward(spark, sf_dir):
    return M.logistic_walk_forward(sided(spark, sf_dir))


@query("kill_gate")
def kill_gate(spark, sf_dir):
    means = logistic_walk_forward(spark, sf_dir).agg(*[F.avg(c).cast("double").alias(c) for c in M.KILL])
    return M.kill_gate(means)
