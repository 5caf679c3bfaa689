"""Auxiliary series: the frozen registry, their scans and canonical projections."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith import schemas
from chronolith.functions import parse
from chronolith.sources.archives import FUNDING

MINUTE, FIVE, HOUR, DAY = 60_000, 300_000, 3_600_000, 86_400_000


class Series(NamedTuple):
    series_id: str
    provider: str
    venue: str
    market_type: str
    symbol: str
    family: str
    cadence: str
    native_interval: str
    timestamp_role: str
    start: str


# fixed values: the thirteen registered series
REGISTRY = (
    Series("btc_settled_funding", "binance_usd_m_futures", "binance", "perpetual", "BTCUSDT", "funding", "monthly", "per_settlement_event", "settlement", "2020-01-01"),
    Series("btc_open_interest_5m", "binance_futures", "binance", "perpetual", "BTCUSDT", "open_interest", "daily", "5m", "UNRESOLVED_CONSERVATIVE", "2020-09-01"),
    Series("btc_mark_price_1m", "binance_futures", "binance", "perpetual", "BTCUSDT", "derived_price", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("btc_index_price_1m", "binance_futures", "binance", "perpetual", "BTCUSDT", "derived_price", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("btc_native_premium_1m", "binance_futures", "binance", "perpetual", "BTCUSDT", "derived_price", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("binance_btc_spot_ohlcv_1m", "binance_spot", "binance", "spot", "BTCUSDT", "ohlcv", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("kraken_xbtusd_spot_ohlcv_1h", "kraken", "kraken", "spot", "XBTUSD", "ohlcvt", "archive", "1h", "DOCUMENTED_INTERVAL_START", "2020-01-01"),
    Series("ethusdt_perp_ohlcv_1m", "binance_usd_m_futures", "binance", "perpetual", "ETHUSDT", "ohlcv", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("eth_settled_funding", "binance_usd_m_futures", "binance", "perpetual", "ETHUSDT", "funding", "monthly", "per_settlement_event", "settlement", "2020-01-01"),
    Series("eth_open_interest_5m", "binance_futures", "binance", "perpetual", "ETHUSDT", "open_interest", "daily", "5m", "UNRESOLVED_CONSERVATIVE", "2021-12-01"),
    Series("eth_mark_price_1m", "binance_futures", "binance", "perpetual", "ETHUSDT", "derived_price", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("eth_index_price_1m", "binance_futures", "binance", "perpetual", "ETHUSDT", "derived_price", "monthly", "1m", "interval_start", "2020-01-01"),
    Series("eth_native_premium_1m", "binance_futures", "binance", "perpetual", "ETHUSDT", "derived_price", "monthly", "1m", "interval_start", "2020-01-01"),
)
# fixed values: the columns of open-interest files, and the window of all series
OPEN_INTEREST = (
    "create_time", "symbol", "sum_open_interest", "sum_open_interest_value",
    "count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio", "count_long_short_ratio", "sum_taker_long_short_vol_ratio",
)
FIRST_MS, AFTER_MS = 1_577_836_800_000, 1_735_689_600_000
#: The one series whose files may quote an empty ratio.
QUOTED_RATIOS = "btc_open_interest_5m"
STEPS = {"1m": MINUTE, "5m": FIVE, "1h": HOUR, "per_settlement_event": 8 * HOUR}


def instrument(series: Series) -> str:
    """The canonical name of a series' instrument."""
    return f"binance:usd_m_futures:{series.symbol}:perpetual" if series.market_type == "perpetual" else f"{series.venue}:spot:{series.symbol}"


def registry(spark: SparkSession) -> DataFrame:
    """The registry as a table of thirteen rows."""
    return spark.createDataFrame([tuple(s) for s in REGISTRY], ", ".join(f"{c} string" for c in Series._fields))


def eligibility(family: Column, t: Column, step: Column) -> Column:
    """When a value may first be used: 1 ms after a settlement, 5 minutes after a
    snapshot, at the end of a bar."""
    return F.when(family == "funding", t + 1).when(family == "open_interest", t + FIVE).otherwise(t + step)


def _fields(lines: DataFrame, names: tuple[str, ...]) -> DataFrame:
    parts = F.split("line", ",", -1)
    return lines.withColumn("parts", parts).select("*", *[F.get("parts", F.lit(i)).alias(c) for i, c in enumerate(names)])


def _deduplicated(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a key with equal bytes collapse; different bytes are a conflict."""
    by_line = rows.groupBy(key, "line").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct(*[c for c in rows.columns if c not in (key, "line")]), "line_no").alias("row"))
    variants = by_line.groupBy(key).agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("variants"), F.min_by("row", "line").alias("row"))
    conflict = F.raise_error(F.concat(F.lit("same_key_conflict: "), F.col(key).cast("string")))
    return variants.select(F.when(F.col("variants") == 1, F.col(key)).otherwise(conflict.cast("long")).alias(key), "copies", "row.*")


def _first(*tests: tuple[Column, str]) -> Column:
    """The reason of the first test that holds, else null."""
    reason = F.lit(None).cast("string")
    for test, name in reversed(tests):
        reason = F.when(F.coalesce(test, F.lit(True)), name).otherwise(reason)
    return reason


def _headed(lines: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The lines after a header, which must be exactly ``names``: another first
    line stays, marked as a bad header."""
    bad = (F.col("line_no") == 0) & (F.col("line") != ",".join(names))
    return lines.withColumn("bad_header", bad).filter((F.col("line_no") > 0) | bad)


def _outside(t: Column, start_ms: int, end_ms: int) -> Column:
    return ~t.between(start_ms, end_ms - 1)


def funding_rows(lines: DataFrame, series: Series, start_ms: int = FIRST_MS, end_ms: int = AFTER_MS) -> DataFrame:
    """Typed settled-funding rows, each with the ``reason`` that it breaks the
    policy by, null for none. The first line of a file must be the header."""
    rows = _fields(_headed(lines, FUNDING), FUNDING).withColumns({"event_ts": parse.epoch_ms(F.col("calc_time")), "rate": parse.signed_decimal(F.col("last_funding_rate"))})
    t, rate = F.col("event_ts"), F.col("rate")
    hours = F.col("funding_interval_hours")
    reason = _first(
        (F.col("bad_header"), "header_mismatch"), (F.contains("line", F.lit('"')), "quoting_not_permitted"), (F.size("parts") != len(FUNDING), "field_count"), (t.isNull(), "timestamp_malformed"), (_outside(t, start_ms, end_ms), "outside_period"),
        (~(hours.rlike("^[0-9]{1,19}$") & (hours.try_cast("bigint") > 0)), "funding_interval"), (rate.isNull(), "decimal_policy"),
    )
    return rows.select("source_file", "source_sha256", "line_no", "line", "event_ts", "funding_interval_hours", rate.alias("last_funding_rate"), reason.alias("reason"))


def open_interest_rows(lines: DataFrame, series: Series, start_ms: int = FIRST_MS, end_ms: int = AFTER_MS) -> DataFrame:
    """Typed open-interest snapshots with their ``reason``. Ratios are checked
    and dropped: empty ones are nulls of the source, and one series may write
    them as two quotes; no other quoting is allowed."""
    rows = _fields(_headed(lines, OPEN_INTEREST), OPEN_INTEREST)
    empty = (F.lit(""), F.lit('""')) if series.series_id == QUOTED_RATIOS else (F.lit(""),)
    quoted, ratios = F.lit(False), F.lit(False)
    for c in OPEN_INTEREST:
        own = F.contains(c, F.lit('"'))
        quoted = quoted | (own & (F.col(c) != '""') if c in OPEN_INTEREST[4:] and len(empty) > 1 else own)
    for c in OPEN_INTEREST[4:]:
        ratios = ratios | ~(F.col(c).isin(*empty) | parse.decimal_reason(parse.expand_scientific(F.col(c))).isNull())
    number = lambda c: parse.exact_decimal(parse.expand_scientific(F.col(c)))
    rows = rows.withColumns({"event_ts": parse.datetime_ms(F.col("create_time")), "value": number("sum_open_interest"), "amount": number("sum_open_interest_value"), "bad_ratio": ratios})
    t, value, amount, ratios = F.col("event_ts"), F.col("value"), F.col("amount"), F.col("bad_ratio")
    reason = _first(
        (F.col("bad_header"), "header_mismatch"), (F.size("parts") != len(OPEN_INTEREST), "field_count"), (quoted, "quoting_not_permitted"), (t.isNull(), "timestamp_malformed"), (_outside(t, start_ms, end_ms), "outside_period"),
        (F.col("symbol") != series.symbol, "symbol"), (ratios | value.isNull() | amount.isNull(), "decimal_policy"),
    )
    return rows.select("source_file", "source_sha256", "line_no", "line", "event_ts", value.alias("sum_open_interest"), parse.q18_text(amount).alias("sum_open_interest_value"), reason.alias("reason"))


# fixed values: the columns of bars, of 12 columns and of 7
BAR = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore")
BAR_SEVEN = ("open_time", "open", "high", "low", "close", "volume", "count")


def bar_rows(lines: DataFrame, series: Series, header: bool = False, start_ms: int = FIRST_MS, end_ms: int = AFTER_MS) -> DataFrame:
    """Typed bars of 12 columns, or 7 with epoch seconds, with their ``reason``.

    With ``header`` the first line must be the column names; without, every
    line is a row. Prices of derived series may be negative and their volumes
    are zero.
    """
    seven, derived = series.family == "ohlcvt", series.family == "derived_price"
    names = BAR_SEVEN if seven else BAR
    rows = _fields(_headed(lines, names) if header else lines.withColumn("bad_header", F.lit(False)), names)
    step = STEPS[series.native_interval]
    time = F.when(F.col("open_time").rlike("^[0-9]{10}$" if seven else "^[0-9]{13}$"), F.col("open_time").try_cast("bigint") * (1000 if seven else 1))
    number = lambda c, signed=False: (parse.signed_decimal if signed else parse.exact_decimal)(F.col(c))
    price_names = ("open", "high", "low", "close")
    volume_names = ("volume",) + (() if seven else ("quote_volume", "taker_buy_volume", "taker_buy_quote_volume"))
    # step by step, so that what is used often is computed once
    rows = rows.withColumns({"event_ts": time} | {c: parse.expand_scientific(F.col(c)) for c in price_names + volume_names})
    rows = rows.withColumns({f"{c}_number": number(c, derived and c in price_names) for c in price_names + volume_names})
    t = F.col("event_ts")
    prices, volumes = {c: F.col(f"{c}_number") for c in price_names}, {c: F.col(f"{c}_number") for c in volume_names}
    missing, traded = F.lit(False), F.lit(False)
    for c in (*prices.values(), *volumes.values()):
        missing = missing | c.isNull()
    for c in volumes.values():
        traded = traded | (c != 0)
    close_time = t + step - 1 if seven else F.when(F.col("close_time").rlike("^[0-9]{13}$"), F.col("close_time").try_cast("bigint"))
    count = F.when(F.col("count").rlike("^[0-9]{1,19}$"), F.col("count").try_cast("bigint"))
    bounds = (prices["low"] > F.least(prices["open"], prices["close"])) | (prices["high"] < F.greatest(prices["open"], prices["close"]))
    reason = _first(
        (F.col("bad_header"), "header_mismatch"), (F.col("line").rlike('["\r\ufeff]'), "quoting_not_permitted"), (F.size("parts") != len(names), "field_count"), (t.isNull(), "timestamp_malformed"), (_outside(t, start_ms, end_ms), "outside_period"),
        (F.pmod(t, F.lit(step)) != 0, "off_grid"), (close_time.isNull() | (close_time != t + step - 1), "bar_span"), (missing, "decimal_policy"), (bounds, "bar_bounds"), (traded if derived else F.lit(False), "structural_zero"), (count.isNull(), "count"),
    )
    absent = F.lit(None).cast(schemas.D38)
    return rows.select(
        "source_file", "source_sha256", "line_no", "line", "event_ts", *[c.alias(k) for k, c in prices.items()], *[volumes.get(c, absent).alias(c) for c in ("volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume")],
        count.alias("source_count"), (F.lit(None).cast("string") if seven else F.col("ignore")).alias("source_ignore"), reason.alias("reason"),
    )


def closed(rows: DataFrame) -> DataFrame:
    """The rows, if none has a reason: the first that has one fails the job."""
    failure = F.raise_error(F.concat(F.lit("row_rejected: "), "reason", F.lit(" in line "), F.col("line_no").cast("string"), F.lit(" of "), "source_file")).cast("long")
    return rows.withColumn("event_ts", F.when(F.col("reason").isNull(), F.col("event_ts")).otherwise(failure)).drop("reason")


def _identity(series: Series) -> dict[str, Column]:
    return {c: F.lit(v) for c, v in (("provider", series.provider), ("venue", series.venue), ("market_type", series.market_type), ("instrument_id", instrument(series)), ("provider_symbol", series.symbol), ("series_id", series.series_id), ("native_interval", series.native_interval), ("timestamp_role", series.timestamp_role), ("quality_flags", None))}


def scan_funding(lines: DataFrame, series: Series, **period: int) -> DataFrame:
    """Settled funding rows (header line first) as the scalar series table; a row
    that breaks the policy, or a key with different bytes, fails the job."""
    return _scalar(closed(funding_rows(lines, series, **period)), series)


def scan_open_interest(lines: DataFrame, series: Series, **period: int) -> DataFrame:
    """Open-interest snapshots, as :func:`scan_funding`."""
    return _scalar(closed(open_interest_rows(lines, series, **period)), series)


def _scalar(rows: DataFrame, series: Series) -> DataFrame:
    e = F.col("event_ts")
    filled = _deduplicated(rows, "event_ts").withColumns(_identity(series) | {"settlement_or_snapshot_ts": e, "eligibility_ts": eligibility(F.lit(series.family), e, F.lit(STEPS[series.native_interval]))})
    return filled.select(*[(F.col(f.name) if f.name in filled.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.SCALAR_SERIES])


def scan_klines(lines: DataFrame, series: Series, header: bool = False, **period: int) -> DataFrame:
    """Bars as the kline series table; a row that breaks the policy, or an
    interval with different bytes, fails the job."""
    step = STEPS[series.native_interval]
    e = F.col("event_ts")
    own = {
        "interval_open_ts": e, "interval_close_ts": e + step - 1, "eligibility_ts": eligibility(F.lit(series.family), e, F.lit(step)),
        "trade_count": F.lit(None).cast("long") if series.family == "derived_price" else F.col("source_count"), "volume_semantics": F.lit("structural_zero" if series.family == "derived_price" else "traded"),
    }
    filled = _deduplicated(closed(bar_rows(lines, series, header, **period)), "event_ts").withColumns(_identity(series) | own)
    return filled.select(*[(F.col(f.name) if f.name in filled.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.KLINE_SERIES])


def gap_manifest(rows: DataFrame, series: Series, start_ms: int, end_ms: int) -> DataFrame:
    """Missing native intervals of a period, by anti-join of its grid."""
    step = STEPS[series.native_interval]
    spark = rows.sparkSession
    days = spark.range(start_ms, end_ms, DAY).select(F.col("id").alias("day"))
    grid = days.select(F.explode(F.sequence("day", F.least(F.col("day") + DAY, F.lit(end_ms)) - step, F.lit(step))).alias("interval_open_ts"))
    missing = grid.join(rows.select(F.col("event_ts").alias("interval_open_ts")), "interval_open_ts", "left_anti")
    return missing.select(F.lit(series.series_id).alias("series_id"), "interval_open_ts", (F.col("interval_open_ts") + step - 1).alias("interval_close_ts"), F.lit("native_grid").alias("enumeration_basis"), F.lit("missing_native_interval").alias("exclusion_reason"))
