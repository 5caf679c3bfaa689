"""Archives, series scans, identity, publication, configuration and streaming."""

import hashlib
import io
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chronolith import config, identity, orchestrate, schemas
from chronolith.operators import gates
from chronolith.publish import PublicationError, Store
from chronolith.sources import archives, fetch, series
from chronolith.streaming import bars as stream

T0 = 1_704_067_200_000


def zipped(name, text):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, text)
    return out.getvalue()


def test_checksums_and_archives():
    data = zipped("a.csv", "x,1\n")
    digest = hashlib.sha256(data).hexdigest()
    assert archives.parse_checksum(f"{digest}  a.zip\n", "a.zip") == digest
    for bad in (f"{digest} a.zip", f"{digest}  b.zip", f"{digest.upper()}  a.zip"):
        with pytest.raises(archives.SourceError):
            archives.parse_checksum(bad, "a.zip")
    assert archives.read_member(data) == b"x,1\n"
    for broken in (data[:-30], zipped("../a", "x"), zipped("a", "0" * 10**6)):
        with pytest.raises(archives.SourceError):
            archives.read_member(broken)


def test_zip_scan_and_kline_policy(spark, tmp_path):
    rows = ["1704067200000,42571.90,42600.00,42500.10,42590.50,12.5,1704067259999,500000.25,3210,6.25,250000.125,0", "", "bad,1", "1704067260000,01,1,1,1,1,1,1,1,1,1,0"]
    (tmp_path / "a.zip").write_bytes(zipped("a.csv", "\n".join([",".join(archives.KLINE), *rows])))
    (tmp_path / "b.zip").write_bytes(b"no archive")
    lines = archives.scan_zip_lines(spark, str(tmp_path))
    assert [r.error for r in lines.filter("error is not null").collect()] == ["archive_corrupt"]
    out = archives.kline_rows(lines.filter("error is null"), header=True)
    assert sorted(str(r.reason) for r in out.collect()) == ["None", "decimal_policy", "field_count"]
    kept = archives.quarantine(out, "reason", str(tmp_path / "q"))
    assert kept.count() == 1 and spark.read.parquet(str(tmp_path / "q")).count() == 2


def _lines(spark, *lines, header=None):
    first = [] if header is None else [",".join(header)]
    return spark.createDataFrame([("f", "0" * 64, n, x) for n, x in enumerate([*first, *lines])], "source_file string, source_sha256 string, line_no long, line string")


def _reasons(rows):
    return [r.reason for r in sorted(rows.collect(), key=lambda r: r.line_no)]


def test_series_scans(spark):
    funding = series.REGISTRY[0]
    df = _lines(spark, "1580486400002,8,-0.000123456789012345", "1580515200000,8,0.0001", "1580515200000,8,0.0001", header=archives.FUNDING)
    out = {r.event_ts: r for r in series.scan_funding(df, funding).collect()}
    r = out[1580486400002]
    assert len(out) == 2 and r.last_funding_rate == Decimal("-0.000123456789012345") and r.eligibility_ts == 1580486400003 and r.quality_flags is None
    assert (r.provider, r.market_type, r.instrument_id, r.native_interval, r.timestamp_role) == ("binance_usd_m_futures", "perpetual", "binance:usd_m_futures:BTCUSDT:perpetual", "per_settlement_event", "settlement")
    clash = df.union(spark.createDataFrame([("f", "0" * 64, 4, "1580515200000,8,0.0002")], df.schema))
    with pytest.raises(Exception, match="same_key_conflict"):
        series.scan_funding(clash, funding).collect()
    oi = _lines(spark, '2021-12-01 00:55:00,BTCUSDT,12345.678901234567890123,456789.1234,1,2,,""', header=series.OPEN_INTEREST)
    r = series.scan_open_interest(oi, series.REGISTRY[1]).first()
    assert r.sum_open_interest == Decimal("12345.678901234567890123") and r.sum_open_interest_value == "456789.123400000000000000" and r.eligibility_ts == r.event_ts + 300_000
    kraken = series.REGISTRY[6]
    k = series.scan_klines(_lines(spark, *[f"{T0 // 1000 + 3600 * h},10,12,9,11,1.5,7" for h in (0, 1, 3)]), kraken)
    assert [f.name for f in k.schema] == [f.name for f in schemas.KLINE_SERIES] and k.count() == 3 and {r.instrument_id for r in k.collect()} == {"kraken:spot:XBTUSD"}
    gap = series.gap_manifest(k, kraken, T0, T0 + 4 * 3_600_000).collect()
    assert [g.interval_open_ts for g in gap] == [T0 + 2 * 3_600_000]
    assert series.registry(spark).count() == 13


def test_series_rows_are_never_dropped(spark):
    """Every line that breaks the policy keeps its row, with the reason."""
    funding, oi, eth_oi, mark, spot, kraken = (series.REGISTRY[k] for k in (0, 1, 9, 2, 5, 6))
    rows = series.funding_rows(_lines(spark, "1580486400002,8,0.1", "1580486400002,xx,0.1", "1580486400002,0,0.1", "-1,8,0.1", "1,8,0.1", "1580486400002,8", '"1580486400002",8,0.1', "1580486400002,8,01", "", header=archives.FUNDING), funding)
    assert _reasons(rows) == [None, "funding_interval", "funding_interval", "timestamp_malformed", "outside_period", "field_count", "quoting_not_permitted", "decimal_policy", "field_count"]
    assert _reasons(series.funding_rows(_lines(spark, "1580486400002,8,0.1"), funding)) == ["header_mismatch"]
    good = "2022-01-01 00:05:00,ETHUSDT,1.5,2.5"
    lines = _lines(spark, f"{good},,,,", f"{good},1,2,3,4E-3", f'{good},"",,,', f"{good.replace('ETH', 'BTC')},,,,", f"{good},x,,,", "2022-01-01,ETHUSDT,1,2,,,,", f"{good},,,", header=series.OPEN_INTEREST)
    assert _reasons(series.open_interest_rows(lines, eth_oi)) == [None, None, "quoting_not_permitted", "symbol", "decimal_policy", "timestamp_malformed", "field_count"]
    assert _reasons(series.open_interest_rows(lines, oi))[2:4] == ["symbol", None]
    t = T0
    bar = lambda t=t, o="10", h="12", l="9", c="11", v="1", close=None, q="1", n="5", extra="": f"{t},{o},{h},{l},{c},{v},{t + 59_999 if close is None else close},{q},{n},0.5,0.5,0{extra}"  # noqa: E731, E741
    lines = _lines(spark, bar(), bar(close=999), bar(h="10.5"), bar(l="10.5"), bar(extra=",1,2"), bar(t=t + 1), bar(o="-1"), bar(n="-1"), bar(t=1_735_689_600_000), bar(v="1.0000000000000000001"), "x" + bar(), ",".join(series.BAR))
    assert _reasons(series.bar_rows(lines, spot)) == [None, "bar_span", "bar_bounds", "bar_bounds", "field_count", "off_grid", "decimal_policy", "count", "outside_period", "decimal_policy", "timestamp_malformed", "timestamp_malformed"]
    with pytest.raises(Exception, match="row_rejected: bar_span in line 1"):
        series.scan_klines(lines.filter("line_no < 2"), spot).collect()
    zero = f"{t},-0.5,0.1,-0.6,-0.2,0,{t + 59_999},0,12,0,0,0"
    lines = _lines(spark, zero, bar(), header=series.BAR)
    assert _reasons(series.bar_rows(lines, mark, header=True)) == [None, "structural_zero"]
    assert _reasons(series.bar_rows(_lines(spark, f"{T0 // 1000},1,2,1,1,1,3", f"{T0},1,2,1,1,1,3"), kraken)) == [None, "timestamp_malformed"]
    r = series.scan_klines(lines.filter("line_no < 2"), mark, header=True).first()
    assert r.trade_count is None and r.source_count == 12 and r.volume_semantics == "structural_zero" and r.low == Decimal("-0.6")


def test_fetch_retries_and_hosts():
    hosts = frozenset({"data.test"})
    answers = [fetch.Response(503, {}, b""), fetch.Response(302, {"location": "/b"}, b""), fetch.Response(200, {}, b"ok")]
    waits = []
    assert fetch.fetch("https://data.test/a", lambda url: answers.pop(0), hosts, waits.append, lambda: 0.0) == b"ok" and waits == [1.0]
    for url in ("http://data.test/a", "https://evil.test/a"):
        with pytest.raises(archives.SourceError):
            fetch.fetch(url, lambda u: fetch.Response(200, {}, b""), hosts)
    with pytest.raises(archives.SourceError, match="http_status"):
        fetch.fetch("https://data.test/a", lambda u: fetch.Response(404, {}, b""), hosts)
    data = zipped("a.csv", "x")
    sums = f"{hashlib.sha256(data).hexdigest()}  a.zip\n".encode()
    got, _ = fetch.fetch_verified("https://data.test/a.zip", lambda u: fetch.Response(200, {}, sums if u.endswith("CHECKSUM") else data), hosts)
    assert got == data


def test_canonical_json_and_hashes(spark):
    assert identity.canonical_json({"b": [1, None, True], "a": "é\n"}) == '{"a":"é\\n","b":[1,null,true]}'.encode()
    for bad in ({"a": 1.5}, {1: 2}, {"a": 2**60}):
        with pytest.raises((TypeError, ValueError)):
            identity.canonical_json(bad)
    rows = [(i, Decimal(i) / 4, None if i % 3 == 0 else Decimal(1), None, None, None, None) for i in range(20)]
    df = spark.createDataFrame(rows, schemas.RESEARCH)
    a = identity.content_hash(df, schemas.RESEARCH, "d", ["open_time_ms"])
    assert a == identity.content_hash(df.repartition(5), schemas.RESEARCH, "d", ["open_time_ms"]) != identity.content_hash(df, schemas.RESEARCH, "e", ["open_time_ms"])
    lines = [json.dumps([i, f"{Decimal(i) / 4:.18f}", None if i % 3 == 0 else "1.000000000000000000", None, None, None, None], separators=(",", ":")) for i in range(20)]
    h = hashlib.sha256(b"d\0" + schemas.fingerprint(schemas.RESEARCH).encode() + b"\n" + "".join(f"{x}\n" for x in lines).encode()).hexdigest()
    assert a == h
    m = identity.multiset_hash(df, schemas.RESEARCH, "d")
    assert m == identity.multiset_hash(df.orderBy(F.rand(1)), schemas.RESEARCH, "d") != identity.multiset_hash(df.limit(19), schemas.RESEARCH, "d")


def test_store(tmp_path):
    s = Store(tmp_path)
    d = s.put_object(b"x")
    assert s.put_object(b"x") == d and s.get_object(d) == b"x"
    assert s.publish("c1", {"objects": [d], "parents": []}) == "PUBLISHED" and s.publish("c1", {"objects": [d], "parents": []}) == "VERIFIED_NO_OP"
    with pytest.raises(PublicationError):
        s.publish("c1", {"objects": [], "parents": []})
    s.publish("c2", {"objects": [], "parents": ["c1"]})
    s.set_current("a/b", "c2")
    assert s.current("a/b") == "c2" and s.current("none") is None
    (tmp_path / "objects" / d[:2] / d).write_bytes(b"y")
    with pytest.raises(PublicationError):
        s.current("a/b")
    with s.lock("lane"), pytest.raises(PublicationError), s.lock("lane"):
        pass
    with s.lock("lane"):
        pass


def test_publish_table_and_backfill(spark, tmp_path):
    s = Store(tmp_path / "store")
    df = spark.createDataFrame([(i, Decimal(1), None, None, None, None, None) for i in range(5)], schemas.RESEARCH)
    ok = spark.createDataFrame([("c", "hard", 0, "pass")], "check_id string, severity string, violations long, outcome string")
    go = lambda f: orchestrate.publish_table(df, schemas.RESEARCH, f, ["open_time_ms"], "r/2024", str(tmp_path / "t"), s)
    assert go(ok.withColumn("outcome", F.lit("fail"))) == "QUALITY_BLOCKED" and s.current("r/2024") is None
    assert go(ok) == "PUBLISHED" and go(ok) == "VERIFIED_NO_OP"
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    first = s.current("r/2024")
    assert orchestrate.verify_table(spark, schemas.RESEARCH, ["open_time_ms"], "r/2024", s)["path"].endswith(first)
    other = orchestrate.publish_table(df.limit(3), schemas.RESEARCH, ok, ["open_time_ms"], "r/2024", str(tmp_path / "t"), s)
    assert other == "PUBLISHED" and s.current("r/2024") != first
    assert spark.read.parquet(str(tmp_path / "t" / f"commit={first}")).count() == 5  # what stood before still stands
    df.limit(2).write.mode("overwrite").parquet(str(tmp_path / "t" / f"commit={s.current('r/2024')}"))
    with pytest.raises(PublicationError, match="stored table differs"):
        orchestrate.verify_table(spark, schemas.RESEARCH, ["open_time_ms"], "r/2024", s)
    assert orchestrate.first_unpublished(["2024", "2025"], s, "r") == "2025"
    out = orchestrate.backfill(["a", "b", "c", "d"], lambda p: "REJECTED" if p == "b" else "PUBLISHED")
    assert out == {"a": "PUBLISHED", "b": "REJECTED"}


def test_config():
    doc = {"schema": "s", "parent": "p", "roc_lookback": 60, "vol_lookback": 20, "volume_lookback": 20, "horizon": 24}
    config.RESEARCH.check(config.parse_document(json.dumps(doc)))
    for bad in (doc | {"horizon": 25}, doc | {"more": 1}, {k: v for k, v in doc.items() if k != "parent"}):
        with pytest.raises(config.ConfigError):
            config.RESEARCH.check(bad)
    for text in ('{"a": 1, "a": 2}', '{"a": 1.5}'):
        with pytest.raises(config.ConfigError):
            config.parse_document(text)
    state = {"state": "OWNER_APPROVED_PENDING_COUNSEL", "source_terms": "t", "review_date": "d", "reviewer": "r", "rationale": "x"}
    rights = {"schema": "s", "record_id": "i", "provider": "p", "reviewer": "r", "review_date": "d", "operations": {o: state for o in (*config.INTERNAL_OPERATIONS, *config.OTHER_OPERATIONS)}}
    assert config.permits(rights, "analyze_internal") and not config.permits(rights, "customer_display")
    config.require_pinned(doc, config.semantic_hash(doc))
    with pytest.raises(config.ConfigError):
        config.require_pinned(doc, "0" * 64)
    assert not config.sealed_year_permitted(b"k", "p", 2025, "no")
    assert config.dispatch(doc, {"s": lambda d: 7}) == 7


def test_gates_and_calibration(spark):
    p = [Decimal(i) / 40 for i in range(1, 40)] * 3
    y = [int((i * 7919) % 40 < i % 39 + 1) for i in range(len(p))]
    fit = gates.calibrate(p, y)
    assert isinstance(fit, gates.Calibration) and fit.iterations < 50
    assert gates.calibrate(p, [1] * len(p)) == "calibration_single_class_outcome"
    assert gates.calibrate([Decimal("0.5")] * 4, [0, 1, 0, 1]) == "calibration_degenerate_logit"
    assert gates.calibrate([0.5, 0.6], [0, 1]) == "binary_float_input"
    with pytest.raises(Exception, match="incomplete family"):
        gates.retained_model(spark.createDataFrame([("H_ETH", True)], "name string, passes boolean")).collect()


def test_streaming_bars_equal_batch(spark, tmp_path):
    rows = [(i, f"2024-01-01 {i // 20:02d}:{(i * 3) % 60:02d}:00", ("a", "b")[i % 2], float(i % 9)) for i in range(200)]
    events = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    got = {(r.series, r.open_ms): (r.volume, r.trades) for r in stream.run_available(spark, str(tmp_path / "e")).collect()}
    assert len(got) >= 16
    want = {(r.s, r.t): (r.v, r.n) for r in events.groupBy(F.col("event_type").alias("s"), F.unix_millis(F.date_trunc("hour", "ts")).alias("t")).agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("v"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(want[k] == v for k, v in got.items())
