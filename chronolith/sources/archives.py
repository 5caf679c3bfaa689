"""Archives and text scans: checksum documents, single-member ZIP files, delimited
rows, object inventories and quarantine."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.functions import parse

# fixed values: limits and column orders of the accepted formats
MOST_BYTES = 256 << 20
MOST_RATIO = 100
KLINE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore")
OHLCVT = ("t", "open", "high", "low", "close", "volume", "trades")
FUNDING = ("calc_time", "funding_interval_hours", "last_funding_rate")
_CHECKSUM = re.compile(r"^([0-9a-f]{64})  (\S+)\r?\n?$")


class SourceError(ValueError):
    """A source that breaks its format; ``error_id`` names how."""

    def __init__(self, error_id: str, detail: str = ""):
        super().__init__(f"{error_id}: {detail}")
        self.error_id = error_id


def parse_checksum(text: str, file_name: str) -> str:
    """The digest of a checksum document that names exactly ``file_name``."""
    m = _CHECKSUM.fullmatch(text)
    if not m or m[2] != file_name:
        raise SourceError("checksum_document_malformed", file_name)
    return m[1]


def verify_digest(data: bytes, digest: str) -> None:
    if hashlib.sha256(data).hexdigest() != digest:
        raise SourceError("checksum_mismatch", digest)


def inspect_zip(data: bytes) -> zipfile.ZipInfo:
    """The only member of an archive; its name must be a plain file name, its
    size and ratio within limits."""
    try:
        members = zipfile.ZipFile(io.BytesIO(data)).infolist()
    except zipfile.BadZipFile as error:
        raise SourceError("archive_corrupt", str(error)) from error
    if len(members) != 1 or members[0].is_dir():
        raise SourceError("archive_member_count", str(len(members)))
    m = members[0]
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", m.filename) or ".." in m.filename:
        raise SourceError("archive_member_name", m.filename)
    if m.file_size > MOST_BYTES or m.file_size > MOST_RATIO * max(m.compress_size, 1):
        raise SourceError("archive_member_size", str(m.file_size))
    return m


def read_member(data: bytes) -> bytes:
    """The member's bytes; a wrong size or CRC is an error."""
    m = inspect_zip(data)
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z, z.open(m) as f:
            out = f.read(m.file_size + 1)
    except zipfile.BadZipFile as error:
        raise SourceError("archive_corrupt", str(error)) from error
    if len(out) != m.file_size:
        raise SourceError("archive_corrupt", "size")
    return out


def scan_zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all archives under ``path``: source_file, source_sha256,
    line_no, line, error. An archive that breaks a rule gives one row with its
    error and no line, for the quarantine. One file is one task's work."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                digest = hashlib.sha256(data).hexdigest()
                try:
                    text = read_member(data).decode("utf-8")
                    if text.startswith("﻿"):
                        raise SourceError("byte_order_mark", name)
                    lines = text.removesuffix("\n").split("\n") if text else []
                    yield pd.DataFrame({"source_file": name, "source_sha256": digest, "line_no": range(len(lines)), "line": [x.removesuffix("\r") for x in lines], "error": None})
                except (SourceError, UnicodeDecodeError) as error:
                    yield pd.DataFrame({"source_file": [name], "source_sha256": [digest], "line_no": [None], "line": [None], "error": [getattr(error, "error_id", "not_utf8")]})

    return files.mapInPandas(run, "source_file string, source_sha256 string, line_no long, line string, error string")


def kline_rows(lines: DataFrame, header: bool, columns: tuple[str, ...] = KLINE) -> DataFrame:
    """Fields of delimited lines with a reason for those that break the policy.

    Blank lines are skipped; with ``header`` the first line of a file must be
    exactly the column names.
    """
    body = lines.filter(F.length("line") > 0)
    names = ",".join(columns)
    if header:
        body = body.withColumn("bad_header", (F.col("line_no") == 0) & (F.col("line") != names)).filter((F.col("line_no") > 0) | F.col("bad_header"))
    else:
        body = body.withColumn("bad_header", F.lit(False))
    fields = F.split("line", ",", -1)
    rows = body.withColumn("fields", fields).select("*", *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    prices = [c for c in columns if c not in ("open_time", "close_time", "t", "count", "trades", "ignore", "calc_time", "funding_interval_hours")]
    # a step of its own, so that each text is expanded once
    rows = rows.withColumns({f"plain_{c}": parse.expand_scientific(F.regexp_replace(c, "^-", "") if c == "last_funding_rate" else F.col(c)) for c in prices})
    bad_price = F.lit(False)
    for c in prices:
        bad_price = bad_price | parse.decimal_reason(F.col(f"plain_{c}")).isNotNull()
    time = columns[0]
    reason = (
        F.when(F.col("bad_header"), "header_mismatch").when(F.contains("line", F.lit('"')), "quoting_not_permitted").when(F.size("fields") != len(columns), "field_count")
        .when(~F.col(time).rlike("^[0-9]+$"), "timestamp_malformed").when(bad_price, "decimal_policy")
    )
    return rows.withColumn("reason", reason).drop("fields", "bad_header", *[f"plain_{c}" for c in prices])


def window_scan(lines: DataFrame, start_ms: int, end_ms: int, step: int) -> DataFrame:
    """Rows whose leading epoch-second field lies in [start, end), by year: rows
    and rows off the grid."""
    t = F.split_part("line", F.lit(","), F.lit(1)).try_cast("bigint") * 1000
    kept = lines.withColumn("t", t).filter((F.col("t") >= start_ms) & (F.col("t") < end_ms))
    return kept.groupBy(F.year(F.timestamp_millis("t")).alias("year")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.pmod("t", F.lit(step)) != 0).alias("off_grid"))


def quarantine(rows: DataFrame, reason: str, path: str) -> DataFrame:
    """Write rejected rows with their reason by reason; return the others."""
    rows.filter(F.col(reason).isNotNull()).write.mode("append").partitionBy(reason).parquet(path)
    return rows.filter(F.col(reason).isNull()).drop(reason)


def inventory(spark: SparkSession, first: str, last: str, cadence: str) -> DataFrame:
    """Periods (period, start_ms, end_ms) of a cadence between two dates."""
    step = {"month": "interval 1 month", "day": "interval 1 day"}[cadence]
    low = f"trunc(date'{first}', 'MM')" if cadence == "month" else f"date'{first}'"
    days = spark.range(1).select(F.explode(F.expr(f"sequence({low}, date'{last}', {step})")).alias("d"))
    after = F.add_months("d", 1) if cadence == "month" else F.date_add("d", 1)
    ms = lambda c: F.unix_millis(c.cast("timestamp"))
    return days.select(F.date_format("d", "yyyy-MM" if cadence == "month" else "yyyy-MM-dd").alias("period"), ms(F.col("d")).alias("start_ms"), ms(after).alias("end_ms"))


def hourly_grid(spark: SparkSession, years: tuple[int, ...]) -> DataFrame:
    """Every hour of calendar years: year, hour_idx, t."""
    start = lambda y: F.unix_millis(F.make_timestamp_ltz(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    ys = spark.range(1).select(F.explode(F.array(*map(F.lit, years))).alias("year"))
    grid = ys.select("year", F.posexplode(F.sequence(start(F.col("year")), start(F.col("year") + 1) - 3_600_000, F.lit(3_600_000).cast("long"))).alias("hour_idx", "t"))
    return grid


def period_bounds(period: Column) -> tuple[Column, Column]:
    """Start and end (epoch ms, half-open) of ``yyyy-MM`` or ``yyyy-MM-dd`` text."""
    day = F.length(period) == 10
    start = F.to_date(F.when(day, period).otherwise(F.concat(period, F.lit("-01"))))
    ms = lambda c: F.unix_millis(c.cast("timestamp"))
    return ms(start), ms(F.when(day, F.date_add(start, 1)).otherwise(F.add_months(start, 1)))
