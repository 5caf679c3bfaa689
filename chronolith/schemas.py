"""Fixed schemas, their fingerprints, and the check of what was read back."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

D38 = T.DecimalType(38, 18)

# fixed values: column names and order of the stored tables
IDENTITY = ("provider", "market_type", "instrument_id", "provider_symbol", "base_asset", "quote_asset", "settlement_asset", "contract_type", "interval", "schema_version")


def _fields(spec: str, nullable: bool = False, roles: dict[str, str] | None = None) -> list[T.StructField]:
    kinds = {"s": T.StringType(), "l": T.LongType(), "d": D38, "t": T.TimestampType(), "b": T.ByteType(), "i": T.IntegerType()}
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        optional = kind.endswith("?")
        meta = {"role": roles[name]} if roles and name in roles else {}
        out.append(T.StructField(name, kinds[kind.rstrip("?")], nullable or optional, meta))
    return out


CANONICAL = T.StructType(
    _fields(" ".join(f"{c}:s" for c in IDENTITY))
    + _fields(
        "open_time_utc:t close_time_utc:t nominal_available_time_utc:t open:d high:d low:d close:d base_asset_volume:d quote_asset_volume:d trade_count:l "
        "taker_buy_base_volume:d taker_buy_quote_volume:d source_ignore:s"
    )
)
RESEARCH_ROLES = {"open_time_ms": "index", "f_ret_1": "feature", "f_roc_60": "feature", "f_rvol_20": "feature", "f_volratio_20": "feature", "l_fwdret_24": "label", "l_fwddir_24": "label"}
RESEARCH = T.StructType(_fields("open_time_ms:l f_ret_1:d? f_roc_60:d? f_rvol_20:d? f_volratio_20:d? l_fwdret_24:d? l_fwddir_24:b?", roles=RESEARCH_ROLES))
_SERIES_HEAD = "provider:s venue:s market_type:s instrument_id:s provider_symbol:s series_id:s native_interval:s source_file:s source_sha256:s event_ts:l"
SCALAR_SERIES = T.StructType(
    _fields(
        f"{_SERIES_HEAD} interval_open_ts:l? interval_close_ts:l? settlement_or_snapshot_ts:l archive_publication_ts:l? ingestion_ts:l? eligibility_ts:l quality_flags:s? timestamp_role:s "
        "funding_interval_hours:s? last_funding_rate:d? sum_open_interest:d? sum_open_interest_value:s?"
    )
)
KLINE_SERIES = T.StructType(
    _fields(
        f"{_SERIES_HEAD} interval_open_ts:l interval_close_ts:l settlement_or_snapshot_ts:l? archive_publication_ts:l? ingestion_ts:l? eligibility_ts:l quality_flags:s? timestamp_role:s "
        "open:d high:d low:d close:d volume:d quote_volume:d? trade_count:l? taker_buy_volume:d? taker_buy_quote_volume:d? source_count:l source_ignore:s? volume_semantics:s"
    )
)
GAPS = T.StructType(_fields("series_id:s interval_open_ts:l interval_close_ts:l enumeration_basis:s exclusion_reason:s"))
FOLDS = T.StructType(_fields("fold_id:i train_start:l train_end:l embargo_start:l embargo_end:l test_start:l test_end:l"))


def fingerprint(schema: T.StructType, version: str = "v1") -> str:
    """SHA-256 of the canonical JSON of version, positions, names, types,
    nullability and roles."""
    columns = [{"index": i, "name": f.name, "nullable": f.nullable, "type": f.dataType.simpleString()} | ({"role": f.metadata["role"]} if "role" in f.metadata else {}) for i, f in enumerate(schema)]
    text = json.dumps({"columns": columns, "version": version}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()


class SchemaDrift(ValueError):
    """What is stored does not have the declared columns and types."""


def read_exact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet whose stored columns and types equal ``schema``.

    Reading with a given schema would fill missing columns with nulls, so the
    stored schema is compared first.
    """
    stored = spark.read.parquet(path)
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    have = [(f.name, f.dataType.simpleString()) for f in stored.schema]
    if want != have:
        raise SchemaDrift(f"stored {have}, declared {want}")
    return stored


def write_exact(df: DataFrame, path: str, schema: T.StructType, partition_by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """Write ``df`` in the order and types of ``schema`` (plus partition columns)."""
    columns = [df[f.name].cast(f.dataType).alias(f.name) for f in schema] + [df[c] for c in partition_by]
    writer = df.select(*columns).write.mode(mode).option("compression", "zstd").option("parquet.writer.version", "v2")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
