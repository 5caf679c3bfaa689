"""Content identity: canonical JSON, row rendering, digests and commit ids."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolith.schemas import fingerprint


def canonical_json(value) -> bytes:
    """JSON with sorted keys and no spaces; binary floats and odd keys are refused.

    Keys sort by UTF-16 code units, as the interchange form of JSON asks.
    """
    def plain(x) -> str:
        if x is None or isinstance(x, bool | str):
            return json.dumps(x, ensure_ascii=False)
        if isinstance(x, int):
            if abs(x) > 2**53 - 1:
                raise ValueError("an integer beyond what JSON readers keep exactly")
            return str(x)
        if isinstance(x, list | tuple):
            return f"[{','.join(map(plain, x))}]"
        if isinstance(x, dict):
            if not all(isinstance(k, str) for k in x):
                raise TypeError("keys must be text")
            return "{" + ",".join(f"{plain(k)}:{plain(x[k])}" for k in sorted(x, key=lambda k: k.encode("utf-16-be"))) + "}"
        raise TypeError(f"{type(x).__name__} has no canonical form")

    return plain(value).encode()


def row_json(schema: T.StructType) -> Column:
    """A row as a JSON array: decimals as plain text of their scale, timestamps
    as epoch ms. Rendered by built-ins, so rows never leave the JVM."""
    def part(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            text = F.unix_millis(c).cast("string")
        elif isinstance(f.dataType, T.DecimalType | T.StringType):
            quoted = F.regexp_replace(F.to_json(F.struct(c.cast("string").alias("v"))), r'(?s)^\{"v":(.*)\}$', "$1")
            text = F.when(c.isNotNull(), quoted)
        else:
            text = c.cast("string")
        return F.coalesce(text, F.lit("null"))

    return F.concat(F.lit("["), F.concat_ws(",", *map(part, schema)), F.lit("]"))


def content_hash(df: DataFrame, schema: T.StructType, domain: str, order: list[str]) -> str:
    """Digest of domain, schema and rows in order. The chain is sequential, so
    rows stream to the driver partition by partition in bounded memory."""
    h = hashlib.sha256(domain.encode() + b"\0" + fingerprint(schema).encode() + b"\n")
    for row in df.orderBy(*order).select(row_json(schema).alias("r")).toLocalIterator(prefetchPartitions=True):
        h.update(row["r"].encode() + b"\n")
    return h.hexdigest()


def multiset_hash(df: DataFrame, schema: T.StructType, domain: str) -> str:
    """An order-free digest of the same rows for tables beyond one chain: four
    64-bit words of each row's digest are summed in parallel."""
    digest = F.sha2(F.encode(row_json(schema), "UTF-8"), 256)
    words = [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 10).cast("decimal(38,0)") for i in range(4)]
    sums = df.agg(F.count(F.lit(1)), *[F.sum(w) for w in words]).first()
    text = "|".join([domain, fingerprint(schema), *(str(int(x or 0) % 2**64) for x in sums)])
    return hashlib.sha256(text.encode()).hexdigest()


def commit_id(domain: str, content: str, lineage: dict) -> str:
    return hashlib.sha256(f"{domain}\0{content}\n".encode() + canonical_json(lineage)).hexdigest()


def artifact_hash(domain: str, schema_fingerprint: str, data: bytes) -> str:
    return hashlib.sha256(f"{domain}\0{schema_fingerprint}\n".encode() + data).hexdigest()


def finding_digest(finding: dict) -> str:
    return hashlib.sha256(canonical_json(finding)).hexdigest()


def quality_identity(findings: list[dict]) -> str:
    return hashlib.sha256(canonical_json(sorted(findings, key=lambda f: f["check_id"]))).hexdigest()
