"""Reproducible shuffle and sharding by a Feistel permutation.

Every row gets a global row number that depends on its values only, a keyed
Feistel network with cycle walking permutes ``[0, rows)``, and position ``p``
lies in shard ``p % shards`` at slot ``p // shards``. Shard and slot can be
computed from the row number, and the row number from shard and slot, without
any table. Law: ``rows`` (row counts of shards differ by one at most).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolith.llm.common import stage, text_of

#: Value buckets that rows are numbered in. Fixed, as it is part of what makes
#: a row number: more buckets allow more tasks.
BUCKETS = 8192
ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser: two multiply-xorshift steps on ``x + key``."""
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _keys(seed: int) -> list[int]:
    with np.errstate(over="ignore"):
        return [int(_mix(np.array([seed * 1000003 + r], dtype=np.uint64), 0x9E3779B97F4A7C15)[0]) for r in range(ROUNDS)]


def _half_bits(rows: int) -> int:
    return max(1, ((max(rows, 2) - 1).bit_length() + 1) // 2)


def _walk(x: np.ndarray, rows: int, seed: int, inverse: bool) -> np.ndarray:
    bits = np.uint64(_half_bits(rows))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    keys = _keys(seed)
    out = np.asarray(x, dtype=np.uint64).copy()
    if out.size and int(out.max()) >= rows:
        raise ValueError("a row number lies outside the permutation")
    todo = np.arange(out.size)
    with np.errstate(over="ignore"):
        while todo.size:
            left, right = out[todo] >> bits, out[todo] & mask
            for key in reversed(keys) if inverse else keys:
                if inverse:
                    left, right = right ^ (_mix(left, key) & mask), left
                else:
                    left, right = right, left ^ (_mix(right, key) & mask)
            out[todo] = left << bits | right
            todo = todo[out[todo] >= np.uint64(rows)]
    return out.astype(np.int64)


def permute(x: np.ndarray, rows: int, seed: int) -> np.ndarray:
    """Positions of row numbers ``x`` under the permutation of ``[0, rows)``.

    The network permutes a power of four of at most four times ``rows``; a
    value outside ``[0, rows)`` is walked on along its cycle until inside.
    """
    return _walk(x, rows, seed, False)


def unpermute(x: np.ndarray, rows: int, seed: int) -> np.ndarray:
    """Row numbers at positions ``x``; inverts :func:`permute`."""
    return _walk(x, rows, seed, True)


def locate(row_number: int, rows: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    p = int(permute(np.array([row_number]), rows, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int) -> int:
    """Row number that lies in a slot of a shard."""
    return int(unpermute(np.array([slot * shards + shard]), rows, seed)[0])


def number_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``row_number`` from 0 without gaps, from the values of ``order`` alone.

    Rows fall into ``BUCKETS`` value buckets by a hash and are ranked in their
    bucket; bucket sizes, ``BUCKETS`` rows at most, are summed up to offsets.
    Equal rows are interchangeable, so any partitioning gives the same table.
    """
    df = df.withColumn("bucket__", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    before = Window.orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy("bucket__").agg(F.count(F.lit(1)).alias("n__")).select("bucket__", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("offset__"))
    within = Window.partitionBy("bucket__").orderBy(*order)
    ranked = df.withColumn("rank__", F.row_number().over(within))
    return ranked.join(F.broadcast(offsets), "bucket__").withColumn("row_number", F.col("offset__") + F.col("rank__") - 1).drop("bucket__", "offset__", "rank__")


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 20240229, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row of ``docs``; the texts stay where they are.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, row_number, shard,
    slot. Null texts count as empty; null ids are kept and sort first; repeated
    rows each get a slot of their own; an empty table gives an empty result.
    Other columns are ignored.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = text_of(text_col)
    slim = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash__"),
        ),
        "shard-rows",
    )
    rows = slim.count()

    @F.pandas_udf(T.LongType())
    def position(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), rows, seed))

    numbered = number_rows(slim, ["doc_id", "text_crc32", "size", "text_hash__"])
    p = F.col("position__")
    return numbered.withColumn("position__", position("row_number")).select(
        "doc_id", "size", "text_crc32", "row_number", (p % shards).cast("int").alias("shard"), F.floor(p / shards).cast("long").alias("slot")
    )
