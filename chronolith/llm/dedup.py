"""Exact deduplication by stateful streaming, in built-in functions only.

The rows of every run are written to a content store, a folder that only grows.
Their digests flow through a Structured Streaming aggregation whose state is
keyed by digest and lives on disk (RocksDB) without watermark or expiry; a later
run with the same state folder goes on from there. A state entry retains the
digest, the stable identifier of the row that stays, the locator of its content
(run and row in the store, and its bytes) and the number of rows seen. Digests
that were hit more than once are checked on the full bytes of all their retained
texts; should two different texts share a digest, its rows are grouped by text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.llm.common import HEAVY_SHARE, Staging, delete, exists, join_groups, shared_dir, text_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Many small state stores on an executor: no blocks are reserved ahead of
#: writing, a commit uploads its changes only, and all share one memory bound.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "192",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
SLIM = "row long, doc_id long, digest string, bytes long, run string"


def digest_of(text: Column, digest_bits: int = 256) -> Column:
    """SHA-256 in lower-case hex; fewer bits only serve to test collisions."""
    return F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, digest_bits // 4)


def store(docs: DataFrame, root: str, run: str, digest_bits: int = 256, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """The rows of ``docs`` as run ``run`` of the content store under ``root``:
    row, doc_id, digest, bytes and doc, a structure of the text or, with
    ``whole``, of all columns. A run that was stored before is not again."""
    spark = docs.sparkSession
    path = f"{root}/content/run={run}"
    if not exists(spark, f"{path}/_SUCCESS"):
        text = text_of(F.col(f"`{text_col}`"))
        kept = [F.col(f"`{c}`") for c in docs.columns] if whole else [text.alias(text_col)]
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), digest_of(text, digest_bits).alias("digest"), F.octet_length(text).cast("long").alias("bytes"), F.struct(*kept).alias("doc"))
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def stream_state(spark: SparkSession, root: str, files_per_batch: int = 256) -> DataFrame:
    """Send what is new in the content store through the keyed state.

    Returns the state after it: digest, keep_id, locator, group_size. The
    largest id stays; of rows that repeat it, the one with the greatest locator.
    A store without rows gives an empty state.
    """
    updates = f"{root}/updates"
    stream = spark.readStream.schema(SLIM).option("maxFilesPerTrigger", files_per_batch).parquet(f"{root}/content")
    best = F.max(F.struct("doc_id", F.struct("run", "row", "bytes").alias("locator")))
    state = stream.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.locator").alias("locator"), "group_size").write.mode("overwrite").option("compression", "zstd").parquet(f"{updates}/batch={number}")

    was = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = state.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(keep).start()
        query.awaitTermination()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = "digest string, keep_id long, locator struct<run:string,row:long,bytes:long>, group_size long, batch long"
    changes = spark.read.schema(schema).parquet(updates) if exists(spark, updates) else spark.createDataFrame([], schema)
    latest = changes.groupBy("digest").agg(F.max_by(F.struct("keep_id", "locator", "group_size"), "batch").alias("last"))
    return latest.select("digest", "last.*")


def collisions(texts: DataFrame, state: DataFrame) -> DataFrame:
    """Digests of ``state`` whose ``texts`` (digest, text) differ in their bytes.

    The least and the greatest text of each hit digest are compared. Digests of
    more than one in ``HEAVY_SHARE`` rows are few, so they are broadcast and
    their texts combined before the shuffle; no other group is large.
    """
    hits = state.filter("group_size > 1").select("digest", "group_size")
    most = state.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0] / HEAVY_SHARE
    heavy, light = hits.filter(F.col("group_size") > most).select("digest"), hits.filter(F.col("group_size") <= most).select("digest")

    def differ(rows: DataFrame) -> DataFrame:
        return rows.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most")).filter("least <> most").select("digest")

    return differ(texts.join(F.broadcast(heavy), "digest", "left_semi")).union(differ(texts.join(light, "digest", "left_semi")))


def _found(docs: DataFrame, own: Staging, root: str, digest_bits: int, run: str | None, files_per_batch: int, id_col: str, text_col: str, whole: bool) -> tuple[DataFrame, DataFrame]:
    """The stored rows of this run, and row, doc_id, keep_id, group_size, kept
    and digest of each."""
    spark, run = docs.sparkSession, run or uuid.uuid4().hex
    content = store(docs, root, run, digest_bits, id_col, text_col, whole)
    table = content.select("row", "doc_id", "digest").withColumn("run", F.lit(run))
    state = own.stage(stream_state(spark, root, files_per_batch), "dedup-groups")
    retained = spark.read.schema(f"digest string, doc_id long, row long, run string, doc struct<`{text_col}`:string>").parquet(f"{root}/content")
    texts = retained.select("run", "row", "doc_id", "digest", text_of(F.col("doc")[text_col]).alias("text"))
    mixed = own.stage(collisions(texts.select("digest", "text"), state), "dedup-collisions")
    joined = join_groups(table, state, "digest", "group_size")
    mine = (F.col("locator.run") == F.col("run")) & (F.col("locator.row") == F.col("row"))
    found = joined.select("row", "doc_id", "keep_id", "group_size", mine.alias("kept"), "digest")
    if not mixed.isEmpty():
        found = found.join(mixed, "digest", "left_anti").unionByName(_by_text(texts.join(mixed, "digest", "left_semi"), run))
    return content, found


def _by_text(texts: DataFrame, run: str) -> DataFrame:
    """The exact way for digests that collide: groups by the whole text."""
    groups = texts.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "run", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    rows = texts.filter(F.col("run") == run).join(groups, ["digest", "text"])
    return rows.select("row", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", ((F.col("best.run") == run) & (F.col("best.row") == F.col("row"))).alias("kept"), "digest")


def _root(spark: SparkSession, state_dir: str | None) -> str:
    return state_dir.rstrip("/") if state_dir else f"{shared_dir(spark)}/chronolith/dedup-state-{uuid.uuid4().hex}"


def deduplicate(docs: DataFrame, digest_bits: int = 256, state_dir: str | None = None, run: str | None = None, files_per_batch: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Of equal texts the row with the largest id stays; of rows that repeat it,
    one stays. With a ``state_dir``, rows of all runs that were given it count:
    a row is kept only if none of an earlier run has a larger id, and sizes are
    those after this run. A run that failed may be repeated under its name
    ``run``. Null texts count as empty, null ids are least; an empty table gives
    an empty result; other columns are ignored, whatever their names.
    """
    root = _root(docs.sparkSession, state_dir)
    with Staging() as own:
        _, found = _found(docs, own, root, digest_bits, run, files_per_batch, id_col, text_col, False)
        result = own.keep(own.stage(found.select("doc_id", "keep_id", "group_size", "kept", "digest"), "dedup-found"))
    if not state_dir:
        delete(docs.sparkSession, root)
    return result


def keep_one(docs: DataFrame, digest_bits: int = 256, state_dir: str | None = None, run: str | None = None, files_per_batch: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`deduplicate` keeps, with all their
    columns, whatever their names: whole rows are stored as one structure."""
    root = _root(docs.sparkSession, state_dir)
    with Staging() as own:
        content, found = _found(docs, own, root, digest_bits, run, files_per_batch, id_col, text_col, True)
        kept = own.stage(found.filter("kept").select("row"), "dedup-kept")
        result = own.keep(own.stage(content.join(kept, "row", "left_semi").select("doc.*"), "dedup-rows"))
    if not state_dir:
        delete(docs.sparkSession, root)
    return result
