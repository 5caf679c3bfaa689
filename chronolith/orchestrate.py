"""Backfill over periods, and the guarded path from expectations to publication."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolith import identity
from chronolith.operators import quality as QE
from chronolith.publish import PublicationError, Store

EXIT_CODES = {"PUBLISHED": 0, "VERIFIED_NO_OP": 0, "QUALITY_BLOCKED": 2, "REJECTED": 3, "FAILED": 4}
MOST_THREADS = 4


def first_unpublished(periods: Iterable[str], store: Store, series: str) -> str | None:
    return next((p for p in periods if store.current(f"{series}/{p}") is None), None)


def backfill(periods: list[str], run: Callable[[str], str], threads: int = 1) -> dict[str, str]:
    """Run periods side by side until one does not publish; later ones are not
    begun then. Each thread drives Spark jobs of its own."""
    if not 1 <= threads <= MOST_THREADS:
        raise ValueError(f"threads must lie in 1..{MOST_THREADS}")
    results: dict[str, str] = {}
    todo = iter(periods)
    with ThreadPoolExecutor(threads) as pool:
        running = {pool.submit(run, p): p for _, p in zip(range(threads), todo, strict=False)}
        stopped = False
        while running:
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                period = running.pop(future)
                results[period] = "FAILED" if future.exception() else future.result()
                stopped = stopped or EXIT_CODES[results[period]] != 0
                if not stopped and (following := next(todo, None)) is not None:
                    running[pool.submit(run, following)] = following
    return results


def _reconcile(spark: SparkSession, data: str, content: str, schema: T.StructType, dataset: str, order: list[str]) -> None:
    """Raise if the table at ``data`` has not the digest ``content``."""
    stored = spark.read.parquet(data).select(*[f.name for f in schema])
    if identity.content_hash(stored, schema, f"{dataset}/content/v1", order) != content:
        raise PublicationError(f"stored table differs: {data}")


def verify_table(spark: SparkSession, schema: T.StructType, order: list[str], dataset: str, store: Store) -> dict:
    """The current commit's manifest, after marker, objects, parents and the
    digest of the table itself were checked."""
    commit = store.current(dataset)
    if commit is None:
        raise PublicationError(f"nothing is published: {dataset}")
    manifest = store.verify(commit)
    _reconcile(spark, manifest["path"], manifest["content_sha256"], schema, dataset, order)
    return manifest


def terminal_states(outcomes: DataFrame) -> DataFrame:
    """How often each terminal ``state`` stands among outcomes."""
    return outcomes.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def publish_table(df: DataFrame, schema: T.StructType, findings: DataFrame, order: list[str], dataset: str, path: str, store: Store, parents: list[str] | None = None) -> str:
    """Publish a table if its expectations pass: data as Parquet in a folder of
    ``path`` named by the commit, findings and manifest in the store.

    The data are read back and must have the content's digest before the commit
    exists, and the current pointer moves last, so that a crash leaves the last
    commit and its data as they were. Warnings and failures block.
    """
    state = QE.state(findings).first()["state"]
    rows = [r.asDict() for r in findings.orderBy("check_id").collect()]
    if state != "PASS":
        store.attempt(dataset.replace("/", "_"), "QUALITY_BLOCKED", {"state": state})
        return "QUALITY_BLOCKED"
    content = identity.content_hash(df, schema, f"{dataset}/content/v1", order)
    commit = identity.commit_id(f"{dataset}/commit/v1", content, {"parents": parents or []})
    data = f"{path}/commit={commit}"
    if store.current(dataset) != commit:
        df.write.mode("overwrite").option("compression", "zstd").parquet(data)
    _reconcile(df.sparkSession, data, content, schema, dataset, order)
    report = store.put_object(identity.canonical_json(rows))
    result = store.publish(commit, {"content_sha256": content, "dataset": dataset, "objects": [report], "parents": parents or [], "path": data})
    store.set_current(dataset, commit)
    store.attempt(dataset.replace("/", "_"), result, {"commit": commit})
    return result
