"""What the operators of this subpackage share: tables, staging and words."""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.session import shared_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Shuffle files of a staged table's plan go when it has been written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in the lineage
    that survives lost executors. :func:`drop` deletes the table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/chronolith/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that it lies in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        delete(table.sparkSession, table.staged_at)


class Staging:
    """The staged tables of one run: those that are not kept go at its end.

    ``with Staging() as own: ... own.stage(df, name) ... own.keep(table)``
    """

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *failure) -> None:
        drop(*self.tables)
        self.tables = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stage(df, name))
        return self.tables[-1]

    def keep(self, table: DataFrame) -> DataFrame:
        """``table`` stays, for what is read from it later."""
        self.tables = [t for t in self.tables if t is not table]
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self.keep(table)
            drop(table)


#: A key is heavy that holds more than one in this many rows; so there are at
#: most this many heavy keys.
HEAVY_SHARE = 2000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the one row that ``groups`` has for their key; ``size`` is
    the rows of that key. Heavy keys are joined by broadcast, before any shuffle,
    so the rows of no large group meet in one task."""
    most = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] / HEAVY_SHARE
    heavy, light = groups.filter(F.col(size) > most), groups.filter(F.col(size) <= most)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return rows.join(F.broadcast(heavy), key).unionByName(rest.join(light, key))


def worker_cache(name: str, make):
    """An object kept for the life of a Python worker, not of a task."""
    kept = sys.__dict__.setdefault("_chronolith_cache", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def worker_slot(name: str, key: str, make):
    """Like :func:`worker_cache`, but only the object of the last ``key`` is kept."""
    kept = sys.__dict__.setdefault("_chronolith_cache", {})
    if kept.get(name, (None,))[0] != key:
        kept[name] = (key, make())
    return kept[name][1]


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
