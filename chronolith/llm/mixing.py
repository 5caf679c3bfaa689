"""Mixing sources to target weights, in built-in functions only.

Every row gets an Efraimidis-Spirakis key, ``-ln(u) / w``: ``u`` is a hash of
seed and id, ``w`` the quality weight of the document. A source's target takes
complete epochs first; what is left selects rows in the order of their keys up
to the budget, the nearest whole row at its end. That order is summed by key
range, and row by row only in the range in which the budget ends, so a source
is taken up to one place in the order, which every row can compare itself with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.llm.common import WORD, Staging, stage, text_of

#: Sources by code point weigh so, repeating.
WEIGHTS = (5, 2, 1)
#: Times its size that a source may be taken at most.
MOST_EPOCHS = 3
#: Key ranges of a source that are summed and sorted apart from one another.
BUCKETS = 1024
SYMBOLS = "#*$%&|<>!"
LEAST_QUALITY = 0.1
#: Sources whose plan is broadcast at most; beyond it the join is shuffled.
BROADCAST_SOURCES = 10_000


def quality_weight(text: Column) -> Column:
    """1 without symbols, less by twice their share, ``LEAST_QUALITY`` at least."""
    chars = F.length(text)
    share = (chars - F.length(F.translate(text, SYMBOLS, ""))) / F.greatest(chars, F.lit(1))
    return F.greatest(F.lit(LEAST_QUALITY), 1.0 - 2.0 * share)


def measure(docs: DataFrame, seed: int = 7, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """What the mix needs of every row: row (apart from rows that repeat it),
    doc_id, source, size (words), key (the sampling key), bucket (its range)
    and, with ``whole``, doc, a structure of all columns of ``docs``."""
    name = lambda c: F.col(f"`{c}`")
    text = text_of(name(text_col))
    digits = F.substring(F.md5(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(name(id_col).cast("string"), F.lit("null"))), "UTF-8")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(2**52)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), name(id_col).alias("doc_id"), name(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.ln(u) / quality_weight(text)).alias("key"), *([F.struct(*map(name, docs.columns)).alias("doc")] if whole else []),
    )
    return rows.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"source__": F.coalesce(F.col("source").cast("string"), F.lit("")), "null__": F.col("source").isNull()})


def _order() -> Column:
    """A row's place in its source: key, id, size, and what tells rows apart."""
    return F.struct("key", "doc_id", "size", "row")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Targets of sources, from a row (source__, null__, source_size) for each.

    The sum of all sizes is shared by weight; a source stops at ``most`` times
    its size, and the excess goes to the others by weight until none is above.
    That level is found at once: in the order of cap over weight the sources
    that stop are the first ones. There is one row for each source here.
    """
    by_name = Window.orderBy("null__", "source__")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    everything = Window.partitionBy()
    caps = sizes.withColumn("weight", weight.cast("double")).withColumns({"cap__": F.col("source_size") * most, "total__": F.sum("source_size").over(everything)})
    order = Window.orderBy(F.col("cap__") / F.col("weight"), "null__", "source__")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total__") - F.coalesce(F.sum("cap__").over(before), F.lit(0))) / F.sum("weight").over(rest)
    leveled = caps.withColumn("level__", level).withColumn("stops__", F.col("cap__") <= F.col("level__") * F.col("weight"))
    shared = F.max(F.when(~F.col("stops__"), F.col("level__"))).over(everything)
    return leveled.withColumn("shared__", shared).select(
        "source__", "null__", "source_size", "weight", F.when(F.col("stops__"), F.col("cap__").cast("double")).otherwise(F.col("shared__") * F.col("weight")).alias("target")
    )


def plans(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """A row for each source of a staged :func:`measure`: source__, null__,
    source_size, target, epochs, and last_bucket and last, the range in which
    the budget ends and the place of the last row there that is taken."""
    rows = _named(measured)
    source = ["source__", "null__"]
    sums = rows.groupBy(*source, "bucket").agg(F.sum("size").alias("bucket_size"))
    with Staging() as own:
        sums = own.stage(sums, "mix-sums")
        goals = targets(sums.groupBy(*source).agg(F.sum("bucket_size").alias("source_size")), weights, most).drop("weight")
        epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
        goals = goals.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        before = Window.partitionBy(*source).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        ends = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).join(goals, source).filter(F.col("offset") + F.col("bucket_size") > F.col("rest"))
        ends = own.stage(ends.groupBy(*source, "source_size", "target", "epochs", "rest").agg(F.min(F.struct("bucket", "offset")).alias("end")).select(*source, "source_size", "target", "epochs", "rest", F.col("end.bucket").alias("last_bucket"), F.col("end.offset").alias("offset")), "mix-ends")
        # one range of a source holds about one in BUCKETS of its rows
        inside = rows.join(ends.select(*source, F.col("last_bucket").alias("bucket"), "offset", "rest"), [*source, "bucket"])
        within = Window.partitionBy(*source).orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
        after = F.col("offset") + F.sum("size").over(within)
        last = inside.select(*source, "rest", "size", _order().alias("place"), after.alias("after")).filter((F.col("rest") > 0) & (2 * F.col("rest") >= 2 * F.col("after") - F.col("size"))).groupBy(*source).agg(F.max("place").alias("last"))
        none = goals.join(ends.select(*source), source, "left_anti").withColumn("last_bucket", F.lit(-1))  # sources without words
        both = ends.drop("offset").unionByName(none.select(*source, "source_size", "target", "epochs", "rest", "last_bucket"))
        return own.keep(own.stage(both.join(last, source, "left"), "mix-plan"))


def mix(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Rows of a staged :func:`measure` with source_size, target, copies, taken.

    ``copies`` is how often the mix takes the row, ``taken`` its words times
    that. Null texts have size 0 and are taken with the epochs; a null source
    is the last one; ties of the key go by id, size and row, so that of rows
    which repeat each other as many are taken as the budget holds; an empty
    table gives an empty result.
    """
    plan = plans(measured, weights, most)
    few = plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rows = _named(measured).join(F.broadcast(plan) if few else plan, ["source__", "null__"])
    chosen = (F.col("rest") > 0) & ((F.col("bucket") < F.col("last_bucket")) | ((F.col("bucket") == F.col("last_bucket")) & F.coalesce(_order() <= F.col("last"), F.lit(False))))
    copies = F.col("epochs") + F.when(chosen, 1).otherwise(0)
    return rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop("source__", "null__", "bucket", "epochs", "rest", "last_bucket", "last", "key")


def draw(docs: DataFrame, seed: int = 7, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **shares) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with all their columns,
    whatever their names: whole rows are staged as one structure beside what
    the mix needs, and are neither shuffled nor sorted."""
    measured = stage(measure(docs, seed, source_col, id_col, text_col, whole=True), "mix-rows")
    return mix(measured, **shares).filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")
