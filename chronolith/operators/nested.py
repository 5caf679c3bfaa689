"""Values of nested documents, found by their path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A date of the year that is looked for, in texts.
ISO_YEAR = r"{year}-[0-9]{{2}}-[0-9]{{2}}"


def leaves(docs: DataFrame, json_col: str) -> DataFrame:
    """A row (path, kind, value) for each leaf of the JSON texts of a column.

    Objects and arrays are opened level by level, in parallel over documents;
    texts that are no JSON, and null, have no leaves. Empty objects and arrays
    have none either; a text that is one value has the path ``$``.
    """
    spark = docs.sparkSession
    level = docs.select(F.lit("$").alias("path"), F.try_parse_json(F.col(json_col)).alias("v")).filter("v is not null")
    found = None
    while True:
        kind = F.schema_of_variant("v")
        container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        own = level.filter(~container).select("path", kind.alias("kind"), F.expr("cast(v as string)").alias("value"))
        found = own if found is None else found.union(own)
        inside = level.filter(container)
        if inside.isEmpty():
            return found
        level = spark.sql("select case when e.key is null then concat(l.path, '[', e.pos, ']') else concat(l.path, '.', e.key) end as path, e.value as v from {inside} l, lateral variant_explode(l.v) e", inside=inside)


def value_range(docs: DataFrame, json_col: str, low: int, high: int, year: int | None = None) -> DataFrame:
    """Per path, how many values lie in [low, high): whole numbers, and texts of
    digits; with ``year`` also texts that hold a date of it. Booleans are none."""
    text = F.col("kind") == "STRING"
    number = F.when(F.col("kind").startswith("BIGINT") | (text & F.col("value").rlike("^[0-9]+$")), F.col("value").try_cast("bigint"))
    hit = F.coalesce((number >= low) & (number < high), F.lit(False))
    if year is not None:
        hit = hit | (text & F.col("value").rlike(ISO_YEAR.format(year=year)))
    return leaves(docs, json_col).filter(hit).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"))
