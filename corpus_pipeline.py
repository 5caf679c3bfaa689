"""The corpus pipeline: documents through filters and a mix to tokens.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and
returns a DataFrame, of the columns of documents in all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronolith.llm import bpe, dedup, jaccard, mixing, quality
from chronolith.llm.common import drop, stage
from chronolith.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return dedup.keep_one(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, five words at 80 per cent, the least id stays."""
    return jaccard.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, none to three times."""
    return mixing.draw(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens and their round trip for every row of the mix."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mix_sources", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

#: The field, the tokenizer and the similarity join are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next;
    what a stage has read goes when its own rows are written."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        drop(*read)
        read = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
