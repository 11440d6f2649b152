"""Corpus pipeline: raw documents to packed training sequences in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
rows of the documents table with its columns unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recspark.llm import decontaminate, exact_dedup, language, packing, simhash
from recspark.llm.common import stored
from recspark.session import apply_query_conf, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents without a recognisable language go."""
    model = language.train(spark, language.labelled_rows(docs))
    return language.keep_identified(spark, docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the first document of each text stays."""
    return exact_dedup.drop_duplicates(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the first document of each group of near copies stays."""
    return simhash.drop_near_duplicates(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a benchmark window go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_contaminated(spark, docs, benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of at most 2048 tokens and their place in a sequence."""
    return packing.pack(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing_stage),
]

# Language models, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    apply_query_conf(spark)
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
