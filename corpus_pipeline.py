"""A corpus pipeline: from raw documents to packed training sequences.

Every stage takes a session, the documents its predecessor kept, and the folder of the other tables.  All
but the last return documents with the same columns.

Defined cases: documents with a null or empty text pass all stages and are packed as an end id alone;
texts of any length are read whole; repeated rows are scored and cleaned alike, and the join keeps one
document of each group of near copies; an empty table gives no pieces; further columns are carried along,
whatever their names, up to packing, which returns pieces.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import metric_join, site_spread, swap_packing, templates, toxicity
from hitloom.llm.queries import SEQUENCE_LENGTH, TOKENIZER, documents
from hitloom.llm.workspace import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The counts are of no use here, and must not take the place of columns of that name."""
    of_lines = [c for c in ("n_lines", "n_removed_lines") if c in docs.columns]
    renamed = docs.withColumnsRenamed({c: f"own_{uuid.uuid5(uuid.NAMESPACE_OID, c).hex}" for c in of_lines})
    cleaned = site_spread.remove_boilerplate(renamed).select(renamed.columns).toDF(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return metric_join.one_of_each(docs, metric_join.Similarity(words=5, percent=80))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return swap_packing.pack(docs, public_tokenizers.path(TOKENIZER), 0, SEQUENCE_LENGTH).drop("row")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Classifiers, components and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
