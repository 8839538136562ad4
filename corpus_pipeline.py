"""A corpus pipeline: five stages, each applying one of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's documents. Stages decide by doc_id;
documents without one cannot be addressed and stay until the last stage. All
other columns are carried along whatever their names. Empty input passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm.decontaminate import leaks
from gridtally.llm.jaccard import similar
from gridtally.llm.language import UNKNOWN, label, train
from gridtally.llm.mixing import TEMPER, described, mixed_sample
from gridtally.llm.sharding import op2_byte_shards
from gridtally.llm.tables import table
from gridtally.session import written_once

#: Share of a text's letters that its language must have.
LEAST_SHARE = 0.35


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose key is not among those gone; the columns stay as they are."""
    return docs.join(gone.select(F.col("doc_id").alias("_gone")).distinct(), F.col("doc_id") == F.col("_gone"), "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters, and those in which no language prevails."""
    found = label(docs, train(docs))
    return _without(docs, found.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < LEAST_SHARE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest key of each group of similar ones, and one row of a repeated key."""
    kept = _without(docs, similar(docs).where("doc_id <> class_id"))
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    repeated = written_once(repeated.select("doc_id"), "repeated")
    once = kept.join(repeated.select(F.col("doc_id").alias("_key")), F.col("doc_id") == F.col("_key"), "left_semi")
    return _without(kept, repeated).unionByName(once.dropDuplicates(["doc_id"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return _without(docs, leaks(docs, table(spark, sf_dir, "benchmark")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps a sample whose tokens follow the target shares of source, language and topic."""
    return _without(docs, mixed_sample(described(docs), TEMPER).where("not sampled"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contiguous shards of near equal bytes."""
    return op2_byte_shards(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Two stages learn or estimate what SQL has no form for; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written_once(stage(spark, docs, sf_dir), name)
    return docs
