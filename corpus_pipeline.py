"""A corpus pipeline: rules of quality, near-duplicates, decontamination, mixture, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession

from forecourt.llm import decontaminate, dedup, mixing, quality, sharding
from forecourt.sources import scratch
from workload.registry import query

SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the forest keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return dedup.keep_one(docs, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: file after file, row after row."""
    return mixing.in_order(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard; the slots of a shard follow the mixture, which is the order of ``docs``."""
    return sharding.reshard_in_order(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]

#: Models and components have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialise(stage(spark, docs, sf_dir), name)
    return docs


@query("pipeline", ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
