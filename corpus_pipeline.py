"""Training corpus from ``documents``: quality, near duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and calls one operator of
``civitas.llm``; ``docs`` is a scan of the Parquet files its predecessor
wrote. All stages but the last return the columns they were given; the last
adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.llm.common import packed, pin, table
from civitas.llm.decontam import drop_contaminated
from civitas.llm.mixing import mix_sources
from civitas.llm.quality import keep_good
from civitas.llm.sharding import shard_rows
from civitas.llm.simhash import keep_one

SHARDS = 24


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality score reaches 0.3."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 3 or fewer differing bits: the smallest doc_id."""
    return keep_one(docs, ngram=3, radius=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of any benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), width=10)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to square-root source weights and shuffled globally."""
    rows = packed(docs, F.col("doc_id"), F.col("source"))
    return mix_sources(rows).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in it; shard sizes differ by at most one row."""
    return shard_rows(docs, SHARDS)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("sharding", sharding),
]

# The classifier is trained and SQL cannot state it; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
