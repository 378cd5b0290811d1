"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of ``documents``; the
last one returns the shard table. Between stages the rows are written to the folder in ``spark.checkpoint.dir`` and read
again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailframe.llm import decontaminate, mixing, quality, sharding, simhash
from trailframe.llm.common import table
from trailframe.session import materialize

#: Share of the tokens that the mixture keeps; no row is repeated.
MIX_FRACTION = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.select_documents(docs, MIX_FRACTION)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: SimHash components, latent retrieval and bin packing aren't SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None
