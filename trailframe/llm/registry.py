"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailframe.llm import chat, decontaminate, language, licenses, linededup, mixing, negatives, pii, quality, secrets, sharding, simhash, whitening
from trailframe.llm.common import table


def _over(name: str):
    def with_operator(operator):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return operator(table(spark, sf_dir, name))

        return query

    return with_operator


_documents, _embeddings = _over("documents"), _over("embeddings")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_hostile(spark, table(spark, sf_dir, "conversations"))
    return chat.digests(chat.format_conversations(turns))


QUERIES = {
    "op1_license_scans": _documents(licenses.scan),
    "op2_sharding": _documents(sharding.assign),
    "op3_pii": _documents(pii.report),
    "op4_quality_rules": _documents(quality.report),
    "op5_language_id": _documents(language.identify),
    "op6_decontamination": op6,
    "op7_simhash": _documents(simhash.near_duplicates),
    "op8_mixing": _documents(mixing.mixture),
    "op9_chat_formatting": op9,
    "op10_line_dedup": _documents(linededup.report),
    "op11_hard_negatives": _embeddings(negatives.hard_negatives),
    "op12_secret_scans": _documents(secrets.scan),
    "op13_embedding_whitening": _embeddings(whitening.whitened_embeddings),
}

ORACLES = {
    "op1_license_scans": licenses.ORACLE,
    "op4_quality_rules": quality.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op9_chat_formatting": chat.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
}
