"""Shared expressions: words, tables, let-bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of ASCII white space; everything else is part of a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    return F.array_remove(F.split(whole(text), SPACE), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")
