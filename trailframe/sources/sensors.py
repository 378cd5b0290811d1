"""Reading a tree of sensor trial files ``<type>_<number>/sub_<subject>.csv``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailframe import schemas as S
from trailframe.operators.sensors import trial_is_long

# Fixed value: where the trial type, trial number and subject stand in a path.
_PATH = r"([A-Za-z]+)_([0-9]+)/(?:[^/=]+=)?sub_([0-9]+)\.csv"


def read_trials(spark: SparkSession, folder: str) -> DataFrame:
    """All trials of all subjects. The leading index column is dropped, path parts become columns."""
    schema = T.StructType([T.StructField("_index", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in S.SENSOR_COLS])
    raw = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.csv").csv(folder)
    part = lambda i: F.regexp_extract(F.col("_metadata.file_path"), _PATH, i)
    number = part(2).try_cast("int")
    return raw.select(
        *[F.col(f"`{c}`") for c in S.SENSOR_COLS], trial_is_long(number).alias(S.TRIAL_LONG),
        part(3).try_cast("int").alias(S.TRIAL_SUBJECT), part(1).alias(S.TRIAL_TYPE), number.alias("trial number"))


def read_subject_info(spark: SparkSession, path: str) -> DataFrame:
    """Subject attributes; the first column is the subject key."""
    schema = "code int, weight double, height double, age double, gender int"
    return spark.read.schema(schema).option("header", True).csv(path)
