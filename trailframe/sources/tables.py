"""Reading raw tables, and storing and reloading generated ones."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailframe import schemas as S

# Fixed value: timestamps in CSV files keep their microseconds.
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_RAW = {"device": S.DEVICE, "pos": S.POS, "rental": S.RENTAL, "usr": S.USR}


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw CSV table. The header is skipped and replaced by the schema; positions may come in several files."""
    paths = [f"{folder.rstrip('/')}/{file}" for file in S.RAW_FILES[name]]
    return spark.read.schema(_RAW[name]).option("header", True).option("enforceSchema", True).csv(paths)


def read_support(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_raw(spark, folder, name) for name in ("device", "rental", "usr")}


def read_all_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {**read_support(spark, folder), "pos": read_raw(spark, folder, "pos")}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", CSV_TIME).csv(path)


def generated_schemas(keys: list[str]) -> dict[str, T.StructType]:
    return {"dataset": S.DATASET, "merge": S.MERGE, "pos": S.POS_GEN, "rental": S.RENTAL,
            "moving_behavior_feature": S.behavior_schema(keys)}


def _location(folder: str, name: str, fmt: str) -> str:
    file = S.GENERATED_FILES[name]
    return f"{folder.rstrip('/')}/{file if fmt == 'csv' else file.removesuffix('.csv')}"


def store_generated(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """Write the non-empty tables and return their names. CSV keeps list columns as JSON text."""
    stored = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        if fmt == "csv":
            lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
            df = df.withColumns({c: F.to_json(c) for c in lists})
            write_csv(df, _location(folder, name, fmt), "overwrite")
        else:
            df.write.mode("overwrite").parquet(_location(folder, name, fmt))
        stored.append(name)
    return stored


def store_checked(df: DataFrame, path: str) -> dict[str, int]:
    """Write ``df`` and return its row count (``rows``) and the nulls of every column, counted while it is written."""
    seen = Observation()
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.mode("overwrite").parquet(path)
    found = seen.get
    return {"rows": found.get("rows", 0), **{c: found.get(f"n{i}", 0) for i, c in enumerate(df.columns)}}


def state_of(tables: Mapping[str, DataFrame], folder: str) -> list[tuple[str, int, bool, bool, list[str]]]:
    """Store the tables; for each (name, rows, is it empty, is any value null, columns with nulls), without a second pass."""
    out = []
    for name, df in tables.items():
        found = store_checked(df, f"{folder.rstrip('/')}/{name}")
        rows = found.pop("rows")
        holes = sorted(c for c, n in found.items() if n)
        out.append((name, rows, rows == 0, bool(holes), holes))
    return out


def load_generated(spark: SparkSession, folder: str, keys: list[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """The five generated tables in their fixed schemas. A missing table is empty, a missing column null."""
    loaded = {}
    for name, schema in generated_schemas(keys).items():
        try:
            if fmt == "csv":
                df = spark.read.option("header", True).csv(_location(folder, name, fmt))
                lists = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, T.ArrayType)}
                df = df.withColumns({c: F.from_json(c, t) for c, t in lists.items() if c in df.columns})
            else:
                df = spark.read.parquet(_location(folder, name, fmt))
            loaded[name] = S.conform(df, schema)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            loaded[name] = spark.createDataFrame([], schema)
    return loaded


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def input_listing(spark: SparkSession, inputs: Sequence[DataFrame]) -> list[list]:
    """(path, length, modification time) of every file that the tables read, in order of path."""
    files = {file for df in inputs for file in df.inputFiles()}
    found = []
    for folder in sorted({file.rsplit("/", 1)[0] for file in files}):
        fs, path = _fs(spark, folder)
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if f"{folder}/{name}" in files:
                found.append([f"{folder}/{name}", status.getLen(), status.getModificationTime()])
    return sorted(found)


def remembered(spark: SparkSession, store: str, name: str, parameters: Mapping[str, object], inputs: Sequence[DataFrame],
               make: Callable[[], DataFrame]) -> DataFrame:
    """The table of an earlier call with equal ``parameters`` and unchanged input files, or a new one.

    Each set of parameters and inputs has a folder of its own. A new table goes to a fresh subfolder and counts only once a
    marker that names it is in place, so a job killed while writing leaves files that nobody reads. Two jobs that make the
    same table at once both end well: the first marker stays.
    """
    key = hashlib.sha256(json.dumps([name, sorted(parameters.items()), input_listing(spark, inputs)], default=str).encode()).hexdigest()
    folder = f"{store.rstrip('/')}/{name}-{key[:32]}"
    fs, marker = _fs(spark, f"{folder}/COMMITTED")
    if not fs.exists(marker):
        fresh = f"data-{uuid.uuid4().hex}"
        make().write.parquet(f"{folder}/{fresh}")
        _, draft = _fs(spark, f"{folder}/draft-{fresh}")
        out = fs.create(draft, False)
        out.write(bytearray(fresh.encode()))
        out.close()
        fs.rename(draft, marker)  # refused where another job's marker is in place
    source = fs.open(marker)
    try:
        chosen = bytes(source.readNBytes(256)).decode()
    finally:
        source.close()
    return spark.read.parquet(f"{folder}/{chosen}")
