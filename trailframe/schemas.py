"""Table schemas and the column lists the public API is built on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _D, _TS, _S = T.LongType(), T.DoubleType(), T.TimestampNTZType(), T.StringType()


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns])


# ---------------------------------------------------------------------------
# Table and column names, sort keys, feature lists, file names.
# They are the public data model and must be spelled exactly like this.
# ---------------------------------------------------------------------------
DEVICE = _schema(("id", _L), ("km", _D))
USR = _schema(("id", _L), ("km", _D))
POS = _schema(
    ("id", _L), ("latitude", _D), ("longitude", _D), ("speed", _D),
    ("server_time", _TS), ("device_time", _TS), ("device_id", _L),
)
RENTAL = _schema(
    ("id", _L), ("device_id", _L), ("user_id", _L),
    ("latitude_start", _D), ("longitude_start", _D), ("latitude_stop", _D), ("longitude_stop", _D),
    ("start_time", _TS), ("stop_time", _TS), ("km", _D),
)
_RENTAL_ATTRIBUTES = (
    ("rental_id", _L), ("device_id", _L), ("device_km", _D), ("user_id", _L), ("usr_km", _D),
    ("latitude_start", _D), ("longitude_start", _D), ("latitude_stop", _D), ("longitude_stop", _D),
    ("start_time", _TS), ("stop_time", _TS), ("rental_km", _D),
)
MERGE = _schema(
    *_RENTAL_ATTRIBUTES,
    ("pos_id", _L), ("latitude", _D), ("longitude", _D), ("speed", _D),
    ("server_time", _TS), ("device_time", _TS),
)
DATASET = _schema(*_RENTAL_ATTRIBUTES, ("rental_positions", T.ArrayType(_L)), ("part", _L))
POS_GEN = _schema(
    ("id", _L), ("rental_id", _L), ("timedelta_id", _L), ("spreaddelta_id", _L), ("edgedelta_id", _L),
    ("coorddelta_id", _L), ("latitude", _D), ("longitude", _D), ("spread_latitude", _D), ("spread_longitude", _D),
    ("edge_latitude_start", _D), ("edge_latitude_stop", _D), ("edge_longitude_start", _D),
    ("edge_longitude_stop", _D), ("speed", _D), ("server_time", _TS), ("device_time", _TS), ("time_gap", _D),
)
DATASET_KEYS = [name for name, _ in _RENTAL_ATTRIBUTES]

RENTAL_TO_MERGE = {"id": "rental_id", "km": "rental_km"}
POS_TO_MERGE = {"id": "pos_id"}
USR_TO_MERGE = {"id": "user_id", "km": "usr_km"}
DEVICE_TO_MERGE = {"id": "device_id", "km": "device_km"}
MERGE_TO_POS = {"pos_id": "id"}

MERGE_SORT = [*DATASET_KEYS, "server_time", "device_time", "pos_id"]
POS_SORT = ["rental_id", "server_time", "device_time", "id"]
RENTAL_SORT = ["id"]

HEURISTIC_IDS = ["timedelta_id", "spreaddelta_id", "edgedelta_id", "coorddelta_id"]
SPREADS = ["spread_latitude", "spread_longitude"]
EDGES = ["edge_latitude_start", "edge_longitude_start", "edge_latitude_stop", "edge_longitude_stop"]
HEURISTIC_COLS = [*HEURISTIC_IDS, *SPREADS, *EDGES, "time_gap"]

CLUSTERING_COLS = [
    "latitude", "longitude", "spread_latitude", "spread_longitude",
    "edge_latitude_start", "edge_latitude_stop", "edge_longitude_start", "edge_longitude_stop",
]
CLUSTERING_SUBSETS = [
    ["latitude"], ["longitude"], ["spread_latitude", "spread_longitude"],
    ["edge_latitude_start", "edge_longitude_start"], ["edge_latitude_stop", "edge_longitude_stop"],
]
CLUSTER_METHODS = ["k-means", "mean-shift", "gaussian-mixture", "full-agglomerative", "ward-agglomerative"]
EXAM_METHODS = ["k-means", "mean-shift", "ward-agglomerative"]

WINDOW_WIDTH = 12
# The two spellings ("quantise" for the speed rate) are part of the published column names.
BEHAVIOR_RATES = {
    "f_delta_latitude": "quantile", "f_delta_longitude": "quantile",
    "f_delta_s": "quantise", "f_delta_r": "quantile",
}
BEHAVIOR_FEATURES = [
    f"{rate}_{stat}"
    for rate, q in BEHAVIOR_RATES.items()
    for stat in ("mean", "max", f"{q}75", f"{q}50", f"{q}25", "min")
]
BEHAVIOR_WINDOW_ID = "moving_window_id"

RAW_FILES = {"device": ["device.csv"], "pos": ["pos.csv", "pos_1.csv"], "rental": ["rental.csv"], "usr": ["usr.csv"]}
GENERATED_FILES = {
    "dataset": "dataset_gen.csv", "merge": "merge_gen.csv", "pos": "pos_gen.csv",
    "rental": "rental_gen.csv", "moving_behavior_feature": "moving_behavior_feature.csv",
}

SENSOR_COLS = [
    "attitude.roll", "attitude.pitch", "attitude.yaw", "gravity.x", "gravity.y", "gravity.z",
    "rotationRate.x", "rotationRate.y", "rotationRate.z", "userAcceleration.x", "userAcceleration.y", "userAcceleration.z",
]
TRIAL_LONG, TRIAL_SUBJECT, TRIAL_TYPE = "is long", "subject", "trial type"
LONG_TRIALS, SHORT_TRIALS = (1, 9), (11, 16)
# ---------------------------------------------------------------------------


def behavior_schema(keys: list[str]) -> T.StructType:
    return _schema(*[(k, _L) for k in keys], (BEHAVIOR_WINDOW_ID, _L), *[(f, _D) for f in BEHAVIOR_FEATURES])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: reorder, cast, and add absent columns as null."""
    have = set(df.columns)
    return df.select([
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def merge_to_pos_gen(merge: DataFrame) -> DataFrame:
    """One generated position row per (rental, position); heuristic columns still null."""
    return conform(merge.withColumnsRenamed(MERGE_TO_POS), POS_GEN)
