"""Incremental enrichment: new position files joined to static rental, user and device tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trailframe import schemas as S
from trailframe.functions.columns import epoch_micros
from trailframe.operators.enrich import merge_positions
from trailframe.operators.segments import threshold_micros


def position_stream(spark: SparkSession, path: str, fmt: str = "csv", files_per_trigger: int | None = None,
                    schema=S.POS, pattern: str | None = None) -> DataFrame:
    """A stream over a folder of position files; ``files_per_trigger`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def start_ingest(positions: DataFrame, rental: DataFrame, usr: DataFrame, device: DataFrame, target: str,
                 checkpoint: str, sort: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append enriched positions to ``target`` and stop when the present input is used up.

    The join keeps no state; the file sink and its checkpoint make every input file count exactly once. Positions that
    arrive before their rental is in the static table find no match, as in the batch job at that moment.
    """
    merged = merge_positions(positions, rental, usr, device)
    if sort is not None:
        merged = sort(merged)
    return (
        merged.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def segment_stream(pos_gen: DataFrame, threshold: int | float | str) -> DataFrame:
    """(rental_id, id, timedelta_id, time_gap, late) of a stream of enriched positions, cut at a fixed gap.

    Each rental keeps its last row's clocks, id and flag and the number of its segment between micro-batches, five numbers. Rows of
    a micro-batch are taken in the order of ``timedelta``; a row that isn't after the last one of an earlier micro-batch is
    late: it comes out with ``late`` set and without a segment, and changes nothing. Without late rows the result is that of
    ``timedelta`` with the same threshold. A task holds three numbers for each row that one rental has in one micro-batch, which
    ``files_per_trigger`` bounds. Rows with a null clock or id have no place in the order and count as late.
    """
    limit = threshold_micros(threshold)

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # groups are short and many: plain arrays, one table a group
        found = [tuple(part[c].to_numpy() for c in ("server", "device", "id")) for part in parts]
        columns = [np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*found)]
        order = np.lexsort(columns[::-1])
        server, device, ids = (c[order] for c in columns)
        known = ~(np.isnan(server) | np.isnan(device) | np.isnan(ids))
        last = state.get if state.exists else None
        if last is not None:
            known &= (server > last[0]) | ((server == last[0]) & ((device > last[1]) | ((device == last[1]) & (ids > last[2]))))
        segment, gap = np.zeros(len(order), dtype=np.int64), np.zeros(len(order))
        if known.any():
            clocks = np.column_stack([server[known], device[known]]).astype(np.int64)
            before = np.vstack([clocks[:1] if last is None else [last[:2]], clocks[:-1]])
            gaps = clocks - before
            flag = (gaps >= limit).all(axis=1)
            turned = flag != np.concatenate([[flag[0] if last is None else bool(last[3])], flag[:-1]])
            run = (1 if last is None else last[4]) + np.cumsum(turned)
            segment[known], gap[known] = run, (gaps // 1000).sum(axis=1) / 2.0
            state.update((int(clocks[-1, 0]), int(clocks[-1, 1]), int(ids[known][-1]), bool(flag[-1]), int(run[-1])))
        if not known.all():
            ids = pd.Series(ids).astype("Int64").array
            segment, gap = pd.arrays.IntegerArray(segment, ~known), pd.arrays.FloatingArray(gap, ~known)
        yield pd.DataFrame({"rental_id": [key[0]] * len(order), "id": ids, "timedelta_id": segment, "time_gap": gap, "late": ~known})

    narrow = pos_gen.select("rental_id", "id", epoch_micros(F.col("server_time")).alias("server"),
                            epoch_micros(F.col("device_time")).alias("device"))
    return narrow.groupBy("rental_id").applyInPandasWithState(
        advance,
        "rental_id long, id long, timedelta_id long, time_gap double, late boolean",
        "server long, device long, id long, flag boolean, run long", "append", GroupStateTimeout.NoTimeout)


def start_segments(positions: DataFrame, rental: DataFrame, usr: DataFrame, device: DataFrame, threshold: int | float | str,
                   target: str, checkpoint: str) -> StreamingQuery:
    """Append the segments of enriched positions to ``target`` and stop when the present input is used up."""
    merged = S.merge_to_pos_gen(merge_positions(positions, rental, usr, device))
    return (
        segment_stream(merged, threshold).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
