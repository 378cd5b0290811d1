import datetime as dt

import pytest
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.operators import enrich

T0 = dt.datetime(2024, 1, 1, 10)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture
def tables(spark):
    pos = [(1, at(0), at(0), 7), (2, at(60), at(60), 7), (3, at(30), at(-1), 7), (4, at(61), at(50), 7), (5, at(30), at(30), 8),
           (6, at(45), at(45), 7)]
    pos = [(i, 44.0, 12.0, 1.0, s, d, dev) for i, s, d, dev in pos]
    rental = [(10, 7, 70, at(0), at(60)), (11, 7, 70, at(40), at(50)), (12, 9, 70, at(0), at(60)), (13, 8, 99, at(0), at(60))]
    rental = [(i, dev, u, 44.0, 12.0, 44.1, 12.1, a, b, 3.0) for i, dev, u, a, b in rental]
    return {
        "pos": spark.createDataFrame(pos, S.POS), "rental": spark.createDataFrame(rental, S.RENTAL),
        "usr": spark.createDataFrame([(70, 1.0)], S.USR), "device": spark.createDataFrame([(7, 2.0), (8, 2.5), (9, 3.0)], S.DEVICE),
    }


def pairs(df):
    return sorted((r["rental_id"], r["pos_id"]) for r in df.collect())


def test_bounds_are_inclusive_and_both_clocks_count(tables):
    assert pairs(enrich.merge_positions(**tables)) == [(10, 1), (10, 2), (10, 6), (11, 6)]


@pytest.mark.parametrize("seconds", [60, 3600, 86400 * 30])
def test_bucket_width_does_not_matter(tables, seconds):
    assert pairs(enrich.merge_positions(**tables, bucket_seconds=seconds)) == [(10, 1), (10, 2), (10, 6), (11, 6)]


def test_span_clips_broken_stop_times(tables, spark):
    far = tables["rental"].withColumn("stop_time", F.expr("TIMESTAMP_NTZ '9999-01-01 00:00:00'"))
    got = enrich.merge_positions(tables["pos"], far, tables["usr"], tables["device"],
                                 span=("2024-01-01 00:00:00", "2024-01-02 00:00:00"))
    assert pairs(got) == [(10, 1), (10, 2), (10, 4), (10, 6), (11, 2), (11, 4), (11, 6)]


def test_semi_reduce(tables):
    pos, rental = enrich.semi_reduce(**tables)
    assert sorted(r["id"] for r in rental.collect()) == [10, 11]
    assert sorted(r["id"] for r in pos.collect()) == [1, 2, 3, 4, 6]


def test_dataset_lists_are_ordered_and_split_into_parts(tables):
    merge = enrich.merge_positions(**tables)
    rows = {(r["rental_id"], r["part"]): r["rental_positions"] for r in enrich.build_dataset(merge, part_rows=2).collect()}
    assert rows == {(10, 0): [1, 6], (10, 1): [2], (11, 0): [6]}


def test_dataset_drops_null_attributes(tables):
    merge = enrich.merge_positions(**tables)
    broken = merge.withColumn("usr_km", F.when(F.col("rental_id") == 10, None).otherwise(F.col("usr_km")))
    assert [r["rental_id"] for r in enrich.build_dataset(broken).collect()] == [11]


def test_nesting(tables):
    nested = {r["id"]: [p["pos_id"] for p in r["rental_positions"]] for r in
              enrich.nest_positions(tables["pos"], tables["rental"]).collect()}
    assert nested == {10: [1, 6, 2], 11: [6], 13: [5]}
    inverse = {r["id"]: [p["rental_id"] for p in r["rental"]] for r in
               enrich.nest_rentals(tables["pos"], tables["rental"]).collect()}
    assert inverse == {1: [10], 2: [10], 5: [13], 6: [10, 11]}


def test_conform_adds_and_casts(spark):
    df = S.conform(spark.createDataFrame([("1",)], "id string"), S.DEVICE)
    assert df.dtypes == [("id", "bigint"), ("km", "double")] and df.first() == (1, None)
