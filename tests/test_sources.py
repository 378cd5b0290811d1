import datetime as dt

import pytest
from pyspark.sql import functions as F

from trailframe import schemas as S
from trailframe.operators import enrich, prep, regions, sensors
from trailframe.plans import fixtures, pipeline
from trailframe.sources import sensors as sensor_source
from trailframe.sources import tables
from trailframe.streaming import ingest

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_raw_header_is_replaced(spark, tmp_path):
    for name, line in (("pos.csv", "1,44.5,12.5,3.0,2024-01-01 10:00:00.123456,2024-01-01 09:59:59,7"),
                       ("pos_1.csv", "2,44.5,12.5,,2024-01-01T10:00:00,2024-01-01T09:59:59,7")):
        (tmp_path / name).write_text("pk,lat,lng,v,ts,dts,dev\n" + line + "\n")
    rows = tables.read_raw(spark, str(tmp_path), "pos").orderBy("id").collect()
    assert [r["id"] for r in rows] == [1, 2] and rows[1]["speed"] is None
    assert rows[0]["server_time"] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)


def test_generated_roundtrip(spark, tmp_path):
    made = pipeline.generate(fixtures.tables(spark, SF))
    made["moving_behavior_feature"] = spark.createDataFrame([], S.behavior_schema(["rental_id"]))
    for fmt in ("csv", "parquet"):
        folder = str(tmp_path / fmt)
        assert sorted(tables.store_generated(made, folder, fmt)) == ["dataset", "merge", "pos", "rental"]
        back = tables.load_generated(spark, folder, ["rental_id"], fmt)
        assert same(back["merge"], made["merge"]) and back["moving_behavior_feature"].isEmpty()
        assert same(back["dataset"], made["dataset"])
        assert back["pos"].schema.names == S.POS_GEN.names


def test_parts_of_long_rentals_come_back_in_order(spark, tmp_path):
    merge = pipeline.generate(fixtures.tables(spark, SF))["merge"]
    parts = enrich.build_dataset(merge, part_rows=10)
    tables.store_generated({"dataset": parts}, str(tmp_path), "csv")
    back = tables.load_generated(spark, str(tmp_path), ["rental_id"], "csv")["dataset"]
    assert same(back, parts) and back.where("part > 0").count() > 0 and back.where("size(rental_positions) > 10").isEmpty()


def test_remembered_computes_once(spark, tmp_path):
    calls, store, source = [], str(tmp_path / "kept"), str(tmp_path / "in")
    spark.range(3).write.parquet(source)

    def kept(rows):
        def make():
            calls.append(rows)
            return spark.range(rows)

        return tables.remembered(spark, store, "numbers", {"rows": rows}, [spark.read.parquet(source)], make).count()

    assert [kept(3), kept(3), kept(5)] == [3, 3, 5] and calls == [3, 5]
    spark.range(4).write.mode("append").parquet(source)  # other input files
    assert kept(3) == 3 and calls == [3, 5, 3]


def test_a_half_written_table_is_never_read(spark, tmp_path):
    store = str(tmp_path / "kept")

    def killed():
        folder = next((tmp_path / "kept").iterdir()) if (tmp_path / "kept").exists() else None
        assert folder is None
        return spark.range(2).select(F.raise_error(F.lit("killed")).alias("id"))

    with pytest.raises(Exception, match="killed"):
        tables.remembered(spark, store, "numbers", {}, [], killed)
    for folder in (tmp_path / "kept").iterdir():
        spark.range(1).write.parquet(str(folder / "data-left"))  # complete, but no marker names it
    assert tables.remembered(spark, store, "numbers", {}, [], lambda: spark.range(7)).count() == 7


def test_state_is_observed_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    found = tables.state_of({"some": df, "none": df.where("a > 5"), "full": df.where("a = 2")}, str(tmp_path))
    assert found == [("some", 3, False, True, ["a", "b"]), ("none", 0, True, False, []), ("full", 1, False, False, [])]


def test_dyadic_blocks(spark):
    cases = [(a, b) for a in range(-9, 12) for b in range(a, 14)] + [(19_700, 2_932_896), (-5, -5), (0, 2**31 - 1)]
    df = spark.createDataFrame(cases, "a long, b long")
    for a, b, blocks in df.select("a", "b", enrich.dyadic_blocks(F.col("a"), F.col("b"))).collect():
        assert len(blocks) < 64
        spans = sorted((x["block"] << x["level"], (x["block"] + 1) << x["level"]) for x in blocks)
        assert spans[0][0] == a and spans[-1][1] == b + 1
        assert all(before[1] == after[0] for before, after in zip(spans, spans[1:]))


def test_dyadic_join_equals_daily_join(spark):
    made = fixtures.tables(spark, SF)
    far = F.when(F.col("id") % 4 == 1, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("stop_time"))
    rentals = made["rental"].withColumn("stop_time", far).withColumnRenamed("id", "rental_id").select("rental_id", "device_id", "start_time", "stop_time")
    pairs = lambda dyadic: enrich.interval_join(made["pos"], rentals, dyadic=dyadic).select("rental_id", "pos_id")
    assert same(pairs(True), pairs(False)) and pairs(True).count() > 0
    assert enrich.interval_join(made["pos"], rentals.limit(0), dyadic=True).count() == 0


def test_looked_up_positions_are_not_broadcast(spark, capsys):
    """Rentals until the year 9999 make few look-ups, and the multiplied positions aren't sent to every task."""
    made = fixtures.tables(spark, SF)
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    rentals = made["rental"].withColumn("stop_time", far).withColumnRenamed("id", "rental_id").select("rental_id", "device_id", "start_time", "stop_time")
    joined = enrich.interval_join(made["pos"], rentals, dyadic=True)
    joined.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert plan.count("shiftright") <= 2 * enrich.RANGE_LEVEL
    assert same(joined.select("rental_id", "pos_id"), enrich.interval_join(made["pos"], rentals, dyadic=False).select("rental_id", "pos_id"))


def test_late_rows_of_a_stream_have_no_segment(spark, tmp_path):
    schema = "rental_id long, id long, server_time timestamp_ntz, device_time timestamp_ntz"
    at = lambda minute: START + dt.timedelta(minutes=minute)
    batches = [[(1, 1, at(0), at(0)), (1, 2, at(1), at(1))], [(1, 3, at(30), at(30)), (2, 4, at(0), at(0)), (1, 5, at(0.5), at(0.5))],
               [(1, 6, at(31), at(31)), (1, 7, None, at(40)), (2, 8, at(60), at(0))]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.position_stream(spark, str(tmp_path / "in"), "parquet", 1, schema)
    ingest.segment_stream(stream, "10 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    found = {r["id"]: (r["timedelta_id"], r["late"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {1: (1, False), 2: (1, False), 3: (2, False), 4: (1, False), 5: (None, True), 6: (3, False), 7: (None, True), 8: (1, False)}


def test_stream_equals_batch(spark, tmp_path):
    made = fixtures.tables(spark, SF)
    for i in range(3):
        tables.write_csv(made["pos"].where(F.col("id") % 3 == i).coalesce(1), str(tmp_path / "in" / f"p{i}"))
    stream = ingest.position_stream(spark, str(tmp_path / "in" / "*"), files_per_trigger=1)
    ingest.start_ingest(stream, made["rental"], made["usr"], made["device"], str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert same(spark.read.schema(S.MERGE).parquet(str(tmp_path / "out")), enrich.merge_positions(**made))


def test_sensor_tree(spark, tmp_path):
    for folder, subject in (("dws_1", 1), ("dws_11", 2), ("wlk_10", 1)):
        (tmp_path / "data" / folder).mkdir(parents=True)
        header = ",".join(["", *S.SENSOR_COLS])
        (tmp_path / "data" / folder / f"sub_{subject}.csv").write_text(header + "\n0," + ",".join(["0.5"] * 12) + "\n")
    (tmp_path / "info.csv").write_text("code,weight,height,age,gender\n1,102,188,46,1\n")
    trials = sensor_source.read_trials(spark, str(tmp_path / "data"))
    got = {(r["trial type"], r["trial number"]): (r["is long"], r["subject"]) for r in trials.collect()}
    assert got == {("dws", 1): (True, 1), ("dws", 11): (False, 2), ("wlk", 10): (None, 1)}
    joined = sensors.with_subject_info(trials, sensor_source.read_subject_info(spark, str(tmp_path / "info.csv")))
    assert joined.count() == 2 and "code" not in joined.columns
    mask = spark.createDataFrame([("dws", 1, 1), ("dws", 11, 1), ("wlk", 10, 1)], "`trial type` string, `trial number` int, subject int")
    assert sensors.select_subjects(trials, mask).count() == 2
    assert sensors.select_subjects(trials, mask.limit(0)).count() == 0


def test_regions(spark):
    rows = [(44.2, 12.2), (43.8, 8.9), (42.7, 13.9), (42.5, 11.8), (44.2, 11.0), (44.3, 12.2), (42.5, 13.0), (43.0, 12.0)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    got = [r["region"] for r in df.select(regions.region().alias("region")).collect()]
    assert got == ["N-E", "N-W", "S-E", "S-W", None, None, "S-E", "N-E"]
    assert regions.with_region(df, only_north=True).count() == 3


def test_pipeline_with_everything(spark):
    out = pipeline.run(spark, fixtures.tables(spark, SF), pipeline.Options(
        group_on_timedelta=False, clustering=True, n_clusters=2, bandwidth=1.0, with_pca=True, with_standardization=True,
        exam=True, behavior=True, profiles=True))
    assert out["pos"].where("timedelta_id is null or coorddelta_id is null").isEmpty()
    assert {r["method"] for r in out["clusters"].select("method").distinct().collect()} == set(S.EXAM_METHODS)
    assert not out["moving_behavior_feature"].isEmpty() and not out["region_profile"].isEmpty()


def test_segment_keys_to_the_last_round(spark):
    """The default two-column key: every segment gets an id of every grouping."""
    pos = pipeline.generate(fixtures.tables(spark, SF))["pos"].where("rental_id < 12")
    out = pipeline.heuristics(pos, pipeline.Options())
    assert out.where("timedelta_id < 1 or spreaddelta_id < 1 or edgedelta_id < 1 or coorddelta_id < 1").isEmpty()
    for name in ("spreaddelta_id", "edgedelta_id", "coorddelta_id"):
        assert out.groupBy("rental_id", "timedelta_id").agg(F.countDistinct(name).alias("n")).where("n <> 1").isEmpty()


def test_clustering_without_heuristics_is_refused(spark):
    with pytest.raises(ValueError):
        pipeline.run(spark, fixtures.tables(spark, SF), pipeline.Options(heuristic=False, clustering=True, n_clusters=2))


def test_rows_without_a_segment_stay(spark):
    made = pipeline.generate(fixtures.tables(spark, SF))
    ready = prep.prepare(made["merge"], made["pos"])
    assert ready.count() == regions.filter_positions(made["merge"]).count()
    assert ready.where("timedelta_id is not null").isEmpty()


def test_far_stop_times_do_not_multiply_rentals(spark):
    made = fixtures.tables(spark, SF)
    far = made["rental"].withColumn("stop_time", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    spread = enrich.interval_join(made["pos"], far.withColumnRenamed("id", "rental_id"))
    assert spread.count() > 0
    low, high = enrich._days(made["pos"], 86400).first()
    assert high - low < 40
