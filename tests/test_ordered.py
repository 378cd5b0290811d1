import random
import re

import pytest
from pyspark.sql import functions as F

from trailframe.operators import behavior, segments
from trailframe.operators.ordered import Ordered, dense_index, hot_key_rows
from trailframe.operators.profile import exact_quantiles
from trailframe.session import materialize


def _frame(spark, seed=1):
    rng = random.Random(seed)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(1, 6), rng.randrange(50), i, rng.random()) for i in range(300)]
    return spark.createDataFrame(rows, "k long, t long, id long, v double")


def _expected(df):
    pdf = df.toPandas().sort_values(["k", "t", "id"], ignore_index=True)
    g = pdf.groupby("k")
    pdf["prev"], pdf["at"] = g["v"].shift(), g.cumcount()
    pdf["run"], pdf["mean"] = g["v"].cumsum(), g["v"].transform("mean")
    return pdf


def _actual(df):
    ordered = Ordered.open(df, ["k"], ["t", "id"], F.col("t"))
    done = ordered.lag({"prev": "v"}).row_index("at").running_sum({"run": F.col("v")}).group_total({"mean": F.avg("v")})
    return ordered.chunked, done.finish().toPandas().sort_values(["k", "t", "id"], ignore_index=True)


def _same(a, b):
    for c in ("prev", "at", "run", "mean"):
        assert abs(a[c].fillna(-1) - b[c].fillna(-1)).max() < 1e-9, c


def test_plain_window(spark):
    df = _frame(spark)
    chunked, out = _actual(df)
    assert not chunked
    _same(out, _expected(df))


def test_hot_keys_are_chunked_and_equal(spark, hot):
    df = _frame(spark)
    chunked, out = _actual(df)
    assert chunked
    _same(out, _expected(df))


def _work(plan):
    """Nodes of the last plan of a frame that ran."""
    text = plan._jdf.queryExecution().executedPlan().toString()
    return {name: len(re.findall(rf"[ *+:-]{name}[ (]", text)) for name in ("Window", "Sort", "FileScan", "Scan")}


@pytest.mark.parametrize("operator", [segments.timedelta, lambda df: behavior.movement_steps(df, ["rental_id"])])
def test_hot_plans_do_not_double(spark, track, hot, operator):
    """With hot keys every step reads stored rows: no plan holds more than one step's windows and scans."""
    df = materialize(track([(0 if i % 2 else i % 5, 10 * i, 44 + i / 1e4, 12 - i / 1e4) for i in range(200)]), "hot")
    chunked = operator(df)
    work = _work(chunked)
    assert work["Window"] <= 3 and work["FileScan"] <= 3
    spark.conf.unset("trailframe.hot.minRows")
    assert sorted(map(str, chunked.collect())) == sorted(map(str, operator(df).collect()))


def test_hot_chunks_are_bounded(spark, hot):
    ordered = Ordered.open(spark.range(400).select(F.lit(1).alias("k"), "id"), ["k"], ["id"], F.col("id"))
    sizes = [r["count"] for r in ordered.df.groupBy("_chunk").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 20 and sum(sizes) == 400


def test_hot_key_check(spark, hot):
    found, limit = hot_key_rows(_frame(spark), ["k"])
    assert limit == 5 and found.where("k = 0").count() == 1


def test_global_index(spark, hot):
    df = spark.range(57).select((F.col("id") * 7 % 57).alias("x"))
    out = {r["x"]: r["n"] for r in dense_index(df, ["x"], "n", F.col("x")).collect()}
    assert out == {i: i + 1 for i in range(57)}


def test_quantiles_with_hot_group(spark, hot):
    df = _frame(spark, 3).select("k", F.round("v", 1).alias("value"))
    got = {(r["k"], r["q"]): r["quantile"] for r in exact_quantiles(df, ["k"], [0.25, 0.5, 0.9]).collect()}
    for k, g in df.toPandas().groupby("k"):
        for q in (0.25, 0.5, 0.9):
            assert abs(got[(k, q)] - g["value"].quantile(q)) < 1e-12
