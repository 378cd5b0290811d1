import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trailframe import schemas as S  # noqa: E402
from trailframe.session import local_session  # noqa: E402

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def track(spark):
    """Build generated positions from (rental_id, seconds, latitude, longitude[, speed]) rows."""

    def make(rows, device_lag=0):
        full = []
        for i, row in enumerate(rows):
            rental, seconds, lat, lon, *speed = row
            at = START + dt.timedelta(seconds=seconds)
            full.append((i, rental, float(lat), float(lon), float(speed[0]) if speed else 0.0, at,
                         at - dt.timedelta(seconds=device_lag)))
        df = spark.createDataFrame(full, "id long, rental_id long, latitude double, longitude double, speed double, "
                                         "server_time timestamp_ntz, device_time timestamp_ntz")
        return S.conform(df, S.POS_GEN)

    return make


@pytest.fixture
def hot(spark):
    """Treat keys of more than a few rows as hot."""
    spark.conf.set("trailframe.hot.minRows", "5")
    spark.conf.set("trailframe.hot.shares", "200")
    yield
    spark.conf.unset("trailframe.hot.minRows")
    spark.conf.unset("trailframe.hot.shares")
