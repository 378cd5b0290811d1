import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import difference, duck

SF = "/root/testdata/sf0.001"
QUICK = ["merge_positions", "dataset_positions", "timedelta_auto", "behavior_features", "profile_positions", "pca_subsets",
         "histogram", "linreg_exact", "spreaddelta", "edgedelta"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_equals_duckdb(spark, name):
    got = queries()[name](spark, SF).toPandas()
    assert difference(got, duck(SF).execute(oracle_sql()[name]).df()) is None
