"""Model table and rate tables: what they write and how their joins are planned."""

import os

from conftest import SF_SMALL

from ontime.plans import catalog
from ontime.plans import driver_tables as dt


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_model_table_writes_the_joined_columns_only(spark):
    found = dt.model_table(spark, SF_SMALL)
    folder = os.path.dirname(found.inputFiles()[0])
    assert "model_table_" in folder
    written = spark.read.parquet(folder)
    assert set(written.columns) == set(dt.trips_raw(spark, SF_SMALL).columns)
    assert not [f for f in found.inputFiles() if "year=" in f]  # no shuffle by year and month
    want = dt.trips(spark, SF_SMALL)
    assert found.dtypes == want.dtypes
    assert found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0


def test_small_rate_tables_are_broadcast_whatever_they_were_counted_from(spark):
    catalog._rates(spark, SF_SMALL)  # counted under the ordinary limit
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, str(16 << 10))  # less than the estimate of the aggregate, more than the tables
    try:
        plan = plan_of(catalog._scored_test(spark, SF_SMALL))
    finally:
        spark.conf.set(key, old)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
