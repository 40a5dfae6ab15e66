"""Every registered query against its SQL, over the whole test tables."""

import pytest

import __spark_entry__ as contract
from compare import check
from tideline.plans.oracles import ORACLES
from tideline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert check(spark, name, SF) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_results_do_not_depend_on_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("session_metrics", "partition_paths", "sessions_per_minute", "dedupe_job"):
            check(spark, name, SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
