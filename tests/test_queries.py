import os

import pytest
from oracle_check import connect, mismatch

import __spark_entry__ as driver
from barloom.plans.oracle import ORACLE
from barloom.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    with connect(SF_DIR) as db:
        yield db


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, oracle, name):
    assert mismatch(driver.queries()[name](spark, SF_DIR), oracle, driver.oracle_sql()[name]) is None


def test_zone_independence(new_york, oracle):
    for name in ("candles_1h", "silver_clean", "merge_heal", "pulse_no_data", "bronze_partitions"):
        df = driver.queries()[name](new_york, SF_DIR)
        assert mismatch(df, oracle, driver.oracle_sql()[name]) is None, name


def test_no_join_without_keys(spark):
    stored = {"bronze_scan", "compacted_bronze", "corrupt_files", "silver_scan", "silver_late", "asof_load", "medallion_rejects", "daily_load", "heal_job", "mart_adhoc", "replay_day_range", "stream_candles", "late_repair", "live_pulse", "live_flow", "live_candles", "live_counters", "medallion"}
    for name, query in QUERIES.items():
        if name in stored:
            continue
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_scan_reads_only_what_it_needs(spark):
    plan = driver.queries()["candles_1h"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,0.0)" in plan
    assert "user_id" not in plan
