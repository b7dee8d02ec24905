"""The registered queries: SQL at a small scale, and what their plans must not hold."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
import check
from slate.jobs import QUERIES
from helpers import plan_of

SF = "/root/testdata/sf0.001"
NUMBERED = {"page_numbers", "tier_by_date", "tier_by_version"}
SUMMED = {"unknown_text", "cluster_text"}
CARRIED = {"carried_headers", "sectioned_lines", "log_records"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check.TABLES:
        path = f"{SF}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    text, _, good = check.compare(spark, con, name, SF)
    assert good, text


def test_entry(spark):
    assert entry.entry(spark).count() == 7


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert not re.search(r"NestedLoop|Cartesian|ArrowEvalPython|BatchEvalPython|MapInPandas", plan)
    # Windows only run over one row per partition, or per block of blocks.
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert all("_range" in spec or "_block" in spec for spec in windows)
    assert bool(windows) == (name in NUMBERED | SUMMED | CARRIED)
    # No filter cuts text into lines or parses a clock a second time.
    assert not re.search(r"Filter [^\n]*(split\((?!_line)|try_to_timestamp|gettimestamp)", plan)
    # No table is read whole for a few of its columns.
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert not re.search(r"c_acctbal|s_acctbal|p_retailprice|n_name", schema)
