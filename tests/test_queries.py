"""Every registered query on the smallest tables, against its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences, duckdb_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
# Weeks without sales make the smallest scale's MAPE too large to compare by rounding.
OTHER_DIR = {"ts_compare": "/root/testdata/sf0.01"}
SLOW = {"clu_find_k", "mdl_compare"}  # covered by tests of their parts


@pytest.fixture(scope="module")
def con():
    return {folder: connect(folder) for folder in {SF_DIR, *OTHER_DIR.values()}}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    folder = OTHER_DIR.get(name, SF_DIR)
    mine = spark_rows(entry.queries()[name](spark, folder))
    assert differences(mine, duckdb_rows(con[folder], entry.oracle_sql()[name])) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_runs_without_sql(spark, name):
    table = entry.queries()[name](spark, SF_DIR)
    assert len(table.collect()) > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = {r["segment"]: r for r in entry.entry(spark).collect()}
    assert rows["All"]["customers"] == sum(r["customers"] for s, r in rows.items() if s != "All")
