from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import REGISTRY as QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", QUERIES)
def test_sql_reads_supplied_tables_without_row_limits(name):
    assert re.search(r"\b(events|customer|nation)\b", ORACLE[name])
    assert not re.search(r"\b(limit|sample)\b", ORACLE[name], re.IGNORECASE)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["fact_date", "academy_name", "grade_name"]
