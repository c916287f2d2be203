"""Every registered query against its DuckDB oracle."""

from __future__ import annotations

import re

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    """But for the corpus operators and their pipeline, which have tests of their own where SQL ends."""
    assert set(ORACLES) <= set(QUERIES)
    assert all(re.fullmatch(r"op\d+_\w+|pipeline", name) for name in set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["クローズ会計年度", "案件数", "合計金額合計", "受注金額合計"]
    years = [r[0] for r in got.collect()]
    assert len(years) > 3 and years == sorted(years)
