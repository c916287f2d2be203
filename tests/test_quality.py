from __future__ import annotations

import pytest
from conftest import plan_of, rows

from ankenmart.plans import quality
from ankenmart.plans.quality import KEYS, NOT_NULL, UNIQUE


@pytest.fixture(scope="module")
def users(spark):
    return {"stg_user": spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("c",), (None,), (None,)], "user_id string")}


def test_46_tests():
    assert len(KEYS) == 23


def test_failures_count_null_rows_and_repeated_values(users):
    want = [("stg_user", "user_id", "not_null", 2), ("stg_user", "user_id", "unique", 2)]
    assert rows(quality.run_tests(users)) == want
    assert rows(quality.run_tests(users, NOT_NULL)) == want[:1]
    assert rows(quality.run_tests(users, UNIQUE)) == want[1:]


def test_failing_values_are_listed(users):
    assert rows(quality.failing_values(users["stg_user"], "user_id", UNIQUE)) == [("a", 3), ("c", 2)]
    assert rows(quality.failing_values(users["stg_user"], "user_id", NOT_NULL)) == [(None, 2)]
    with pytest.raises(ValueError, match="unknown test"):
        quality.failing_values(users["stg_user"], "user_id", "other")


def test_empty_table_passes(spark):
    empty = {"stg_user": spark.createDataFrame([], "user_id string")}
    assert [r.failures for r in quality.run_tests(empty).collect()] == [0, 0]


def test_only_headers_without_lines_fail(tables):
    failed = [r for r in quality.run_tests(tables).collect() if r.failures]
    assert [(r.model, r.test, r.failures) for r in failed] == [("fact_opportunity_line_item", "not_null", 27)]


def test_alone_a_test_counts_only_keys_that_can_fail_it(users):
    assert "isnull(user_id" in plan_of(quality.run_tests(users, NOT_NULL))
    assert "isnotnull(user_id" in plan_of(quality.run_tests(users, UNIQUE))
