from __future__ import annotations

import shutil

import pytest
from conftest import SF_DIR, plan_of, rows
from pyspark.sql import functions as F

from ankenmart.plans import key_state, quality
from ankenmart.plans.key_state import KeyFiles, run_new_tests
from ankenmart.plans.staging import staging_layer
from ankenmart.sources.raw import parquet_source
from fixtures.crm import write_raw


@pytest.fixture
def read(monkeypatch):
    """The files each run reads."""
    seen = []
    plain = key_state._added

    def noted(spark, models, fresh):
        seen.append(sorted(f.path.rpartition("/")[2] for f in fresh))
        return plain(spark, models, fresh)

    monkeypatch.setattr(key_state, "_added", noted)
    return seen


def test_only_new_files_are_read(spark, tmp_path, read):
    raw, state = write_raw(spark, SF_DIR, str(tmp_path / "raw"), 2), str(tmp_path / "state")
    models = key_state.staging_files(raw)
    whole = lambda: rows(quality.run_tests(staging_layer(parquet_source(spark, raw))))
    run = lambda: rows(run_new_tests(spark, models, state, buckets=4))
    assert run() == whole() and len(read) == 1
    assert run() == whole() and len(read) == 1

    more = spark.read.parquet(f"{raw}/account").limit(5).unionByName(spark.read.parquet(f"{raw}/account").limit(3).withColumns({"Id": F.lit(None).cast("string"), "IsDeleted": F.lit(False)}))
    more.coalesce(1).write.parquet(str(tmp_path / "more"))
    (new,) = (tmp_path / "more").glob("part-*.parquet")
    shutil.copy(new, f"{raw}/account/more+%20 1.parquet")
    assert run() == whole() and read[1:] == [["more+%20 1.parquet"]]
    failed = {(r.model, r.test): r.failures for r in run_new_tests(spark, models, state, buckets=4).collect() if r.failures}
    assert set(failed) == {("stg_account", "not_null"), ("stg_account", "unique")} and failed["stg_account", "not_null"] == 3

    (tmp_path / "raw/account/more+%20 1.parquet").unlink()
    assert run() == whole() and len(read) == 2
    assert [r.failures for r in run_new_tests(spark, models, state, quality.UNIQUE, buckets=4).collect()] == [0] * 11


def test_a_run_that_dies_before_its_list_counts_for_nothing(spark, tmp_path, read):
    folder, state = str(tmp_path / "t"), str(tmp_path / "state")
    spark.range(100).selectExpr("cast(id % 60 as string) AS account_id").write.parquet(folder)
    models = {"dim_account": KeyFiles(folder, "account_id")}
    run_new_tests(spark, models, state, buckets=3)
    shutil.rmtree(tmp_path / "state/versions")  # the run came as far as its counts
    for _ in range(2):
        assert [tuple(r)[2:] for r in run_new_tests(spark, models, state, buckets=3).collect()] == [("not_null", 0), ("unique", 40)]
    assert len(read) == 2


def test_the_state_is_added_up_without_an_exchange(spark, tmp_path):
    folder, state = str(tmp_path / "t"), str(tmp_path / "state")
    spark.range(1000).selectExpr("cast(id as string) AS account_id").write.parquet(folder)
    models = {"dim_account": KeyFiles(folder, "account_id")}
    run_new_tests(spark, models, state, buckets=3)
    known = spark.read.parquet(f"{state}/versions")
    plan = plan_of(key_state.totals(spark, models, known, key_state._counts(spark, state, 3)))
    assert "Bucketed: true" in plan and "hashpartitioning(model" not in plan
