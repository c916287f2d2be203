from __future__ import annotations

import time

import pytest
from conftest import AS_OF, SF_DIR, plan_of, rows
from pyspark.sql import functions as F

from ankenmart.operators.layout import clustered, ranges_of
from ankenmart.plans import pipeline
from ankenmart.plans.quality import KEYS
from ankenmart.plans.wide import gold_opportunity_line_item_wide
from ankenmart.session import scratch_path, shared_dir, shuffles_freed
from ankenmart.sources.raw import parquet_source
from fixtures.crm import crm_source, write_raw


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("build"))
    return out, pipeline.build(spark, crm_source(spark, SF_DIR), out, AS_OF, target="trial", catalog=True)


def test_all_models_are_there(built):
    _, result = built
    assert set(result.tables) == set(pipeline.DESCRIPTIONS) and len(result.tables) == 25
    assert len(result.staging) == 11 and len(result.marts) == 14


def test_only_the_known_test_fails(built):
    _, result = built
    got = result.tests.collect()
    assert len(got) == 2 * len(KEYS) == 46
    assert [(r.model, r.test) for r in got if r.failures] == [("fact_opportunity_line_item", "not_null")]


def test_staging_is_views_and_marts_are_described_tables(spark, built):
    out, _ = built
    assert spark.table("stg_account").count() == spark.sql("SELECT count(*) FROM stg_account").first()[0]
    assert spark.catalog.getTable("trial_marts.gold_opportunity_wide").description
    assert spark.sql("SELECT `商談ID` FROM trial_marts.gold_opportunity_wide").count() == 1441
    assert spark.read.parquet(f"{out}/trial_marts/dim_date").count() > 4000


def test_written_tables_equal_their_definition(built, tables):
    _, result = built
    got = result.marts["gold_opportunity_line_item_wide"]
    assert rows(got) == rows(gold_opportunity_line_item_wide(tables))


def test_written_scan_prunes_rows_and_columns(built):
    _, result = built
    wide = result.marts["gold_opportunity_line_item_wide"]
    plan = plan_of(wide.where(F.col("案件ID") == "x").select("合計金額"))
    assert "EqualTo(`案件ID`,x)" in plan and "ReadSchema: struct<案件ID:string,合計金額:decimal(18,2)>" in plan


def test_clustered_files_hold_ranges_and_a_hot_key_covers_several(spark, tmp_path):
    data = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("5000")).otherwise((F.col("id") % 9000).cast("string")).alias("k"),
        F.col("id").cast("string").alias("id"),
        F.sha2(F.col("id").cast("string"), 512).alias("filler"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered(data, "k", "id").write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (
        spark.read.parquet(str(tmp_path / "t"))
        .groupBy(F.col("_metadata.file_path").alias("f"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert len(files) == 4 and max(f.n for f in files) < 7_000
    assert all(a.hi <= b.lo for a, b in zip(files, files[1:]))
    assert sum(f.lo <= "5000" <= f.hi for f in files) >= 2


def test_preview(built):
    _, result = built
    got = pipeline.preview(result.marts["gold_opportunity_line_item_wide"], "案件名", "受注予定/年")
    assert got.columns == ["案件名", "受注予定/年"] and got.count() == 10


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def _twice(source, name):
    """The source with the first row of a table there twice."""
    return lambda n: source(n).unionByName(source(n).orderBy("Id").limit(1)) if n == name else source(n)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return write_raw(spark, SF_DIR, str(tmp_path_factory.mktemp("raw")), 2)


def test_a_failing_key_holds_back_what_builds_on_it(spark, raw, tmp_path):
    out, source = str(tmp_path), parquet_source(spark, raw)
    broken = pipeline.build(spark, _twice(source, "account"), out, AS_OF)
    state = lambda b, s: {m for m, is_ in b.status.items() if is_ == s}
    assert state(broken, pipeline.FAILED) == {"stg_account", "dim_account"}
    assert state(broken, pipeline.BLOCKED) == {"gold_opportunity_wide", "gold_opportunity_line_item_wide"}
    assert set(broken.marts) == set(pipeline.published(spark, out)) == set(pipeline.DESCRIPTIONS) - set(broken.staging) - {"dim_account", *state(broken, pipeline.BLOCKED)}
    good = pipeline.build(spark, source, out, AS_OF)
    assert set(good.status.values()) == {pipeline.BUILT} and len(good.marts) == 14
    # Now the tables of the good build stay, with an older account dimension.
    again = pipeline.build(spark, _twice(source, "account"), out, AS_OF)
    assert again.marts["dim_account"].count() == good.staging["stg_account"].count()
    assert again.marts["gold_opportunity_line_item_wide"].inputFiles() == good.marts["gold_opportunity_line_item_wide"].inputFiles()
    assert again.marts["dim_user"].inputFiles() != good.marts["dim_user"].inputFiles()


def test_the_known_failure_holds_back_where_it_does_not_only_warn(spark, raw, tmp_path):
    strict = pipeline.build(spark, parquet_source(spark, raw), str(tmp_path), AS_OF, warn=())
    assert {m: s for m, s in strict.status.items() if s != pipeline.BUILT} == {
        "fact_opportunity_line_item": pipeline.FAILED, "gold_opportunity_line_item_wide": pipeline.BLOCKED,
    }
    assert not set(strict.marts) & {"fact_opportunity_line_item", "gold_opportunity_line_item_wide"}


def test_a_build_that_dies_leaves_the_marts_as_they_were(spark, raw, tmp_path):
    out, source = str(tmp_path), parquet_source(spark, raw)
    pipeline.build(spark, source, out, AS_OF)
    before = {m: (rows.inputFiles(), rows.count()) for m, rows in pipeline.published(spark, out).items()}

    def dying(name):
        rows = source(name)
        return rows.where(F.raise_error(F.lit("gone")).isNull()) if name == "opportunitylineitem" else rows

    with pytest.raises(Exception, match="gone"):
        pipeline.build(spark, dying, out, AS_OF)
    assert {m: (rows.inputFiles(), rows.count()) for m, rows in pipeline.published(spark, out).items()} == before


def test_folders_of_the_last_two_builds_are_kept(spark, raw, tmp_path):
    one = lambda i: pipeline._publish(spark, str(tmp_path), "t", {"a": f"{tmp_path}/a/{i}", **({"b": f"{tmp_path}/b/{i}"} if i != 1 else {})})
    for i in range(4):
        for m in "ab":
            (tmp_path / m / str(i)).mkdir(parents=True)
        one(i)
        there = {m: {int(p.name) for p in (tmp_path / m).iterdir()} for m in "ab"}
        # Build 1 made no b, so its folder of b is nobody's and stays.
        assert there["a"] == {i, max(i - 1, 0)} and there["b"] - {1} == {0: {0}, 1: {0}, 2: {0, 2}, 3: {2, 3}}[i]


def test_staging_views_and_comments_outlast_the_session(spark, raw, tmp_path):
    built = pipeline.build(spark, parquet_source(spark, raw), str(tmp_path), AS_OF, target="lasting", catalog=True)
    other = spark.newSession()
    assert not other.catalog.tableExists("stg_account")
    assert rows(other.table("lasting_staging.stg_account")) == rows(built.staging["stg_account"])
    for model, text in pipeline.DESCRIPTIONS.items():
        layer = "staging" if model in built.staging else "marts"
        said = {r.col_name: r for r in other.sql(f"DESCRIBE TABLE EXTENDED lasting_{layer}.{model}").collect()}
        assert said["Comment"].data_type == text
        if model in KEYS:
            assert said[KEYS[model]].comment == "Key: filled and unique"
    files = other.table("lasting_marts.dim_user").inputFiles()
    pipeline.build(spark, parquet_source(spark, raw), str(tmp_path), AS_OF, target="lasting", catalog=True)
    other = spark.newSession()  # a session keeps a table's files until it refreshes the table
    assert other.table("lasting_marts.dim_user").inputFiles() != files
    assert other.table("lasting_marts.dim_user").count() == built.marts["dim_user"].count()
    assert spark.read.parquet(files[0]).schema["user_id"].metadata["comment"] == "Key: filled and unique"


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def shuffled() -> int:
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))

    def left(write) -> int:
        before = shuffled()
        write()
        end = time.time() + 10
        while shuffled() > before and time.time() < end:
            time.sleep(0.2)
        return shuffled() - before

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    data = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_freed(spark):
        assert left(lambda: data.write.parquet(str(tmp_path / "t"))) <= 0
    assert spark.conf.get(setting) == was and spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_line_marts_are_ranges_of_the_opportunity(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "ranges_of", lambda *given: ranges_of(*given, 500))
    result = pipeline.build(spark, parquet_source(spark, raw), str(tmp_path), AS_OF)
    for model, key in ((pipeline.LINE_FACT, "opportunity_id"), ("gold_opportunity_line_item_wide", "案件ID")):
        mart = result.marts[model]
        files = mart.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).orderBy("lo").collect()
        assert len(files) > 5 and all(a.hi < b.lo for a, b in zip(files, files[1:]))
