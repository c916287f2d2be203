from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from ankenmart.__main__ import arguments, run
from ankenmart.plans.staging import STAGING, staged
from ankenmart.sources.load import csv_source, loaded
from ankenmart.sources.raw import RAW_TABLES, parquet_source
from fixtures.crm import crm_source, write_raw
from fixtures.csv_files import as_text, write_csv


def test_build_reports_the_failing_test(spark, tmp_path, capsys):
    raw = write_raw(spark, SF_DIR, str(tmp_path / "raw"), 2)
    args = arguments(["build", "--raw", raw, "--out", str(tmp_path / "out"), "--as-of", "2026-07-31"])
    assert args.as_of == dt.date(2026, 7, 31)
    assert run(spark, args) == 1
    assert "not_null failed on fact_opportunity_line_item.line_item_id: 27" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out/analytics_marts/gold_opportunity_wide")).count() == 1441


def test_load_and_validate(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.csv").write_text("品目ID,合計金額\n1,x\n2,3\n", encoding="utf-8")
    paths = ["--folder", str(folder), "--pattern", r".*\.csv"]
    assert run(spark, arguments(["validate", *paths, "--out", str(tmp_path / "bad")])) == 1
    for force in ([], [], ["--force"]):
        assert run(spark, arguments(["load", *paths, "--out", out, "--on-error", "continue", *force])) == 0
    assert loaded(spark, out).count() == 2


def _untimed(df):
    """Numbers of any scale as doubles, without times, whose type depends on the file format."""
    picked = [c for c, kind in df.dtypes if not kind.startswith("timestamp")]
    return rows(df.select(*[F.col(c).cast("double") if "decimal" in dict(df.dtypes)[c] else c for c in picked]))


@pytest.mark.parametrize("model", STAGING)
def test_staging_from_csv_exports_equals_staging_from_tables(spark, tmp_path, model):
    table = STAGING[model].name
    given = crm_source(spark, SF_DIR)
    write_csv(as_text(given(table)), str(tmp_path / "csv" / table), "NULL")
    copy = ["copy", "--table", table, "--folder", str(tmp_path / "csv" / table), "--out", str(tmp_path / "raw")]
    assert run(spark, arguments(copy)) == 0
    want = _untimed(staged(given, model))
    assert _untimed(staged(csv_source(spark, str(tmp_path / "csv")), model)) == want
    assert _untimed(staged(parquet_source(spark, str(tmp_path / "raw")), model)) == want


def test_bad_raw_record_leaves_nothing(spark, tmp_path):
    folder = tmp_path / "recordtype"
    folder.mkdir()
    (folder / "a.csv").write_text("a,b,c,d,e,f\n1,n,d,x,o,true\n2,n,d,x,o,perhaps\n", encoding="utf-8")
    copy = ["copy", "--table", "recordtype", "--folder", str(folder), "--out", str(tmp_path / "raw")]
    with pytest.raises(Exception, match="bad value or record"):
        run(spark, arguments(copy))
    # The history knows what was planned; no row of it is there.
    assert not [p for p in (tmp_path / "raw").rglob("*.parquet") if "_loads" not in p.parts]
    assert run(spark, arguments([*copy, "--on-error", "continue"])) == 0
    assert spark.read.parquet(str(tmp_path / "raw/recordtype")).count() == 1
    assert len(RAW_TABLES) == 11
