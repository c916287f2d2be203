from __future__ import annotations

import datetime as dt
import decimal
import gzip
import importlib
import os
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ankenmart import storage
from ankenmart.sources import csv_text, load
from ankenmart.sources.csv_text import BY_HEADER, BY_POSITION, CsvFormat
from ankenmart.sources.raw import parquet_source
from ankenmart.streaming.load_once import copy_raw, history, load_files_once, load_once

TYPES = {"品目ID": "string", "合計金額": "decimal(15,2)", "クローズ日": "date", "受注済み": "boolean", "台数": "decimal(9,0)"}


def _write(folder, name, text, encoding="utf-8"):
    data = text if isinstance(text, bytes) else text.encode(encoding)
    path = folder / name
    path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    return str(path)


def _typed(spark, paths, types=TYPES, on_error=load.ABORT, fmt=BY_HEADER):
    return load.typed(csv_text.by_header(spark, paths, list(types), fmt), types, on_error)


def test_headers_in_any_order_with_missing_and_extra_columns(spark, tmp_path):
    paths = [
        _write(tmp_path, "a.csv", "品目ID,合計金額,クローズ日,受注済み,台数\n1,10.005,2024-02-29,true,3\n"),
        _write(tmp_path, "b.csv.gz", "余分,クローズ日,品目ID,合計金額\nx,2024-03-01,2,20\n"),
    ]
    assert rows(_typed(spark, paths)) == [
        ("1", decimal.Decimal("10.01"), dt.date(2024, 2, 29), True, 3),
        ("2", decimal.Decimal("20.00"), dt.date(2024, 3, 1), None, None),
    ]


def test_null_empty_quoted_comma_quote_newline_and_space(spark, tmp_path):
    text = 'a,b\nnull,\n"","null"\n"x,y","say ""hi"""\n" s ",t \n"two\nlines",z\n'
    path = _write(tmp_path, "a.csv", text)
    got = csv_text.by_header(spark, [path], ["a", "b"]).select("a", "b")
    assert rows(got) == sorted(
        [(None, None), (None, None), ("x,y", 'say "hi"'), (" s ", "t "), ("two\nlines", "z")], key=repr
    )


def test_null_text_differs_between_the_formats(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "h1,h2\nNULL,null\n,x\n")
    assert rows(csv_text.by_position(spark, [path], ["a", "b"]).select("a", "b")) == [(None, "null"), (None, "x")]
    assert rows(csv_text.by_header(spark, [path], ["h1", "h2"]).select("h1", "h2")) == [("NULL", None), (None, "x")]


def test_names_match_case_sensitively(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "ml,ML\nlow,HIGH\n")
    assert rows(csv_text.by_header(spark, [path], ["ML"]).select("ML")) == [("HIGH",)]
    assert rows(csv_text.by_header(spark, [path], ["Ml"]).select("Ml")) == [(None,)]


def test_repeated_header_name_is_an_error(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "a,a,b\n1,2,3\n")
    with pytest.raises(ValueError, match="more than once"):
        csv_text.by_header(spark, [path], ["a"])
    assert csv_text.by_header(spark, [path], ["b"]).count() == 1


def test_invalid_bytes_become_replacement_characters(spark, tmp_path):
    path = _write(tmp_path, "a.csv", b"a,b\nx\xffy,1\n")
    assert csv_text.by_header(spark, [path], ["a"]).first().a == "x�y"


def test_byte_order_mark(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "案件,b\n1,2\n", "utf-8-sig")
    assert csv_text.by_header(spark, [path], ["案件"]).first()["案件"] == "1"


def test_windows_932(spark, tmp_path):
    # The second bytes of these letters include a backslash and a bar.
    text = '案件名,表\n"ソ―表,予",ポ能\n十,null\n'
    path = _write(tmp_path, "a.csv", text, "cp932")
    fmt = CsvFormat(null="null", encoding="WINDOWS932")
    assert rows(csv_text.by_header(spark, [path], ["案件名", "表"], fmt).select("案件名", "表")) == sorted(
        [("ソ―表,予", "ポ能"), ("十", None)], key=repr
    )
    with pytest.raises(ValueError, match="cannot be read"):
        CsvFormat(null="", encoding="EBCDIC")
    with pytest.raises(ValueError, match="half a character"):
        CsvFormat(null="", encoding="WINDOWS932", delimiter="|")


BAD = (
    "品目ID,合計金額,クローズ日,受注済み,台数\n"
    "1,10,2024-01-01,true,1\n"
    "2,abc,2024-13-01,false,2\n"
    "3,10,2024-01-01,maybe,1234567890\n"
    "4,10\n"
    "5,10,2024-01-01,true,1,more\n"
)


def test_abort_names_the_file(spark, tmp_path):
    path = _write(tmp_path, "bad.csv", BAD)
    with pytest.raises(Exception, match="bad value or record in .*bad.csv"):
        _typed(spark, [path]).collect()
    with pytest.raises(Exception, match="bad value or record"):
        _typed(spark, [path]).select("品目ID").collect()


def test_continue_drops_bad_rows(spark, tmp_path):
    path = _write(tmp_path, "bad.csv", BAD)
    assert [r["品目ID"] for r in _typed(spark, [path], on_error=load.CONTINUE).collect()] == ["1"]
    with pytest.raises(ValueError, match="unknown error policy"):
        _typed(spark, [path], on_error="guess")


def test_validate_lists_every_error(spark, tmp_path):
    path = _write(tmp_path, "bad.csv", BAD)
    got = load.validate(csv_text.by_header(spark, [path], list(TYPES)), TYPES)
    assert got.columns == ["file", "column", "value"]
    assert all(r.file.endswith("bad.csv") for r in got.collect())
    assert rows(got.select("column", "value")) == sorted(
        [
            ("合計金額", "abc"),
            ("クローズ日", "2024-13-01"),
            ("受注済み", "maybe"),
            ("台数", "1234567890"),
            (None, "4,10"),
            (None, "5,10,2024-01-01,true,1,more"),
        ],
        key=repr,
    )


def test_only_whole_days_and_times_are_values(spark):
    texts = ["2024-02", "2024", "2024-01-01 junk", "12:30", "2024-01-01T", "2024-01-01", "2024-01-01T10:20:30.5Z", "2024-01-01 10:20+0900"]
    table = spark.createDataFrame([(t,) for t in texts], "v string")
    days = [r[0] for r in table.selectExpr(load.parsed("v", "date")).collect()]
    assert [d is not None for d in days] == [False] * 5 + [True, False, False]
    times = [r[0] for r in table.selectExpr(load.parsed("v", "timestamp")).collect()]
    assert [t is not None for t in times][:7] == [False] * 5 + [True, True]


def test_wide_types_and_arrays(spark, tmp_path):
    text = (
        "品目ID,最終フェーズ変更日,建物都道府県,建物市区町村,利益率,クローズ年,表示順\n"
        '1,2025-12-03T20:04:13.000Z,"[""神奈川県"",""東京都""]",[],12.345,2025,7\n'
    )
    got = load.with_arrays(load.read_wide_csv(spark, [_write(tmp_path, "w.csv", text)]))
    assert len(got.columns) == 89
    row = got.withColumn("t", F.unix_seconds("最終フェーズ変更日")).first()
    assert row.t == int(dt.datetime(2025, 12, 3, 20, 4, 13, tzinfo=dt.timezone.utc).timestamp())
    assert row["建物都道府県"] == ["神奈川県", "東京都"] and row["建物市区町村"] == [] and row["建物住所"] is None
    assert (row["利益率"], row["クローズ年"], row["表示順"]) == (decimal.Decimal("12.35"), 2025, "7")
    assert got.drop(*load.ARRAY_LABELS).schema == load.read_wide_csv(spark, [str(tmp_path / "w.csv")]).drop(
        *load.ARRAY_LABELS
    ).schema
    assert load.read_wide_csv(spark, [str(tmp_path / "w.csv")]).schema == load.load_schema()


def test_list_files_by_pattern(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("gold.csv", "gold.csv.gz", "other.csv", "sub/gold.csv", "gold.csv.bak"):
        _write(tmp_path, name, "a\n1\n")
    got = csv_text.list_files(spark, str(tmp_path), r".*gold\.csv(\.gz)?")
    assert sorted(r.path.removeprefix(f"file:{tmp_path}/") for r in got.collect()) == [
        "gold.csv",
        "gold.csv.gz",
        "sub/gold.csv",
    ]
    assert csv_text.list_files(spark, str(tmp_path)).count() == 5


def test_names_of_files(spark, tmp_path):
    path = _write(tmp_path, "a[1].csv", "a\n1\n")
    _write(tmp_path, "a1.csv", "a\nanother\n")
    with pytest.raises(ValueError, match="glob character"):
        csv_text.by_header(spark, [path], ["a"])
    spaced = _write(tmp_path, "商談 品目.csv", "a\n1\n")
    assert csv_text.by_header(spark, [spaced], ["a"]).first().a == "1"


def test_no_files_and_empty_files_give_no_rows(spark, tmp_path):
    assert csv_text.by_header(spark, [], ["a"]).count() == 0
    assert csv_text.by_header(spark, [_write(tmp_path, "e.csv", "")], ["a"]).count() == 0
    assert csv_text.by_header(spark, [_write(tmp_path, "h.csv", "a\n")], ["a"]).count() == 0


def test_raw_table_by_position(spark, tmp_path):
    (tmp_path / "recordtype").mkdir()
    _write(tmp_path / "recordtype", "part1.csv", "x,y,z,u,v,w\n1,A,B,NULL,Opportunity,true\n2,,C,,Opportunity,false\n")
    got = load.csv_source(spark, str(tmp_path))("recordtype")
    assert got.columns == ["Id", "Name", "DeveloperName", "Description", "SobjectType", "IsActive"]
    assert rows(got) == [("1", "A", "B", None, "Opportunity", True), ("2", None, "C", None, "Opportunity", False)]


def test_raw_int_rounds_and_timestamps(spark, tmp_path):
    types = {"q": "int", "t": "timestamp", "n": "decimal(24,6)"}
    path = _write(tmp_path, "a.csv", "q,t,n\n2.5,2024-01-01T00:00:00Z,1.5\n")
    row = load.typed(csv_text.by_position(spark, [path], list(types)), types).first()
    assert (row.q, row.n) == (3, decimal.Decimal("1.500000"))


def test_inferred_schema(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "件名,台数,日\nx,1,2024-01-01\n,null,2024-01-02\n")
    assert _inferred(spark, [path]) == {"件名": "string", "台数": "int", "日": "date"}


def _inferred(spark, paths, fmt=BY_HEADER):
    return {f.name: f.dataType.simpleString() for f in load.inferred_schema(spark, paths, fmt)}


def test_types_are_inferred_by_name_over_files_of_any_column_order(spark, tmp_path):
    text = ("k,n,金額,率,時,旗,大,空\nx,1,10.50,1e3,2024-01-01T00:00:00Z,true,1,null\n", "n,k,金額,率,時,旗,大\n2,y,-1234.5,2,2024-02-01,false,9999999999\n")
    want = {"k": "string", "n": "int", "金額": "decimal(6,2)", "率": "double", "時": "timestamp", "旗": "boolean", "大": "bigint", "空": "string"}
    for encoding in ("UTF-8", "WINDOWS932"):
        codec = "cp932" if encoding == "WINDOWS932" else "utf-8"
        paths = [_write(tmp_path, f"{codec}{i}.csv", t, codec) for i, t in enumerate(text)]
        assert _inferred(spark, paths, CsvFormat("null", encoding)) == want
    assert _inferred(spark, []) == {}
    assert _inferred(spark, [_write(tmp_path, "bad.csv", "a,b\n1,2024-02\n1234567890123456789012345678901234567890,12:30\n")]) == {"a": "double", "b": "string"}


def test_one_file_of_single_lines_is_read_by_several_tasks(spark, tmp_path):
    path = _write(tmp_path, "a.csv", "品目ID,案件名\n" + "".join(f"{i},表ソ\n" for i in range(100_000)), "cp932")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        for multi_line, least, most in ((False, 8, 99), (True, 1, 1)):
            got = csv_text.by_header(spark, [path], ["品目ID", "案件名"], CsvFormat("null", "WINDOWS932", multi_line=multi_line))
            assert least <= got.rdd.getNumPartitions() <= most
            assert got.where("`案件名` = '表ソ'").select("品目ID").distinct().count() == 100_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_raw_files_are_copied_once(spark, tmp_path):
    folder, out = tmp_path / "recordtype", str(tmp_path / "raw")
    folder.mkdir()
    head = "a,b,c,d,e,f\n"
    _write(folder, "a.csv", head + "1,n,d,x,o,true\n")
    ids = lambda: sorted(r.Id for r in parquet_source(spark, out)("recordtype").select("Id").collect())
    for _ in range(2):
        copy_raw(spark, "recordtype", str(folder), out)
        assert ids() == ["1"]
    _write(folder, "b.csv", head + "2,n,d,x,o,true\n")
    copy_raw(spark, "recordtype", str(folder), out)
    assert ids() == ["1", "2"]


def _ids(spark, out):
    return sorted(r["品目ID"] for r in load.loaded(spark, out).select("品目ID").collect())


def test_each_file_is_loaded_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    pattern = r".*gold\.?\d*\.csv(\.gz)?"
    _write(folder, "gold1.csv", "品目ID,合計金額\n1,10\n")
    _write(folder, "gold2.csv.gz", "合計金額,品目ID\n20,2\n")
    _write(folder, "other.csv", "品目ID\nno\n")
    for _ in range(2):
        load_once(spark, str(folder), out, pattern, files_per_batch=1)
        assert _ids(spark, out) == ["1", "2"]
    _write(folder, "gold3.csv", "品目ID,合計金額\n3,30\n")
    load_once(spark, str(folder), out, pattern)
    assert _ids(spark, out) == ["1", "2", "3"]


def test_late_replaced_and_otherwise_named_files_are_loaded(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    _write(folder, "x.csv", "品目ID\n1\n")
    _write(folder, "y.csv", "品目ID\n2\n")
    load_once(spark, str(folder), out, r".*x\.csv")
    load_once(spark, str(folder), out)
    assert _ids(spark, out) == ["1", "2"]
    old = _write(folder, "old.csv", "品目ID\n3\n")
    os.utime(old, (1e9, 1e9))
    load_once(spark, str(folder), out)
    assert _ids(spark, out) == ["1", "2", "3"]
    _write(folder, "x.csv", "品目ID\n10\n")
    load_once(spark, str(folder), out)
    assert _ids(spark, out) == ["1", "10", "2", "3"]


def test_two_histories_share_a_table(spark, tmp_path):
    out = str(tmp_path / "out")
    for name in ("a", "b"):
        folder = tmp_path / name
        folder.mkdir()
        _write(folder, "f.csv", f"品目ID\n{name}\n")
        load_once(spark, str(folder), out, checkpoint=str(tmp_path / f"history-{name}"))
    assert _ids(spark, out) == ["a", "b"]


def test_a_load_that_was_not_marked_done_is_run_again(spark, tmp_path, monkeypatch):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    _write(folder, "a.csv", "品目ID\n1\n")
    module = importlib.import_module("ankenmart.streaming.load_once")

    def written_then_lost(*args):
        load.append_load(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "append_load", written_then_lost)
        with pytest.raises(RuntimeError):
            load_once(spark, str(folder), out)
    _write(folder, "b.csv", "品目ID\n2\n")
    load_once(spark, str(folder), out)
    assert _ids(spark, out) == ["1", "2"]


def test_failed_batch_is_loaded_after_the_file_is_mended(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    path = _write(folder, "a.csv", "品目ID,合計金額\n1,ten\n2,20\n")
    with pytest.raises(Exception, match="bad value or record"):
        load_once(spark, str(folder), out)
    _write(folder, "a.csv", "品目ID,合計金額\n1,10\n2,20\n")
    load_once(spark, str(folder), out)
    assert path and _ids(spark, out) == ["1", "2"]


def test_force_loads_again(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    _write(folder, "a.csv", "品目ID,合計金額\n1,10\n")
    load_once(spark, str(folder), out)
    load.force_load(spark, str(folder), out)
    assert _ids(spark, out) == ["1", "1"]
    load_once(spark, str(folder), out)
    assert _ids(spark, out) == ["1", "1"]


def test_formats():
    assert (BY_POSITION.null, BY_HEADER.null) == ("NULL", "null")


def test_one_of_many_creates_a_file(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: storage.create_if_absent(spark, path, f"text {i}"), range(24)))
    assert won.count(True) == 1 and Path(path).read_text() == f"text {won.index(True)}"
    assert storage.names(spark, f"{tmp_path}/log") == ["1.json"] and storage.names(spark, f"{tmp_path}/none") == []


def test_a_rename_does_not_replace(spark, tmp_path):
    for text, want in (("a", True), ("b", False)):
        hidden, fs = storage._path(spark, f"{tmp_path}/_x")
        out = fs.create(hidden, True)
        out.write(bytearray(text.encode()))
        out.close()
        assert storage._renamed(spark, hidden, f"{tmp_path}/y") is want
    assert Path(tmp_path / "y").read_text() == "a"


def test_two_loaders_started_together_load_no_row_twice(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for i in range(12):
        _write(folder, f"f{i:02}.csv", f"品目ID\n{i}\n")
    together = Barrier(3)

    def run(_):
        together.wait()
        load_once(spark, str(folder), out, files_per_batch=2)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(run, range(3)))
    assert sorted(map(int, _ids(spark, out))) == list(range(12))
    seen = history(spark, f"{out}/_loads").groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("step").alias("step")).collect()
    assert len(seen) == 12 and {(r.n, r.step) for r in seen} == {(1, "done")}


def test_loads_of_few_files_run_together(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for i in range(4):
        _write(folder, f"{i}.csv", f"品目ID\n{i}\n")
    together = Barrier(2, timeout=60)

    def read(paths):
        together.wait()
        return load.read_wide_csv(spark, paths)

    load_files_once(spark, str(folder), out, read, files_per_batch=1)
    assert _ids(spark, out) == ["0", "1", "2", "3"]
    assert {r.step for r in history(spark, f"{out}/_loads").collect()} == {"done"}


def test_a_load_that_fails_beside_others_is_raised_and_released(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for i in range(3):
        _write(folder, f"{i}.csv", f"品目ID,合計金額\n{i},{'ten' if i == 1 else 10}\n")
    with pytest.raises(Exception, match="bad value or record"):
        load_once(spark, str(folder), out, files_per_batch=1)
    assert _ids(spark, out) == ["0", "2"]
    _write(folder, "1.csv", "品目ID,合計金額\n1,10\n")
    load_once(spark, str(folder), out, files_per_batch=1)
    assert _ids(spark, out) == ["0", "1", "2"]


def test_wide_rows_are_not_left_to_the_interpreter(spark, tmp_path):
    """What is generated for 89 typed columns is no method longer than the JVM compiles."""
    path = _write(tmp_path, "a.csv", ",".join(load.WIDE_TYPES) + "\n")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
    read = load.read_wide_csv(spark, [path])
    assert read.count() == 0 and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_lost_loader_is_followed_by_another_after_its_lease(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    _write(folder, "a.csv", "品目ID\n1\n")
    module = importlib.import_module("ankenmart.streaming.load_once")
    load_once(spark, str(folder), out)
    log = module._log(spark, f"{out}/_loads")
    (entry,) = log.frame().where("step = 'done'").collect()
    storage.delete(spark, f"{out}/_loads/log/{entry.version:020d}.json")  # as if the job had died before
    read = lambda paths: load.read_wide_csv(spark, paths)
    _write(folder, "b.csv", "品目ID\n2\n")
    load_files_once(spark, str(folder), out, read)
    assert [e.step for e in log.frame().where(F.col("load") == entry.load).collect()] == ["claimed"]
    load_files_once(spark, str(folder), out, read, lease=0.0)
    assert _ids(spark, out) == ["1", "2"] and log.frame().where("step = 'done'").count() == 2


def test_headers_of_many_files_are_read_by_one_job(spark, tmp_path):
    want = {}
    for i in range(300):
        names = ['a"x', "b\nc", None, "日本"][: 1 + i % 4] if i % 5 else ["only"]
        quoted = ['"' + n.replace('"', '""') + '"' if n else "" for n in names]
        want[_write(tmp_path, f"f{i:03}.csv" + ".gz" * (i % 2), ",".join(quoted) + "\n" + "1,2\n" * (i % 3))] = tuple(names)
    _write(tmp_path, "empty.csv", "")
    spark.sparkContext.setJobGroup("headers", "")
    got = csv_text.file_headers(spark, [*want, f"{tmp_path}/empty.csv"], BY_HEADER).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Spark lists over 32 paths by a job of its own.
    assert len(jobs) <= 3
    assert {r.path.removeprefix("file:"): tuple(r.header) for r in got} == want
    groups = csv_text.headers(spark, list(want), BY_HEADER)
    assert len(groups) == len(set(want.values())) and sum(map(len, groups.values())) == 300


def test_the_header_of_a_large_file_is_that_of_its_first_split(spark, tmp_path):
    body = "品目ID,案件名\n" + "".join(f"{i},{'x' * 90}\n" for i in range(300_000))
    paths = [_write(tmp_path, f"{i}.csv", body) for i in range(2)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        for fmt in (BY_HEADER, CsvFormat("null", multi_line=False)):
            assert csv_text.headers(spark, paths, fmt) == {("品目ID", "案件名"): [f"file:{p}" for p in paths]}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_inferred_types_take_a_plan_whose_size_is_not_that_of_the_columns(spark, tmp_path, monkeypatch):
    names = [f"c{i}" for i in range(60)]
    values = ["1", "10.50", "true", "2024-01-01", "1e3", "x"]
    paths = [_write(tmp_path, f"{k}.csv", ",".join(names) + "\n" + ",".join(values[i % 6] for i in range(60)) + "\n") for k in range(2)]
    seen = []
    by_header = load.by_header
    monkeypatch.setattr(load, "by_header", lambda *a: seen.append(by_header(*a)) or seen[-1])
    exploded = []
    posexplode = F.posexplode
    monkeypatch.setattr(F, "posexplode", lambda c: exploded.append(c) or posexplode(c))
    kinds = ["int", "decimal(4,2)", "boolean", "date", "double", "string"]
    assert _inferred(spark, paths) == {n: kinds[i % 6] for i, n in enumerate(names)}
    # One test of a value, over all columns, not one a column.
    assert len(seen) == len(exploded) == 1


@pytest.mark.parametrize(
    ("values", "want"),
    [
        (["+1", "-0.5"], "decimal(2,1)"),
        ([".5", "5."], "decimal(2,1)"),
        (["2147483648", "1"], "bigint"),
        (["TRUE", "False"], "boolean"),
        (["1", "true"], "string"),
        (["2024-01-01", "2024-01-01T10:00:00Z"], "timestamp"),
        (["2024-13-01"], "string"),
        (["1E5", "1"], "double"),
        (["null", ""], "string"),
    ],
)
def test_inferred_type_of_a_column(spark, tmp_path, values, want):
    path = _write(tmp_path, "a.csv", "k,v\n" + "".join(f"x,{v}\n" for v in values))
    assert _inferred(spark, [path])["v"] == want


def test_headers_are_read_by_one_scan(spark, tmp_path):
    for i in range(3):
        _write(tmp_path, f"{i}.csv", f"a,b{i % 2}\n1,2\n")
    paths = sorted(map(str, tmp_path.iterdir()))
    spark.sparkContext.setJobGroup("headers-by-one-scan", "headers")
    try:
        found = csv_text.headers(spark, paths, BY_HEADER)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers-by-one-scan")
        stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [len(f) for f in found.values()] == [2, 1] and list(found) == [("a", "b0"), ("a", "b1")]
    # The scan and the groups; a sort of them had a job more, which sampled its bounds.
    assert len(jobs) <= 2 and len(stages) <= 3


def test_exports_share_rows_that_are_made_once(spark, tmp_path):
    from fixtures.csv_files import ABSENT, write_first_and_second

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    names = ["受注済み", "品目ID", *ABSENT]
    data = [(w, str(i), "a", "b", "c") for i, w in enumerate(["true", "false", None] * 10)]
    schema = ", ".join(f"`{n}` string" for n in names)
    write_first_and_second(spark.createDataFrame(data, schema).mapInArrow(counted, schema), str(tmp_path))
    assert made.value == 30
    files = [p for p in tmp_path.rglob("*.csv*") if not p.name.startswith((".", "_"))]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    got = csv_text.by_header(spark, [str(p) for p in files], ["品目ID"])
    assert sorted(int(r["品目ID"]) for r in got.collect()) == list(range(30))
