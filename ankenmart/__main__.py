"""Jobs for ``spark-submit`` or ``python -m ankenmart``: load CSV files, build the marts."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from ankenmart.plans.pipeline import BLOCKED, WARN, build
from ankenmart.plans.quality import NOT_NULL, UNIQUE
from ankenmart.session import configure
from ankenmart.sources.csv_text import BY_HEADER, BY_POSITION, CsvFormat, list_files
from ankenmart.sources.load import (
    ABORT,
    CONTINUE,
    WIDE_TYPES,
    csv_source,
    force_load,
    validate,
    wide_text,
)
from ankenmart.sources.raw import NAMESPACE, RAW_TABLES, catalog_source, parquet_source
from ankenmart.streaming.load_once import copy_raw, load_once


def _format(job: argparse.ArgumentParser) -> None:
    job.add_argument("--encoding", default=BY_HEADER.encoding)
    job.add_argument("--single-line", action="store_true", help="no value holds a line end, so one file is read by many tasks")


def _test(name: str) -> tuple[str, str]:
    model, _, test = name.rpartition(".")
    if test not in (NOT_NULL, UNIQUE):
        raise argparse.ArgumentTypeError(f"{name} is no MODEL.TEST")
    return model, test


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ankenmart", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    make = jobs.add_parser("build", help="write all marts, then run the data tests")
    make.add_argument("--raw", required=True, help=f"folder of the raw tables, or a database such as {NAMESPACE}")
    make.add_argument("--format", choices=("parquet", "csv", "catalog"), default="parquet")
    make.add_argument("--out", required=True)
    make.add_argument("--as-of", type=dt.date.fromisoformat, help="last day of the calendar less five years")
    make.add_argument("--target", default="analytics", help="prefix of the layer names")
    make.add_argument("--catalog", action="store_true", help="register the marts as tables, staging as views")
    make.add_argument(
        "--warn", type=_test, nargs="*", default=WARN, metavar="MODEL.TEST", help=f"tests ({NOT_NULL}, {UNIQUE}) whose failure holds nothing back"
    )

    load = jobs.add_parser("load", help="load line-item wide CSV files")
    load.add_argument("--folder", required=True)
    load.add_argument("--out", required=True)
    load.add_argument("--pattern", help="regular expression for the whole path")
    load.add_argument("--on-error", choices=(ABORT, CONTINUE), default=ABORT)
    load.add_argument("--force", action="store_true", help="load files again that were loaded before")
    _format(load)

    copy = jobs.add_parser("copy", help="add positional CSV files that are new to a raw table")
    copy.add_argument("--table", required=True, choices=RAW_TABLES)
    copy.add_argument("--folder", required=True)
    copy.add_argument("--out", required=True, help="folder of the raw tables")
    copy.add_argument("--on-error", choices=(ABORT, CONTINUE), default=ABORT)
    _format(copy)

    check = jobs.add_parser("validate", help="list the bad values of CSV files, load nothing")
    check.add_argument("--folder", required=True)
    check.add_argument("--out", required=True, help="where the list goes")
    check.add_argument("--pattern")
    _format(check)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """The exit status: 1 if a data test failed or a bad value was found."""
    if args.job == "build":
        sources = {"parquet": parquet_source, "csv": csv_source, "catalog": catalog_source}
        built = build(spark, sources[args.format](spark, args.raw), args.out, args.as_of, args.target, args.catalog, args.warn)
        failed = [r for r in built.tests.collect() if r.failures]  # 46 rows at most
        for r in failed:
            print(f"{r.test} failed on {r.model}.{r.column}: {r.failures}")
        for model, status in built.status.items():
            if status == BLOCKED:
                print(f"{model} is not published: a model it builds on failed")
        return bool(failed)
    if args.job == "copy":
        fmt = CsvFormat(BY_POSITION.null, args.encoding, multi_line=not args.single_line)
        copy_raw(spark, args.table, args.folder, args.out, args.on_error, fmt)
        return 0
    fmt = CsvFormat(BY_HEADER.null, args.encoding, multi_line=not args.single_line)
    if args.job == "load":
        how = force_load if args.force else load_once
        how(spark, args.folder, args.out, args.pattern, args.on_error, fmt)
        return 0
    paths = [r.path for r in list_files(spark, args.folder, args.pattern).select("path").toLocalIterator()]
    validate(wide_text(spark, paths, fmt), WIDE_TYPES).write.mode("overwrite").parquet(args.out)
    return not spark.read.parquet(args.out).isEmpty()


if __name__ == "__main__":
    sys.exit(run(configure(SparkSession.builder.appName("ankenmart")).getOrCreate(), arguments()))
