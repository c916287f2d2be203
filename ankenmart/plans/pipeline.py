"""The whole job: raw tables to staging views, marts, wide tables, data tests, and what of it is published.

Each build writes its marts to folders of its own. Readers go by a log whose last entry names the folder of every
mart; a build adds one entry at its end, so readers see all of it or nothing, and a build that dies midway leaves
what was there. A model whose data test fails is not published, nor is what builds on it; those keep the folders of
the build before.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ankenmart.operators.fan_out import hot_counts
from ankenmart.operators.layout import RANGE_ROWS, Ranges, clustered, ranges_of
from ankenmart.operators.parts import PART_ROWS, Part
from ankenmart.operators.projection import ident
from ankenmart.plans import quality
from ankenmart.plans.calendar import dim_date
from ankenmart.plans.marts import BY_OPPORTUNITY, MARTS, fact_opportunity_line_item, rows_by_opportunity
from ankenmart.plans.staging import STAGING, staging_layer, staging_sql
from ankenmart.plans.wide import gold_opportunity_line_item_wide, gold_opportunity_wide
from ankenmart.session import shuffles_freed
from ankenmart.sources.raw import LastingSource, Source
from ankenmart.storage import VersionLog, delete

LINE_FACT = "fact_opportunity_line_item"

# Clustering key, then the columns that split a hot key. The two tables of lines come partitioned by ranges of it.
CLUSTERING = {
    LINE_FACT: ("opportunity_id", "line_item_id"),
    "gold_opportunity_wide": ("商談ID",),
    "gold_opportunity_line_item_wide": ("案件ID", "品目ID"),
}

DESCRIPTIONS = {
    "stg_account": "Customer accounts without deleted records",
    "stg_asset": "Delivered units without deleted records",
    "stg_building": "Buildings without deleted records",
    "stg_department": "Departments without deleted records",
    "stg_opportunity": "Opportunities without deleted records",
    "stg_opportunity_asset": "Links of opportunities and assets without deleted records",
    "stg_opportunity_building": "Links of opportunities and buildings without deleted records",
    "stg_opportunity_line_item": "Line items without deleted records",
    "stg_product": "Products without deleted records",
    "stg_record_type": "Active record types",
    "stg_user": "Users",
    "dim_account": "Account dimension",
    "dim_asset": "Asset dimension: delivered units such as lifts",
    "dim_building": "Building dimension: place, size, owner, contractor",
    "dim_date": "Calendar from 2020 to five years ahead, with fiscal columns",
    "dim_department": "Department dimension with its parent and area",
    "dim_product": "Product dimension",
    "dim_record_type": "Record type dimension",
    "dim_user": "User dimension: owners of opportunities",
    "bridge_opportunity_asset": "Opportunity and asset, many to many",
    "bridge_opportunity_building": "Opportunity and building, many to many",
    "fact_opportunity": "One row an opportunity: keys and measures",
    "fact_opportunity_line_item": "One row a line item, and one for each opportunity without any",
    "gold_opportunity_wide": "Opportunity fact with all its dimensions",
    "gold_opportunity_line_item_wide": "Line-item fact with all its dimensions",
}

#: Tests whose failures are reported but hold nothing back: the fact keeps an opportunity without lines.
WARN = frozenset({(LINE_FACT, quality.NOT_NULL)})

BUILT, FAILED, BLOCKED = "built", "failed", "blocked"

#: Builds whose folders are kept, so that a reader of the one before can end.
KEPT = 2

_KEY_COMMENT = "Key: filled and unique"

# Writes that do not depend on each other share the cluster.
PARALLEL_WRITES = 4

RANGED = (LINE_FACT, "gold_opportunity_line_item_wide")


def layer_schema(target: str, layer: str) -> str:
    return f"{target}_{layer}"


@dataclass(frozen=True)
class Build:
    """``marts`` are the published ones, ``status`` tells of each of the 25 models whether this build made it."""

    staging: Mapping[str, DataFrame]
    marts: Mapping[str, DataFrame]
    tests: DataFrame
    status: Mapping[str, str]

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {**self.staging, **self.marts}


class _Inputs(Mapping[str, DataFrame]):
    """Tables that note which of them a model reads."""

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self._tables = tables
        self.read: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        self.read.add(name)
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def _published_log(spark: SparkSession, out: str, target: str) -> VersionLog:
    place = f"{out}/{layer_schema(target, 'marts')}/_published"
    return VersionLog(spark, place, "folders map<string,string>")


def published_folders(spark: SparkSession, out: str, target: str = "analytics") -> dict[str, str]:
    """The folder of each mart as the last entry of the log names it."""
    entry = _published_log(spark, out, target).frame().orderBy(F.col("version").desc()).first()
    return dict(entry.folders) if entry else {}


def published(spark: SparkSession, out: str, target: str = "analytics") -> dict[str, DataFrame]:
    return {model: spark.read.parquet(path) for model, path in published_folders(spark, out, target).items()}


def _publish(spark: SparkSession, out: str, target: str, made: Mapping[str, str]) -> dict[str, str]:
    """Adds the entry that names ``made``, and for all other models the folders of the entry before; deletes the
    folders that only entries older than the last ``KEPT`` name."""
    log = _published_log(spark, out, target)
    while True:
        entries = log.frame().orderBy("version").collect()  # one a build
        folders = {**(entries[-1].folders if entries else {}), **made}
        if log.append((entries[-1].version if entries else 0) + 1, folders=folders):
            break
    kept = {path for e in entries[len(entries) + 1 - KEPT :] for path in e.folders.values()} | set(folders.values())
    before = entries[-KEPT].folders if len(entries) >= KEPT else {}
    for path in set(before.values()) - kept:
        delete(spark, path)
    return folders


def build(
    spark: SparkSession,
    source: Source,
    out: str,
    as_of: dt.date | None = None,
    target: str = "analytics",
    catalog: bool = False,
    warn: Collection[tuple[str, str]] = WARN,
) -> Build:
    """Register the staging views, write and test every mart, publish those below ``out`` that hold.

    Staging stays lazy. Each mart is written once and read back by what builds on it, so a lost executor costs at
    most the running write. The keys of staging are counted while the marts are written; what is then known to
    fail is not built on. ``warn`` has (model, test) whose failure holds nothing back. ``catalog`` also registers
    the marts as tables, and the staging models as views if the source outlasts the session.
    """
    staging = {model: _keyed(model, rows) for model, rows in staging_layer(source).items()}
    for model, rows in staging.items():
        rows.createOrReplaceTempView(model)
    if catalog and isinstance(source, LastingSource):
        _register_views(spark, source, staging, layer_schema(target, "staging"))

    work, build_id = f"{out}/{layer_schema(target, 'marts')}", uuid.uuid4().hex
    made: dict[str, str] = {}
    parents: dict[str, set[str]] = {}
    results: list[Row] = []

    def write(model: str, parts: Sequence[DataFrame]) -> DataFrame:
        path = f"{work}/{model}/build={build_id}"
        for rows in parts:
            if model in RANGED:
                rows = rows.sortWithinPartitions(*CLUSTERING[model])
            elif model in CLUSTERING:
                rows = clustered(rows, *CLUSTERING[model])
            rows.write.mode("append").option("compression", "zstd").parquet(path)
        made[model] = path
        return spark.read.schema(parts[0].schema).parquet(path)

    def write_counts() -> tuple[DataFrame, Ranges]:
        # Both joins to the lines need the hot opportunities and the ranges of all: counted once, then read.
        path = f"{out}/{layer_schema(target, 'work')}/rows_by_opportunity/build={build_id}"
        counts = rows_by_opportunity(staging)
        counts.write.option("compression", "zstd").parquet(path)
        counts = spark.read.schema(counts.schema).parquet(path)
        return hot_counts(counts, "opportunity_id", "lines"), ranges_of(counts, "opportunity_id", "rows")

    def bad() -> set[str]:
        """Models a test of which failed, and all that build on them."""
        out = {r.model for r in results if r.failures and (r.model, r.test) not in warn}
        while more := {m for m, reads in parents.items() if m not in out and reads & out}:
            out |= more
        return out

    with shuffles_freed(spark), ThreadPoolExecutor(PARALLEL_WRITES + 1) as pool:

        def write_all(
            tables: Mapping[str, DataFrame], models: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame | list[DataFrame]]]
        ) -> dict[str, DataFrame]:
            rows, started = {}, {}
            for model, make in models.items():
                inputs = _Inputs(tables)
                of = make(inputs)
                rows[model] = [_keyed(model, part) for part in (of if isinstance(of, list) else [of])]
                parents[model] = inputs.read
            # The wide table has the rows of the line fact, though it joins anew from staging.
            parents.setdefault("gold_opportunity_line_item_wide", set()).add(LINE_FACT)
            for model in models:
                if model not in bad():
                    started[model] = pool.submit(write, model, rows[model])
            # Of a model that is held back only the schema is of use.
            return {model: parts[0] for model, parts in rows.items()} | {model: done.result() for model, done in started.items()}

        testing = pool.submit(lambda: quality.run_tests(staging).collect())  # two rows a model
        counting = pool.submit(write_counts)
        marts = write_all(
            staging,
            {model: make for model, make in MARTS.items() if model != LINE_FACT} | {"dim_date": lambda _: dim_date(spark, as_of)},
        )
        results += testing.result()
        hot, ranges = counting.result()

        def ranged(make: Callable[..., DataFrame]) -> Callable[[Mapping[str, DataFrame]], list[DataFrame]]:
            """The rows of some ranges at a time, of which alone the shuffle files are on disk."""
            some = ranges.parts(max(1, PART_ROWS // RANGE_ROWS))
            return lambda tables: [make(Part(tables, BY_OPPORTUNITY, own), hot=hot, ranges=part) for part, own in some]

        marts |= write_all(
            {**staging, **marts},
            {
                LINE_FACT: ranged(fact_opportunity_line_item),
                "gold_opportunity_line_item_wide": ranged(gold_opportunity_line_item_wide),
                "gold_opportunity_wide": gold_opportunity_wide,
            },
        )
    written = {model: marts[model] for model in made}
    if tested := {model: rows for model, rows in written.items() if model in quality.KEYS}:
        results += quality.run_tests(tested).collect()

    held = bad()
    failed = {r.model for r in results if r.failures and (r.model, r.test) not in warn}
    status = {m: FAILED if m in failed else BLOCKED if m in held else BUILT for m in (*staging, *marts)}
    folders = _publish(spark, out, target, {model: path for model, path in made.items() if model not in held})
    if catalog:
        _register_tables(spark, folders, marts, layer_schema(target, "marts"))
    tests = spark.createDataFrame(results, "model string, column string, test string, failures long")
    ready = {m: written[m] if m in made and m not in held else spark.read.parquet(path) for m, path in folders.items()}
    return Build(staging, ready, tests, status)


def _keyed(model: str, rows: DataFrame) -> DataFrame:
    """The comment of the key column goes with the schema, into Parquet files and catalog tables."""
    if model not in quality.KEYS:
        return rows
    key = quality.KEYS[model]
    return rows.withMetadata(key, {"comment": _KEY_COMMENT})


def _text(words: str) -> str:
    return "'" + words.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _register_views(spark: SparkSession, source: LastingSource, staging: Mapping[str, DataFrame], schema: str) -> None:
    """Catalog views over the raw tables: any session of the catalog reads what is staged then."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(schema)}")
    for model, rows in staging.items():
        table = STAGING[model]
        columns = ", ".join(ident(c) + (f" COMMENT {_text(_KEY_COMMENT)}" if c == table.key else "") for c in rows.columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW {ident(schema)}.{ident(model)} ({columns}) COMMENT {_text(DESCRIPTIONS[model])} "
            f"AS {staging_sql(table, source.relation(table.name))}"
        )


def _register_tables(spark: SparkSession, folders: Mapping[str, str], marts: Mapping[str, DataFrame], schema: str) -> None:
    """Tables over the published folders: made once, then pointed to the folder of each build in one step."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(schema)}")
    for model, path in folders.items():
        table = f"{ident(schema)}.{ident(model)}"
        if spark.catalog.tableExists(table) and spark.table(table).schema == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
            spark.catalog.refreshTable(table)
            continue
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(
            f"{ident(f.name)} {f.dataType.simpleString()}" + (f" COMMENT {_text(f.metadata['comment'])}" if "comment" in f.metadata else "")
            for f in marts[model].schema
        )
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION {_text(path)} COMMENT {_text(DESCRIPTIONS[model])}")


def preview(rows: DataFrame, *columns: str, n: int = 10) -> DataFrame:
    """A first look at a loaded table."""
    return rows.select(*[f"`{c}`" for c in columns]).limit(n)
