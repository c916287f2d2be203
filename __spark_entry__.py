"""Entry points of the driver: flagship query, all queries, and their oracles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ankenmart.functions.arrays import array_from_json, array_to_json
from ankenmart.operators.parts import in_parts, parts, write_parts
from ankenmart.operators.projection import ident
from ankenmart.plans import key_state, pipeline, quality, rollups
from ankenmart.plans.calendar import dim_date
from ankenmart.plans.marts import BY_OPPORTUNITY, LINES, MARTS, fact_opportunity_line_item
from ankenmart.plans.sales_semantics import LINE_ITEMS, QUESTIONS, question
from ankenmart.plans.staging import STAGING, staged
from ankenmart.plans.wide import (
    buildings_by_opportunity,
    gold_opportunity_line_item_wide,
    gold_opportunity_wide,
    line_item_wide_by_opportunity,
    write_by_opportunity,
)
from ankenmart.session import scratch_path, shuffles_freed
from ankenmart.sources.csv_text import BY_HEADER, FILE, CsvFormat, file_headers, list_files
from ankenmart.sources.load import (
    CONTINUE,
    WIDE_TYPES,
    force_load,
    inferred_schema,
    loaded,
    read_raw_csv,
    read_wide_csv,
    typed,
    validate,
    wide_text,
    with_arrays,
)
from ankenmart.sources.raw import RAW_TABLES, parquet_source
from ankenmart.storage import delete
from ankenmart.streaming.load_once import copy_raw, load_once
from fixtures import oracles
from fixtures.crm import crm_source
from fixtures.csv_files import ABSENT, BAD_DAYS, ISO, as_text, kept_rows, spoil, write_csv, write_first, write_second

try:
    import corpus_pipeline
    from ankenmart.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "ankenmart.llm"):
        raise
    llm = None

AS_OF = dt.date.fromisoformat(oracles.AS_OF)
Query = Callable[[SparkSession, str], DataFrame]

# One query a metric: name, metric, dimension (a name or a synonym), wide column.
METRIC_QUERIES = (
    ("metric_items_by_phase", "品目件数", "ステージ", "フェーズ"),
    ("metric_opportunities_by_store", "案件数", "店所", "受注店所"),
    ("metric_total_by_customer", "合計金額合計", "取引先", "顧客名（契約先）"),
    ("metric_estimate_by_owner", "見積金額合計", "営業担当", "主担当者"),
    ("metric_offer_by_design_office", "提示金額合計", "設計事務所", "設計事務所"),
    ("metric_profit_by_close_month", "利益合計", "クローズ年月", "クローズ年月"),
    ("metric_units_by_product", "台数合計", "製品名", "商品名"),
    ("metric_profit_ratio_by_record_type", "平均利益率", "レコードタイプ名", "レコードタイプ名"),
    ("metric_won_opportunities_by_department", "受注案件数", "部署", "主担当部署"),
    ("metric_won_amount_by_contract_year", "受注金額合計", "受注予定年度", "受注予定年度"),
)
ALL_METRICS = [m.name for m in LINE_ITEMS.metrics]
FACTS = [f.name for f in LINE_ITEMS.facts]
CROSS_DIMENSIONS = {"受注エリア": "受注エリア", "フェーズ": "フェーズ", "クローズ年四半期": "クローズ年四半期"}


class _Tables(Mapping[str, DataFrame]):
    """Staging and marts over the given tables; a query sets up only those it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        source = crm_source(spark, sf_dir)
        self._make = {name: partial(staged, source, name) for name in STAGING}
        self._make |= {name: partial(make, self) for name, make in MARTS.items()}
        self._make["dim_date"] = partial(dim_date, spark, AS_OF)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)


def _model(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Tables(spark, sf_dir)[name]


def _dim_date_with_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole calendar with the number of opportunities that close on each day."""
    tables = _Tables(spark, sf_dir)
    closes = tables["fact_opportunity"].groupBy("close_date_key").agg(F.count(F.lit(1)).alias("closes"))
    joined = tables["dim_date"].join(closes, F.col("date_key") == F.col("close_date_key"), "left")
    return joined.drop("close_date_key").fillna(0, ["closes"])


def _wide(make: Callable[..., DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return make(_Tables(spark, sf_dir))


def _line_rows(make: Callable[..., DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of lines and their opportunities, made part by part where the lines are many."""
    return in_parts(_Tables(spark, sf_dir), BY_OPPORTUNITY, LINES, make)


def _semantic(arguments: dict, spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = {k: v for k, v in arguments.items() if k in ("metrics", "dimensions", "facts", "where")}
    rows = gold_opportunity_line_item_wide(
        _Tables(spark, sf_dir), labels=LINE_ITEMS.columns_for(**needed)
    )
    return LINE_ITEMS.query(rows, **arguments)


#: Dimensions of the stored rollups; the second comes from the first.
ROLLUPS = ([*CROSS_DIMENSIONS, "クローズ会計年度", "商品ファミリー"], ["受注エリア", "フェーズ", "クローズ会計年度"], ["受注店所", "レコードタイプ名"])


def _from_rollups(arguments: dict, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question answered from rollups stored before, by the smallest that covers it."""
    needed = LINE_ITEMS.columns_for(ALL_METRICS, [d for dimensions in ROLLUPS for d in dimensions])
    parted = parts(_Tables(spark, sf_dir), BY_OPPORTUNITY, LINES)
    rows = [gold_opportunity_line_item_wide(tables, labels=needed) for tables in parted]
    stored = rollups.write_rollups(LINE_ITEMS, rows, ROLLUPS, scratch_path(spark, "rollups"), near=["クローズ年四半期"])
    return rollups.query(spark, LINE_ITEMS, stored, **arguments)


def _tests(test: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_tests(_Tables(spark, sf_dir), test)


def _new_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of all keys by a state of three runs: two thirds of the raw rows, the rest, and the built marts."""
    source, raw, state = crm_source(spark, sf_dir), scratch_path(spark, "raw"), scratch_path(spark, "key-state")
    third = F.pmod(F.xxhash64("Id"), F.lit(3)) == 0
    models = key_state.staging_files(raw)
    for part in (~third, third):
        with shuffles_freed(spark):
            for name in RAW_TABLES:
                source(name).where(part).write.mode("append").option("compression", "zstd").parquet(f"{raw}/{name}")
        key_state.run_new_tests(spark, models, state, buckets=8)
    out = scratch_path(spark, "build")
    pipeline.build(spark, parquet_source(spark, raw), out, AS_OF)
    marts = key_state.mart_files(pipeline.published_folders(spark, out))
    return key_state.run_new_tests(spark, models | marts, state, quality.UNIQUE, buckets=8)


def _json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The building arrays to JSON text and back."""
    rows = buildings_by_opportunity(_Tables(spark, sf_dir))
    arrays = [c for c in rows.columns if c != "opportunity_id"]
    text = rows.withColumns({c: array_to_json(F.col(c)) for c in arrays})
    return text.withColumns({c: array_from_json(F.col(c)) for c in arrays})


@contextmanager
def _line_text(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """All lines as text, for exports to be written inside: their joins run once, and what they gave is deleted then."""
    tables, place = _Tables(spark, sf_dir), scratch_path(spark, "lines")
    try:
        yield as_text(write_parts(parts(tables, BY_OPPORTUNITY, LINES), gold_opportunity_line_item_wide, place))
    finally:
        delete(spark, place)


def _write_exports(spark: SparkSession, sf_dir: str, folder: str) -> None:
    with _line_text(spark, sf_dir) as text:
        write_first(text, folder)
        write_second(text, folder)


def _paths(spark: SparkSession, folder: str) -> list[str]:
    return [r.path for r in list_files(spark, folder, r".*\.csv(\.gz)?").select("path").collect()]


def _load_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files whose headers differ, as one typed table; times as UTC text."""
    folder = scratch_path(spark, "whole")
    _write_exports(spark, sf_dir, folder)
    rows = read_wide_csv(spark, _paths(spark, folder))
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = [n for n, kind in WIDE_TYPES.items() if kind == "timestamp"]
    return rows.withColumns(
        {n: F.date_format(F.to_utc_timestamp(F.col(n), zone), ISO) for n in times}
    )


def _spoilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "spoilt")
    with _line_text(spark, sf_dir) as text:
        write_csv(spoil(text), folder, "null", "gzip")
    return wide_text(spark, _paths(spark, folder))


def _load_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = validate(_spoilt(spark, sf_dir), WIDE_TYPES)
    return errors.groupBy("column", "value").agg(F.count(F.lit(1)).alias("errors"))


def _load_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("フェーズ").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("品目ID").alias("items"),
        F.sum("合計金額").cast("decimal(38,2)").alias("total"),
    )


def _load_continue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_totals(typed(_spoilt(spark, sf_dir), WIDE_TYPES, CONTINUE))


def _load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the first files, run again without new ones, add the other files, run again."""
    folder, out = scratch_path(spark, "arriving"), scratch_path(spark, "loaded")
    pattern = r".*\.csv(\.gz)?"
    with _line_text(spark, sf_dir) as text:
        write_first(text, folder)
        load_once(spark, folder, out, pattern)
        load_once(spark, folder, out, pattern)
        write_second(text, folder)
    load_once(spark, folder, out, pattern)
    return _load_totals(loaded(spark, out))


def _load_second_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with a narrow pattern, then one with a wide one: no file is lost to the first."""
    folder, out = scratch_path(spark, "patterns"), scratch_path(spark, "loaded")
    _write_exports(spark, sf_dir, folder)
    load_once(spark, folder, out, r".*/first/.*\.csv(\.gz)?")
    load_once(spark, folder, out, r".*\.csv(\.gz)?")
    return _load_totals(loaded(spark, out))


def _load_two_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with a history each, loaded into one table."""
    folder, out = scratch_path(spark, "histories"), scratch_path(spark, "loaded")
    _write_exports(spark, sf_dir, folder)
    for name in ("first", "second"):
        load_once(spark, f"{folder}/{name}", out, r".*\.csv(\.gz)?", checkpoint=scratch_path(spark, f"history-{name}"))
    return _load_totals(loaded(spark, out))


def _load_concurrently(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs started together over the same files: each row is there once."""
    folder, out = scratch_path(spark, "together"), scratch_path(spark, "loaded")
    _write_exports(spark, sf_dir, folder)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda _: load_once(spark, folder, out, r".*\.csv(\.gz)?", files_per_batch=2), range(3)))
    return _load_totals(loaded(spark, out))


def _headers_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headers of the files of two exports, name by name, and the rows of the files of each."""
    folder = scratch_path(spark, "headers")
    _write_exports(spark, sf_dir, folder)
    paths = _paths(spark, folder)
    files = file_headers(spark, paths, BY_HEADER)
    rows = wide_text(spark, paths).groupBy(F.url_decode(FILE).alias("path")).agg(F.count(F.lit(1)).alias("n"))
    by_header = files.join(rows, "path", "left").groupBy("header").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    return by_header.select("row_count", F.posexplode("header").alias("place", "name"))


def _load_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files loaded twice: every row is there twice."""
    folder, out = scratch_path(spark, "forced"), scratch_path(spark, "loaded")
    _write_exports(spark, sf_dir, folder)
    for _ in range(2):
        force_load(spark, folder, out, r".*\.csv(\.gz)?")
    return _load_totals(loaded(spark, out))


def _loaded_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The building columns of loaded files, parsed, counted by state."""
    folder = scratch_path(spark, "arrays")
    _write_exports(spark, sf_dir, folder)
    rows = with_arrays(read_wide_csv(spark, _paths(spark, folder)))
    return rows.select(F.explode_outer("建物都道府県").alias("state")).groupBy("state").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _load_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw buildings as positional CSV, loaded back as the raw table."""
    folder = scratch_path(spark, "building")
    write_csv(as_text(crm_source(spark, sf_dir)("building__c")), folder, "NULL")
    return read_raw_csv(spark, "building__c", _paths(spark, folder))


def _load_raw_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw buildings copied from positional CSV, twice: the second run adds nothing."""
    folder, out = scratch_path(spark, "building"), scratch_path(spark, "raw")
    write_csv(as_text(crm_source(spark, sf_dir)("building__c")), folder, "NULL")
    for _ in range(2):
        copy_raw(spark, "building__c", folder, out, pattern=r".*\.csv")
    return parquet_source(spark, out)("building__c")


def _load_windows_932(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as compressed Windows-932 files, read line by line."""
    folder, fmt = scratch_path(spark, "windows"), CsvFormat("null", "WINDOWS932", multi_line=False)
    with _line_text(spark, sf_dir) as text:
        write_csv(text, folder, "null", "gzip", encoding=fmt.charset(spark))
    return _load_totals(read_wide_csv(spark, _paths(spark, folder), fmt=fmt))


def _staged_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files written by phase, found again by listing: the phases with at least one file."""
    folder = scratch_path(spark, "staged")
    text = as_text(gold_opportunity_wide(_Tables(spark, sf_dir))).withColumnRenamed("フェーズ", "phase")
    text.write.partitionBy("phase").csv(folder, header=True)
    files = list_files(spark, folder, r".*/phase=[^/]+/[^/]+\.csv").where("length > 0")
    phase = F.url_decode(F.regexp_extract("path", "phase=([^/]+)/", 1))
    return files.select(phase.alias("phase")).distinct()


def _inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types of the opportunity wide table as its CSV values show them, in files of two column orders."""
    folder = scratch_path(spark, "inferred")
    text = kept_rows(as_text(gold_opportunity_wide(_Tables(spark, sf_dir))))
    won = F.coalesce(F.col("受注済み") == "true", F.lit(False))
    write_csv(text.where(won), f"{folder}/first", "null", "gzip")
    write_csv(text.where(~won).select(*[F.col(ident(c)) for c in reversed(text.columns)]), f"{folder}/second", "null", "gzip")
    schema = inferred_schema(spark, _paths(spark, folder))
    found = [(f.name, f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame(found, "name string, type string")


def _wide_by_opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line-item wide table from tables written by opportunity; opportunities above five lines are split."""
    location = scratch_path(spark, "by-opportunity")
    name = "by_opportunity_" + location[-12:]
    write_by_opportunity(_Tables(spark, sf_dir), name, location, buckets=8, slice_rows=5)
    return line_item_wide_by_opportunity(spark, name)


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold_opportunity_line_item_wide(
        _Tables(spark, sf_dir), labels=["品目ID", "案件名", "商品名", "合計金額", "クローズ日"]
    )
    ordered = rows.orderBy(F.col("品目ID").asc_nulls_last())
    return pipeline.preview(ordered, "品目ID", "案件名", "商品名", "合計金額", "クローズ日")


def _built_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, written and read back: rows of each of its 25 models."""
    built = pipeline.build(spark, crm_source(spark, sf_dir), scratch_path(spark, "build"), AS_OF)
    return reduce(DataFrame.unionByName, [_count(rows, model) for model, rows in built.tables.items()])


def _count(rows: DataFrame, model: str, *more: Column) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(model).alias("model"), "row_count", *more)


def _repeated_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build from raw tables with an account there twice: what became of each model, and rows of those that stand."""
    source = crm_source(spark, sf_dir)

    def repeating(name: str) -> DataFrame:
        rows = source(name)
        return rows.unionByName(rows.orderBy("Id").limit(1)) if name == "account" else rows

    built = pipeline.build(spark, repeating, scratch_path(spark, "held"), AS_OF)
    rows = [
        _count(built.tables[model], model, F.lit(status).alias("status"))
        if model in built.tables
        else spark.range(1).select(F.lit(model).alias("model"), F.lit(None).cast("long").alias("row_count"), F.lit(status).alias("status"))
        for model, status in built.status.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _marts_after_a_dying_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build, then one over half the accounts that dies at the lines: rows of the marts published after both."""
    source, out = crm_source(spark, sf_dir), scratch_path(spark, "published")
    pipeline.build(spark, source, out, AS_OF)

    def dying(name: str) -> DataFrame:
        rows = source(name)
        if name == "account":
            return rows.where(F.pmod(F.xxhash64("Id"), F.lit(2)) == 0)
        return rows.where(F.raise_error(F.lit("the job dies here")).isNull()) if name == "opportunitylineitem" else rows

    try:
        pipeline.build(spark, dying, out, AS_OF)
    except Exception as died:
        if "the job dies here" not in str(died):
            raise
    return reduce(DataFrame.unionByName, [_count(rows, model) for model, rows in pipeline.published(spark, out).items()])


def entry(spark: SparkSession) -> DataFrame:
    """Opportunities, total and won amount by fiscal year of the close date."""
    return queries()["sales_by_close_fiscal_year"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: partial(_model, name) for name in (*STAGING, *MARTS)}
    out["dim_date_with_closes"] = _dim_date_with_closes
    out["gold_opportunity_wide"] = partial(_wide, gold_opportunity_wide)
    for make in (fact_opportunity_line_item, gold_opportunity_line_item_wide):
        out[make.__name__] = partial(_line_rows, make)
    out["buildings_by_opportunity"] = partial(_wide, buildings_by_opportunity)
    out["wide_from_tables_by_opportunity"] = _wide_by_opportunity
    for name, metric, dimension, _ in METRIC_QUERIES:
        out[name] = partial(_semantic, dict(metrics=[metric], dimensions=[dimension]))
    out["metrics_total"] = partial(_semantic, dict(metrics=ALL_METRICS))
    out["metrics_by_area_phase_quarter"] = partial(
        _semantic, dict(metrics=ALL_METRICS, dimensions=list(CROSS_DIMENSIONS))
    )
    out["rollup_metrics_by_area_phase_quarter"] = partial(
        _from_rollups, dict(metrics=ALL_METRICS, dimensions=list(CROSS_DIMENSIONS))
    )
    out["rollup_metrics_by_phase_in_two_years"] = partial(
        _from_rollups, dict(metrics=ALL_METRICS, dimensions=["フェーズ"], where={"クローズ会計年度": [2023, 2024]})
    )
    out["facts_by_line"] = partial(_semantic, dict(facts=FACTS, dimensions=["案件ID", "フェーズ", "customer"]))
    for name in QUESTIONS:
        out[name] = partial(_semantic, question(name, AS_OF))
    out["dq_not_null_all"] = partial(_tests, quality.NOT_NULL)
    out["dq_unique_all"] = partial(_tests, quality.UNIQUE)
    out["dq_unique_of_new_files"] = _new_tests
    out["json_arrays"] = _json_arrays
    out["load_by_header"] = _load_by_header
    out["load_validate"] = _load_validate
    out["load_continue"] = _load_continue
    out["load_once"] = _load_once
    out["load_second_pattern"] = _load_second_pattern
    out["load_two_histories"] = _load_two_histories
    out["load_concurrently"] = _load_concurrently
    out["headers_of_files"] = _headers_of_files
    out["load_force"] = _load_force
    out["load_arrays"] = _loaded_arrays
    out["load_by_position"] = _load_by_position
    out["load_raw_once"] = _load_raw_once
    out["load_windows_932"] = _load_windows_932
    out["staged_folders"] = _staged_folders
    out["inferred_types"] = _inferred_types
    out["preview_line_item_wide"] = _preview
    out["row_counts_of_built_models"] = _built_row_counts
    out["build_with_a_repeated_account"] = _repeated_account
    out["marts_after_a_dying_build"] = _marts_after_a_dying_build
    if llm:
        out |= llm.QUERIES
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    o, wide = oracles, oracles.LINE_WIDE
    out = {name: o.model(name) for name in (*STAGING, *MARTS)}
    out["dim_date_with_closes"] = o.with_models(
        "SELECT d.*, coalesce(c.n, 0) AS closes FROM dim_date d LEFT JOIN "
        "(SELECT close_date_key AS k, count(*) AS n FROM fact_opportunity GROUP BY close_date_key) c "
        "ON d.date_key = c.k"
    )
    for name in ("gold_opportunity_wide", wide, "buildings_by_opportunity"):
        out[name] = o.model(name)
    out["wide_from_tables_by_opportunity"] = o.model(wide)
    out["json_arrays"] = o.model("buildings_by_opportunity")
    for name, metric, dimension, column in METRIC_QUERIES:
        out[name] = o.metrics([metric], {LINE_ITEMS.dimension(dimension).name: column})
    out["metrics_total"] = o.metrics(ALL_METRICS)
    out["metrics_by_area_phase_quarter"] = o.metrics(ALL_METRICS, CROSS_DIMENSIONS)
    out["rollup_metrics_by_area_phase_quarter"] = out["metrics_by_area_phase_quarter"]
    out["rollup_metrics_by_phase_in_two_years"] = o.metrics(
        ALL_METRICS, {"フェーズ": "フェーズ"}, where=' WHERE "クローズ会計年度" IN (2023, 2024)'
    )
    out["facts_by_line"] = o.with_models(
        'SELECT "案件ID", "フェーズ", "顧客名（契約先）" AS "顧客名", '
        + ", ".join(f'"{f}"' for f in FACTS)
        + f" FROM {wide}"
    )
    out["won_amount_this_fiscal_year"] = o.metrics(
        ["受注金額合計"], where=' WHERE "クローズ会計年度" = 2026'
    )
    out["opportunities_and_won_amount_by_area"] = o.metrics(
        ["案件数", "受注金額合計"], {"受注エリア": "受注エリア"}
    )
    out["mean_profit_ratio_by_product_family"] = o.metrics(
        ["平均利益率"], {"商品ファミリー": "商品ファミリー"}
    )
    out["estimate_by_phase_largest_first"] = o.metrics(["見積金額合計"], {"フェーズ": "フェーズ"})
    out["sales_by_close_fiscal_year"] = o.metrics(
        ["案件数", "合計金額合計", "受注金額合計"], {"クローズ会計年度": "クローズ会計年度"}
    )
    out["dq_not_null_all"] = o.not_null_failures()
    out["dq_unique_all"] = out["dq_unique_of_new_files"] = o.unique_failures()
    out["load_by_header"] = o.loaded_wide(ABSENT)
    spoilt = [("利益", "n/a", "5"), *(("クローズ日", bad, line) for line, bad in BAD_DAYS.items())]
    out["load_validate"] = o.with_models(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{column}' AS \"column\", '{bad}' AS value, count(*) FILTER (WHERE \"表示順\" = {line}) AS errors FROM {wide}"
            for column, bad, line in spoilt
        )
        + ") WHERE errors > 0"
    )
    totals = (
        'SELECT "フェーズ", count(*){0} AS row_count, count("品目ID"){0} AS items, '
        'cast(sum("合計金額"){0} AS decimal(38,2)) AS total FROM {1} {2} GROUP BY "フェーズ"'
    )
    out["load_continue"] = o.with_models(
        totals.format("", wide, 'WHERE "表示順" IS NULL OR "表示順" NOT IN (2, 3, 4, 5, 6)')
    )
    out["load_once"] = o.with_models(totals.format("", wide, ""))
    out["load_second_pattern"] = out["load_two_histories"] = out["load_concurrently"] = out["load_once"]
    out["headers_of_files"] = o.headers(ABSENT)
    out["load_force"] = o.with_models(totals.format(" * 2", wide, ""))
    out["load_arrays"] = o.with_models(
        "SELECT state, count(*) AS row_count FROM (SELECT unnest(CASE WHEN len(\"建物都道府県\") > 0 "
        f'THEN "建物都道府県" ELSE [NULL] END) AS state FROM {wide}) '
        "GROUP BY state"
    )
    out["load_by_position"] = out["load_raw_once"] = o.raw("building__c")
    out["load_windows_932"] = out["load_once"]
    out["staged_folders"] = o.with_models('SELECT DISTINCT "フェーズ" AS phase FROM gold_opportunity_wide')
    out["inferred_types"] = o.inferred_types()
    out["preview_line_item_wide"] = o.with_models(
        f'SELECT "品目ID", "案件名", "商品名", "合計金額", "クローズ日" FROM {wide} '
        'ORDER BY "品目ID" NULLS LAST LIMIT 10'
    )
    out["row_counts_of_built_models"] = o.row_counts()
    out["build_with_a_repeated_account"] = o.held_back(
        failed=("stg_account", "dim_account"), blocked=("gold_opportunity_wide", wide), one_more="stg_account"
    )
    out["marts_after_a_dying_build"] = o.row_counts(*MARTS, "dim_date", "gold_opportunity_wide", wide)
    if llm:
        out |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
