"""Times the headline jobs and prints one JSON line.

The raw CRM tables are made from the Parquet files of ``$BENCH_SF_DIR`` first, untimed.
Each job runs twice and the faster run counts, so that JVM warm-up is not measured.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ankenmart.plans import pipeline, quality
from ankenmart.plans.sales_semantics import LINE_ITEMS, QUESTIONS, answer
from ankenmart.plans.wide import gold_opportunity_line_item_wide, gold_opportunity_wide
from ankenmart.session import configure, scratch_path
from ankenmart.sources.raw import parquet_source
from fixtures.crm import write_raw

AS_OF = dt.date(2026, 7, 31)
RUNS = 2


def seconds(job: Callable[[], object]) -> float:
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def drain(rows: DataFrame) -> None:
    """Compute every row and column, keep none."""
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    source = parquet_source(spark, write_raw(spark, sf_dir, scratch_path(spark, "raw"), int(cpus)))
    out = scratch_path(spark, "build")
    built: list[pipeline.Build] = []

    timings = {"build_all_models": seconds(lambda: built.append(pipeline.build(spark, source, out, AS_OF)))}
    tables = built[-1].tables
    lines = tables["gold_opportunity_line_item_wide"]
    timings["data_tests"] = seconds(lambda: quality.run_tests(tables).collect())
    timings["gold_opportunity_wide"] = seconds(lambda: drain(gold_opportunity_wide(tables)))
    timings["gold_opportunity_line_item_wide"] = seconds(
        lambda: drain(gold_opportunity_line_item_wide(tables))
    )
    for name in QUESTIONS:
        timings[name] = seconds(lambda name=name: answer(lines, name, AS_OF).collect())
    everything = [m.name for m in LINE_ITEMS.metrics]
    timings["metrics_total"] = seconds(lambda: LINE_ITEMS.query(lines, everything).collect())

    result = {
        "metric": "sum of all jobs",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
        "line_items": lines.count(),
    }
    spark.stop()
    print(json.dumps(result, ensure_ascii=False))


if __name__ == "__main__":
    main()
