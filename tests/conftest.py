from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ankenmart.session import configure  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2026, 7, 31)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        configure(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(shared / "checkpoint"))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from ankenmart.plans.calendar import dim_date
    from ankenmart.plans.marts import MARTS
    from ankenmart.plans.staging import staging_layer
    from fixtures.crm import crm_source

    staging = staging_layer(crm_source(spark, SF_DIR))
    marts = {name: make(staging) for name, make in MARTS.items()}
    return {**staging, **marts, "dim_date": dim_date(spark, AS_OF)}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
