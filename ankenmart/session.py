"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The business day is the Japanese one; AQE sizes partitions and splits skewed joins at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "Asia/Tokyo",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.legacy.javaCharsets": "true",  # reads Windows-932 files
    "spark.sql.codegen.hugeMethodLimit": "8000",  # the JVM only interprets longer methods
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings; shuffle partitions and memory stay the cluster's choice."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def methods_compiled(spark: SparkSession) -> None:
    """From now on in this session, operators whose joint method would be too long for the JVM to compile run one
    by one, in methods that are split. Rows of dozens of typed or printed columns are such, and interpreted they
    take about twice the time."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each write or collected table go when it is done; else they stay until the
    driver collects its garbage, and a job of many writes fills the disks. What runs twice would shuffle anew."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="ankenmart-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
