"""Helpers the corpus operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ankenmart.session import scratch_path

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(rows: DataFrame, label: str) -> DataFrame:
    """The rows written below the shared folder and read back: a cut of the lineage that outlives executors."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Bucketed:
    """A table below the shared folder whose rows are bucketed by a key, as many as the session has shuffle
    partitions: what is grouped by the key, or cogrouped with another such table, is not shuffled again."""

    def __init__(self, spark: SparkSession, label: str, key: str) -> None:
        self.spark, self.key, self.path = spark, key, scratch_path(spark, label)
        self.name = "default.bucketed_" + self.path.rpartition("-")[2]
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, rows: DataFrame, dealt: bool = True) -> DataFrame:
        """All rows with these. ``dealt`` shuffles them by the key first, so that a bucket gets one file more and
        not one from each task; rows whose tasks have few keys each can do without."""
        rows = rows.repartition(self.buckets, self.key) if dealt else rows
        writer = rows.write.mode("append").format("parquet").option("path", self.path)
        writer.bucketBy(self.buckets, self.key).saveAsTable(self.name)
        return self.spark.table(self.name)


def release(spark: SparkSession) -> None:
    """Shuffle files of plans nobody holds any more go when the driver collects its garbage: let it."""
    gc.collect()
    spark._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no plan reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def id_crc32(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def _digits(number: Column) -> Column:
    """A long as 16 hex digits, so that texts compare as the numbers do."""
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def order_key(id_: Column, text: Column, descending: bool = False) -> Column:
    """The place of a row as text: ids ascending after the rows without id, or the reverse; then a hash of the text."""
    number = F.bitwise_not(id_.cast("long")) if descending else id_.cast("long")
    first, last = ("0", "1") if descending else ("1", "0")
    number = F.coalesce(number, F.lit(0).cast("long"))
    return F.concat(F.when(id_.isNull(), last).otherwise(first), _digits(number), _digits(F.xxhash64(text)))


def key_starts(keys: DataFrame, held: int, most: int) -> list[str]:
    """Every ``held``-th ``key`` in order, and the first of each range the sort is dealt into: a key that is listed
    twice has more rows than ``held``. More rows are held where there would be over ``most`` keys, so that not many
    more than that come to the driver."""
    n = keys.count()
    held = max(held, -(-n // most))
    ranges = keys.repartitionByRange(n // (64 * held) + 1, "key").sortWithinPartitions("key")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # counted within the range
    listed = ranges.withColumn("row", row).where(F.col("row") % held == 0).select("key").collect()
    return sorted(r["key"] for r in listed)


def starts_before(key: str, starts: Column, n: int, equal: bool = True) -> Column:
    """How many of the n sorted starts are below the key, or equal: steps of halving length."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(n.bit_length()))))
    begin = F.struct(F.col(key).alias("key"), F.lit(0).alias("at"))

    def step(state: Column, width: Column) -> Column:
        further = state["at"] + width
        start = F.get(starts, further - 1)
        below = start <= state["key"] if equal else start < state["key"]
        return F.struct(state["key"].alias("key"), F.when(below, further).otherwise(state["at"]).alias("at"))

    return F.aggregate(steps, begin, step, lambda state: state["at"])


def lower_words(text: str | None) -> list[bytes]:
    """Words as UTF-8, A-Z lowered; bytes.lower and bytes.split know ASCII only, as wanted."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def slices(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of at most so many."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]
