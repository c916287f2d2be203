"""A job over tables that share a key, done part by part, so that the shuffle files of one part at a time are on disk.

A part has the rows of some keys from each of the tables that have the key; other tables are whole in each. The parts
are disjoint and together all rows, so a job whose rows each come from rows of one key gives the same rows in parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ankenmart.session import scratch_path, shuffles_freed

#: Rows of a part, from each of which a join of wide rows has some 600 bytes on disk.
PART_ROWS = 12_000_000

Tables = Mapping[str, DataFrame]


class Part(Mapping[str, DataFrame]):
    """The tables, those in ``keys`` cut to the rows whose key, the column named there, is of the part."""

    def __init__(self, tables: Tables, keys: Mapping[str, str], own: Callable[[Column], Column]) -> None:
        self._tables, self._keys, self._own = tables, keys, own

    def __getitem__(self, name: str) -> DataFrame:
        rows = self._tables[name]
        return rows.where(self._own(F.col(self._keys[name]))) if name in self._keys else rows

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def parts(tables: Tables, keys: Mapping[str, str], largest: str, part_rows: int = PART_ROWS) -> list[Tables]:
    """Parts of about ``part_rows`` rows of the table ``largest``, by a hash of the key; NULL is a key too."""
    n = -(-tables[largest].count() // part_rows)
    if n <= 1:
        return [tables]
    return [Part(tables, keys, lambda key, i=i: F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def write_parts(parted: list[Tables], make: Callable[[Tables], DataFrame], path: str) -> DataFrame:
    """The rows ``make`` gives for each of the parts, written one part after another."""
    each = [make(tables) for tables in parted]
    spark = each[0].sparkSession
    with shuffles_freed(spark):
        for rows in each:
            rows.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(each[0].schema).parquet(path)


def in_parts(
    tables: Tables, keys: Mapping[str, str], largest: str, make: Callable[[Tables], DataFrame], part_rows: int = PART_ROWS
) -> DataFrame:
    """What ``make`` gives over the tables. More than one part is written to the scratch folder and read back."""
    parted = parts(tables, keys, largest, part_rows)
    if len(parted) == 1:
        return make(tables)
    return write_parts(parted, make, scratch_path(tables[largest].sparkSession, "parts"))
