"""CSV files as rows of text, by position or by each file's own header.

Spark binds CSV columns to one schema by position, also when the headers of the files
differ in order. Files are therefore grouped by header, and each group is one scan.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ankenmart.operators.projection import ident, renamed
from ankenmart.session import methods_compiled

CORRUPT, FILE = "_corrupt", "_file"

# Encodings Spark's CSV reader takes.
SPARK_ENCODINGS = ("UTF-8", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32", "ISO-8859-1", "US-ASCII")
# Java's names of encodings Spark refuses unless ``JAVA_CHARSETS`` is on. Their second bytes are
# never a comma, a quote or a line end, so the records split at the right places.
JAVA_ENCODINGS = {"WINDOWS932": "windows-31j"}
JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"


@dataclass(frozen=True)
class CsvFormat:
    null: str  # this text is NULL, quoted or not, and so is an empty value
    encoding: str = "UTF-8"
    delimiter: str = ","
    # A quoted value may hold line ends. Turn it off for files known to have none: only
    # then can one file be split among tasks.
    multi_line: bool = True

    def __post_init__(self) -> None:
        known = (*SPARK_ENCODINGS, *JAVA_ENCODINGS)
        if self.encoding.upper() not in known:
            raise ValueError(f"encoding {self.encoding} cannot be read; use one of {', '.join(known)}")
        if self.java and self.delimiter not in (",", "\t", ";"):
            raise ValueError(f"delimiter {self.delimiter!r} may be half a character in {self.encoding}")

    def charset(self, spark: SparkSession) -> str:
        """The encoding as Spark's readers and writers of this session take it."""
        if self.java:
            # For the session, as rows are read later: encode() and decode() then take such names too.
            spark.conf.set(JAVA_CHARSETS, True)
        return self.java or self.encoding

    @property
    def java(self) -> str | None:
        return JAVA_ENCODINGS.get(self.encoding.upper())


# The two formats. One skips its header line, one is matched by it.
BY_POSITION = CsvFormat(null="NULL")
BY_HEADER = CsvFormat(null="null")


def _reader(spark: SparkSession, fmt: CsvFormat) -> DataFrameReader:
    return spark.read.options(
        sep=fmt.delimiter,
        quote='"',
        escape='"',
        encoding=fmt.charset(spark),
        multiLine=fmt.multi_line,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def literal_path(path: str) -> str:
    """The path of one file. Spark would take glob characters in it for a pattern."""
    if re.search(r"[\[\]{}*?]", path):
        raise ValueError(f"rename {path}: its name holds a glob character")
    return path


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Path, length and modification time of the files below a folder; contents stay unread.

    ``pattern`` is a regular expression for the whole path.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    return files if pattern is None else files.where(whole_match(F.col("path"), pattern))


def whole_match(text: Column, pattern: str) -> Column:
    return text.rlike(f"^(?:{pattern})$")


def file_headers(spark: SparkSession, paths: Sequence[str], fmt: CsvFormat) -> DataFrame:
    """``path`` and ``header`` of each file that has a record; names are taken as they stand, an empty one is NULL.

    One job for all files. A record of another width than the schema's comes back whole, so one column is
    enough for any header. A task leaves a file that cannot share it with others after its first record, and
    a split that is not the first of its file at once; files that share a task are no larger than one split.
    """
    alone = _bytes(spark, "spark.sql.files.maxPartitionBytes")
    delimiter = fmt.delimiter

    def first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, last = [], None
        for batch in batches:
            for path, start, size, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != last and not start:
                    names = next(csv.reader(io.StringIO(record, newline=""), delimiter=delimiter))
                    found.append((unquote(path), [n or None for n in names]))
                last = path
                if size >= alone:
                    break
            else:
                continue
            break
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in found], pa.string()), pa.array([h for _, h in found], pa.list_(pa.string()))],
            names=["path", "header"],
        )

    if not paths:
        return spark.createDataFrame([], "path string, header array<string>")
    rows = _reader(spark, fmt).csv(
        [literal_path(p) for p in paths],
        schema=f"c0 string, {CORRUPT} string",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
    return rows.selectExpr(
        "_metadata.file_path AS path",
        "_metadata.file_block_start AS start",
        "_metadata.file_size AS size",
        f"coalesce({CORRUPT}, c0, '') AS record",
    ).mapInArrow(first_records, "path string, header array<string>")


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


def headers(
    spark: SparkSession, paths: Sequence[str], fmt: CsvFormat
) -> dict[tuple[str | None, ...], list[str]]:
    """Files by header. The driver, which plans a scan a header, sees each header once and the names of its files."""
    groups = file_headers(spark, paths, fmt).groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    # Sorted here, as a sort in Spark would read the files a second time for its bounds.
    return {tuple(g.header): g.paths for g in sorted(groups.collect(), key=lambda g: g.paths[0])}


def read_text(
    spark: SparkSession, paths: Sequence[str], width: int, fmt: CsvFormat
) -> DataFrame:
    """Columns ``c0`` to ``c<width-1>``, the record in ``_corrupt`` if it has another width, ``_file``."""
    methods_compiled(spark)
    names = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    rows = _reader(spark, fmt).csv(
        [literal_path(p) for p in paths],
        schema=schema,
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
        nullValue=fmt.null,
        # What the reader makes of a quoted empty value: the text of NULL.
        emptyValue=fmt.null,
    )
    return rows.selectExpr(*names, CORRUPT, f"_metadata.file_path AS {FILE}")


def by_position(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], fmt: CsvFormat = BY_POSITION
) -> DataFrame:
    """All files in one scan; the header line of each is skipped."""
    rows = read_text(spark, paths, len(names), fmt)
    return renamed(rows, [(f"c{i}", n) for i, n in enumerate(names)], CORRUPT, FILE)


def by_header(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], fmt: CsvFormat = BY_HEADER
) -> DataFrame:
    """Wanted columns by exact name; a column a file lacks is NULL, one nobody wants is ignored."""
    scans = []
    for header, files in headers(spark, paths, fmt).items():
        twice = {n for n in header if n is not None and header.count(n) > 1}
        if twice & set(names):
            raise ValueError(f"header of {files[0]} names {', '.join(sorted(twice))} more than once")
        at = {n: i for i, n in enumerate(header)}
        rows = read_text(spark, files, len(header), fmt)
        scans.append(
            rows.selectExpr(
                *[f"{f'c{at[n]}' if n in at else 'cast(NULL AS string)'} AS {ident(n)}" for n in names],
                CORRUPT,
                FILE,
            )
        )
    if not scans:
        return _empty(spark, [*names, CORRUPT, FILE])
    return reduce(DataFrame.union, scans)


def _empty(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
