"""CSV files that Spark writes from the driver's tables, as input of the load queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ankenmart.operators.projection import ident
from ankenmart.session import methods_compiled, scratch_path

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

#: A compressed file is one task.
FILE_RECORDS = 500_000

# Left out of the second file, which also has a column nobody asks for.
ABSENT = ("配送モデル", "増減額", "クローズ済み")


def _text(field: T.StructField) -> str:
    value = ident(field.name)
    if isinstance(field.dataType, T.ArrayType):
        value = f"to_json({value})"
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        quoted_iso = ISO.replace("'", "\\'")
        value = f"date_format({value}, '{quoted_iso}')"
    return f"cast({value} AS string) AS {ident(field.name)}"


def as_text(rows: DataFrame) -> DataFrame:
    methods_compiled(rows.sparkSession)
    return rows.selectExpr(*[_text(f) for f in rows.schema])


def write_csv(rows: DataFrame, path: str, null: str, compression: str = "none", encoding: str = "UTF-8") -> None:
    rows.write.mode("overwrite").option("maxRecordsPerFile", FILE_RECORDS).csv(
        path, header=True, nullValue=null, emptyValue="", escape='"', compression=compression, encoding=encoding
    )


def kept_rows(rows: DataFrame) -> DataFrame:
    """The rows as Parquet of the scratch folder, for input that several exports share: its joins run once."""
    place = scratch_path(rows.sparkSession, "kept")
    rows.write.option("compression", "zstd").parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def write_first_and_second(text: DataFrame, folder: str) -> None:
    kept = kept_rows(text)
    write_first(kept, folder)
    write_second(kept, folder)


def write_first(text: DataFrame, folder: str) -> None:
    """The won rows: columns in order, NULL as ``null``, gzip."""
    write_csv(text.where(F.col("受注済み") == "true"), f"{folder}/first", "null", "gzip")


def write_second(text: DataFrame, folder: str) -> None:
    """All other rows: columns reversed, three absent, one more, NULL as empty, gzip."""
    rest = text.where(~F.coalesce(F.col("受注済み") == "true", F.lit(False)))
    names = [c for c in reversed(text.columns) if c not in ABSENT]
    rows = rest.select(F.lit("x").alias("余分"), *[F.col(f"`{c}`") for c in names])
    write_csv(rows, f"{folder}/second", "", "gzip")


#: Line number to what stands there for a date.
BAD_DAYS = {"2": "12:30", "3": "2024-13-01", "4": "2024-02", "6": "2024-01-01 junk"}


def spoil(text: DataFrame) -> DataFrame:
    """Bad numbers in the fifth lines, bad dates in the second, third, fourth and sixth."""
    day = F.col("クローズ日")
    for line, bad in BAD_DAYS.items():
        day = F.when(F.col("表示順") == line, F.lit(bad)).otherwise(day)
    return text.withColumns(
        {
            "利益": F.when(F.col("表示順") == "5", F.lit("n/a")).otherwise(F.col("利益")),
            "クローズ日": day,
        }
    )
