"""Files of shared storage, by Hadoop's file systems, and logs that several jobs write without losing an entry."""

from __future__ import annotations

import json
import os
import time
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """The file or folder with all below it, if it is there."""
    where, fs = _path(spark, path)
    fs.delete(where, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder, in order; none if there is no such folder."""
    where, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call created the file, whole; one of several callers does.

    The text is written under another name first, which readers skip, and then gets its name in one step: by a
    hard link on a local file system, by a rename that does not replace on others. The second is one step on HDFS and on
    stores with its semantics; on an object store it takes one whose committer refuses to replace.
    """
    folder, _, name = path.rpartition("/")
    hidden, fs = _path(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(hidden.toUri().getPath(), spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath())
            except FileExistsError:
                return False
            return True
        return _renamed(spark, hidden, path)
    finally:
        fs.delete(hidden, False)


def _renamed(spark: SparkSession, hidden, path: str) -> bool:
    """Whether the file got the name, which nothing may have."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), spark._jsc.hadoopConfiguration())
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(hidden, jvm.org.apache.hadoop.fs.Path(path), options)
    except Py4JJavaError as refused:
        if "FileAlreadyExists" in str(refused.java_exception):
            return False
        raise
    return True


class VersionLog:
    """Entries numbered from 1 on, a small file each in one folder, that several jobs may add to.

    An entry is created only if its number is free, so a job that decides by the entries up to a number and then
    gets the next one knows that no other entry came between.
    """

    def __init__(self, spark: SparkSession, folder: str, fields: str) -> None:
        self.spark, self.folder, self.fields = spark, folder, fields

    def frame(self) -> DataFrame:
        """All entries with their ``version``."""
        if not names(self.spark, self.folder):
            return self.spark.createDataFrame([], f"{self.fields}, version long")
        rows = self.spark.read.schema(self.fields).json(f"{self.folder}/*.json")
        return rows.withColumn("version", F.substring_index("_metadata.file_name", ".", 1).cast("long"))

    def last(self) -> int:
        found = [n for n in names(self.spark, self.folder) if n.endswith(".json") and n[0] != "_"]
        return int(found[-1].split(".")[0]) if found else 0

    def entry(self, version: int) -> Row:
        """The entry of this number, which is there."""
        return self.spark.read.schema(self.fields).json(f"{self.folder}/{version:020d}.json").first()

    def append(self, version: int, **entry: Any) -> bool:
        """Whether the entry got this number."""
        return create_if_absent(self.spark, f"{self.folder}/{version:020d}.json", json.dumps(entry))

    def add(self, **entry: Any) -> int:
        """Adds an entry that holds whatever came before it; its number."""
        while True:
            version = self.last() + 1
            if self.append(version, **entry):
                return version
            time.sleep(0.05)
