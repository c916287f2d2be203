"""Token ids in Arrow files of fixed-size lists.

A file of sequences holds record batches of two fixed-size-list columns, ``ids`` and ``mask``, each
list ``sequence`` long: the documents of a key range back to back, the last list padded and masked.
Equal lengths make any sequence an address: batch ``i // batch``, row ``i % batch``, read without
copying. A second file has each document's key, its start in the file and its length. Ids are 16 bits
wide where the vocabulary allows, else 32.

Cases: a null text is empty and gives its end id alone; null keys come first; rows of equal keys are
ordered by a hash of the text and may span files, also if the texts are equal; an empty table gives no files; other columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ankenmart.llm.common import key_starts, order_key, saved, slices, starts_before, text_of
from ankenmart.llm.tokens import END_ID, TOKENIZER, encoder
from ankenmart.session import scratch_path

SEQUENCE = 2048
BATCH = 1024
FILE_DOCS = 8192
#: Beyond this many files, files hold more documents.
MOST_FILES = 200_000


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


class SequenceWriter:
    """Appends ids and writes a batch whenever one is full."""

    def __init__(self, sink, kind: str, sequence: int, batch: int) -> None:
        self.kind, self.sequence, self.step = np.dtype(kind), sequence, sequence * batch
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(self.kind), sequence)),
                ("mask", pa.list_(pa.bool_(), sequence)),
            ],
            {"sequence": str(sequence), "batch": str(batch)},
        )
        self.out = ipc.new_file(sink, self.schema)
        self.waiting, self.total = bytearray(), 0

    def append(self, ids: bytes) -> None:
        self.waiting += ids
        self.total += len(ids) // self.kind.itemsize
        size = self.step * self.kind.itemsize
        while len(self.waiting) >= size:
            self._write(np.frombuffer(bytes(self.waiting[:size]), self.kind), self.step)
            del self.waiting[:size]

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(a, self.sequence) for a in (pa.array(ids), mask)]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            ids = np.frombuffer(bytes(self.waiting), self.kind)
            padded = np.zeros(-(-len(ids) // self.sequence) * self.sequence, self.kind)
            padded[: len(ids)] = ids
            self._write(padded, len(ids))
        self.out.close()


class SequenceReader:
    """Random access to sequences and to runs of ids."""

    def __init__(self, source) -> None:
        self.file = ipc.open_file(source)
        meta = self.file.schema.metadata
        self.sequence, self.batch = int(meta[b"sequence"]), int(meta[b"batch"])
        self.at, self.flat = -1, None

    def _ids(self, batch: int) -> np.ndarray:
        if batch != self.at:
            self.flat = self.file.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
            self.at = batch
        return self.flat

    def sequence_at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence."""
        batch, row = divmod(i, self.batch)
        rows = self.file.get_batch(batch)
        lists = [rows.column(c).slice(row, 1).flatten() for c in (0, 1)]
        return lists[0].to_numpy(), lists[1].to_numpy(zero_copy_only=False)

    def run(self, start: int, length: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, in views of one batch each."""
        step = self.sequence * self.batch
        while length:
            batch, offset = divmod(start, step)
            part = self._ids(batch)[offset : offset + length]
            yield part
            start, length = start + len(part), length - len(part)


def write_token_files(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    sequence: int = SEQUENCE,
    batch: int = BATCH,
    file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Write the files; return the manifest: file, sequences, documents (paths), n_docs, n_tokens.

    ``folder`` is a place every executor reaches. Keys are sorted first and cut into files of ``file_docs`` rows,
    by a hash of the text too if a key alone has more; texts are encoded where they are read, and only 16-bit ids
    are shuffled. Each attempt of a task writes names of its own and the manifest lists those of the attempt that
    counted, so a lost executor leaves no mix.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    for told_by in (F.lit(""), F.col("text")):
        keyed = rows.withColumn("key", order_key(F.col("id"), told_by))
        listed = key_starts(saved(keyed.select("key"), "keys"), file_docs, MOST_FILES)
        repeated = len(set(listed)) < len(listed)
        if not repeated:
            break
    files = max(1, len(listed))
    starts = F.split(F.lit(",".join(listed or [""])), ",")
    wide = encoder(tokenizer).vocabulary > 1 << 16
    kind, code = ("<u4", "I") if wide else ("<u2", "H")
    end = np.array([END_ID], kind).tobytes()

    def tokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, code).encode
        for frame in slices(frames, 1024):
            ids = [i + end for i in encode(frame["text"].tolist())]
            yield pd.DataFrame({"file": frame["file"], "key": frame["id"], "hash": frame["hash"], "ids": ids})

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _place(folder)
        system.create_dir(root, recursive=True)
        open_file, writer, index, names = None, None, [], []

        def finish() -> pd.DataFrame:
            writer.close()
            with system.open_output_stream(f"{root}/{names[1]}") as sink:
                table = pa.table(
                    {"key": pa.array([x[0] for x in index], pa.int64()), "start": [x[1] for x in index], "n_tokens": [x[2] for x in index]}
                )
                with ipc.new_file(sink, table.schema) as out:
                    out.write_table(table, max_chunksize=65_536)
            stream.close()
            return pd.DataFrame(
                [(open_file, *(f"{folder}/{n}" for n in names), len(index), writer.total)],
                columns=["file", "sequences", "documents", "n_docs", "n_tokens"],
            )

        for frame in frames:
            for file, id_, ids in frame[["file", "key", "ids"]].itertuples(index=False, name=None):
                if file != open_file:
                    if writer:
                        yield finish()
                    tag = f"{file:08d}-{uuid.uuid4().hex}.arrow"
                    open_file, index, names = file, [], [f"sequences-{tag}", f"documents-{tag}"]
                    stream = system.open_output_stream(f"{root}/{names[0]}")
                    writer = SequenceWriter(stream, kind, sequence, batch)
                index.append((None if pd.isna(id_) else int(id_), writer.total, len(ids) // writer.kind.itemsize))
                writer.append(ids)
        if writer:
            yield finish()

    file = starts_before("key", starts, files) - 1
    if repeated:  # A key that several files start with has only equal rows: they are dealt by their number in the task's input.
        first = starts_before("key", starts, files, equal=False)
        dealt = first + F.monotonically_increasing_id() % (file + 1 - first)
        file = F.when(file >= first, dealt).otherwise(file)
    ordered = (
        keyed.select(file.cast("int").alias("file"), "id", F.xxhash64("text").alias("hash"), "text")
        .mapInPandas(tokenise, "file int, key long, hash long, ids binary")
        .repartitionById(files, F.col("file"))
        .sortWithinPartitions("file", "key", "hash")
    )
    manifest = ordered.mapInPandas(
        write, "file int, sequences string, documents string, n_docs long, n_tokens long"
    )
    return saved(manifest, "manifest")


def read_token_files(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                system, path = _place(row.sequences)
                with system.open_input_file(path) as source, system.open_input_file(_place(row.documents)[1]) as index:
                    reader, table = SequenceReader(source), ipc.open_file(index)
                    for i in range(table.num_record_batches):
                        keys, starts, lengths = (c.to_pylist() for c in table.get_batch(i).columns)
                        sums = []
                        for start, length in zip(starts, lengths, strict=True):
                            crc = 0
                            for part in reader.run(start, length):
                                crc = zlib.crc32(part.astype("<u4"), crc)
                            sums.append(crc)
                        yield pd.DataFrame(
                            {key: pd.array(keys, "Int64"), "start": np.array(starts, "int64") + row.before, "n_tokens": lengths, "ids_crc32": sums}
                        )

    # One row a file; its size is set by ``file_docs``.
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("before", before)
    dealt = files.repartitionById(max(1, manifest.count()), F.col("file"))
    return dealt.mapInPandas(read, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
