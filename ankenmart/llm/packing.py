"""Bounded-space online best-fit packing of tokenised documents into sequences.

Cases: a null text is empty and gives its end id alone; a null ``doc_id`` stays null; repeated rows
are packed as often as they stand; ties (equal lengths, equal free space) go by the order of a hash;
an empty table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.llm.common import saved, slices, text_of
from ankenmart.llm.tokens import END_ID, REMEMBERED, TOKENIZER, encoder

CAPACITY = 2048
OPEN_BINS = 1024
LANE_PIECES = 32_768
#: Sequence numbers of a lane begin at its number times this.
LANE_STRIDE = 1 << 32


class OpenBins:
    """At most ``limit`` open bins. A bitset has a bit for each free space some open bin has, so the
    tightest fit is its lowest set bit from the piece's length on, and the fullest bin its lowest
    set bit of all; that one is closed when a bin too many is open."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.free = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = self.made = 0

    def _take(self, space: int) -> int:
        bin_ = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.count -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of 1 to ``capacity`` tokens."""
        if fits := self.free >> length:
            space = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(space)
        else:
            space, bin_ = self.capacity, self.made
            self.made += 1
        if left := space - length:
            self.bins[left].append(bin_)
            self.free |= 1 << left
            self.count += 1
            if self.count > self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
        return bin_, self.capacity - space


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """Start and ids of each piece: whole sequences, the first one takes what is left over."""
    total = len(ids) // 4
    start, end = 0, (total - 1) % capacity + 1
    while start < total:
        yield start, ids[4 * start : 4 * end]
        start, end = end, end + capacity


def pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row a piece: key, piece, start, length, ids_crc32."""
    end = np.array([END_ID], "<u4").tobytes()

    def tokenise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, remembered=remembered).encode
        for frame in slices(frames, 1024):
            out = [
                (id_, n, start, len(part) // 4, zlib.crc32(part))
                for id_, ids in zip(frame.iloc[:, 0], encode(frame.iloc[:, 1].tolist()), strict=True)
                for n, (start, part) in enumerate(cut(ids + end, capacity))
            ]
            yield pd.DataFrame(out, columns=[key, "piece", "start", "length", "ids_crc32"]).astype(
                {key: frame.dtypes.iloc[0]}
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), text_of(text).alias("text")).mapInPandas(
        tokenise, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
    )


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    lane_pieces: int = LANE_PIECES,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Each piece's place: its columns, sequence_id and offset.

    Texts are tokenised where they are read; only lengths travel. Pieces are dealt by hash into lanes
    of about ``lane_pieces``, and each lane is one online run in hash order, so a lane's size does not
    grow with the corpus, and a group of copies spreads over all lanes.
    """
    table = saved(pieces(docs, key, text, tokenizer, capacity, remembered), "pieces")
    lanes = max(1, -(-table.count() // lane_pieces))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["order", key, "piece"], kind="stable")
        bins = OpenBins(capacity, open_bins)
        places = np.array([bins.place(n) for n in frame["length"].tolist()], "int64").reshape(-1, 2)
        return frame.assign(
            sequence_id=frame["lane"] * LANE_STRIDE + places[:, 0], offset=places[:, 1]
        )[[key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = table.withColumn("order", F.xxhash64(F.col(key), "piece", "ids_crc32")).withColumn(
        "lane", F.pmod("order", F.lit(lanes))
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return dealt.groupBy("lane").applyInPandas(run, f"{fields}, sequence_id long, offset long")
