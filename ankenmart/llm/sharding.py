"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Cases: a null text counts as empty; equal texts form a group, and a group above a share of a shard in bytes,
tokens or rows is dealt into parts by a hash of the key and the row's number in its task's input, so that
rows without a key or of equal keys are dealt too; ties go to the first shard from the cell's number on; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ankenmart.llm.common import n_words, saved, text_of

SHARDS = 8
CELL_GROUPS = 20_000
#: A group above this share of a shard, in any size, is split into parts of about the second share: packing
#: copes with whole groups below the first. A part above the third is placed before the rest.
SPLIT_SHARE = 1 / 16
PART_SHARE = 1 / 128
HEAVY_SHARE = 1 / 1000
SIZES = ("bytes", "tokens", "rows")


def fill(items: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Shard of each item (rows of sizes) where the dot product with the residual capacity is highest."""
    total = np.maximum(capacity.sum(axis=0), 1e-9)
    left, scaled = capacity / total, items / total
    out = np.empty(len(items), "int64")
    for i, item in enumerate(scaled):
        out[i] = at = int((left @ item).argmax())
        left[at] -= item
    return out


def _placer(shares: np.ndarray | None, shards: int):
    """Places a cell's parts, largest first, into its shares of the shards."""

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame[list(SIZES)].to_numpy("float64")
        total = np.maximum(sizes.sum(axis=0), 1e-9)
        frame = frame.assign(weight=(sizes / total).sum(axis=1))
        frame = frame.sort_values(["weight", "group", "part"], ascending=[False, True, True])
        share = np.full((shards, len(SIZES)), 1 / shards) if shares is None else shares
        # Each cell begins with another shard, so that ties don't favour the same one everywhere.
        shift = int(frame["cell"].iloc[0]) % shards
        found = fill(frame[list(SIZES)].to_numpy("float64"), np.roll(share * total, -shift, axis=0))
        frame["shard"] = (found + shift) % shards
        frame["base"] = frame.groupby("shard")["rows"].cumsum() - frame["rows"]
        return frame[["group", "part", "cell", "shard", "base", *SIZES]]

    return place


def shard(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    cell_groups: int = CELL_GROUPS,
    split_share: float = SPLIT_SHARE,
    part_share: float = PART_SHARE,
    heavy_share: float = HEAVY_SHARE,
) -> DataFrame:
    """key, size, text_crc32, shard and slot of each document; no text is shuffled.

    Heavy parts, at most ``shards / heavy_share`` for each size, are placed first, by one task. All others are dealt
    by hash into cells of about ``cell_groups``; each cell is packed alone into shares of what the heavy
    ones left, so tasks do not grow with the corpus.
    """
    text_ = text_of(text)
    rows = saved(
        docs.select(
            F.col(key).alias("key"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.md5(text_.cast("binary"))).alias("group"),
            (F.octet_length(text_) + 1).cast("long").alias("bytes"),
            n_words(text).alias("tokens"),
            F.crc32(text_.cast("binary")).alias("text_crc32"),
        ),
        "shard-rows",
    )
    sizes = (F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sums = np.array([float(s or 0) for s in rows.agg(*sizes).first()])
    # The largest of a group's or part's sizes, in shards.
    share = F.greatest(*(F.col(s) / float(max(total, 1.0) / shards) for s, total in zip(SIZES, sums, strict=True)))
    # Each split group has more than a fixed share of all of one size: at most 3 * shards / split_share rows.
    hot = (
        rows.groupBy("group")
        .agg(*sizes)
        .where((share > split_share) & (F.col("rows") > 1))
        .select("group", F.least("rows", F.ceil(share / part_share)).alias("parts"))
    )
    part = F.coalesce(F.pmod(F.xxhash64("key", "row"), F.col("parts")), F.lit(0)).cast("int")
    dealt = rows.join(F.broadcast(hot), "group", "left").withColumn("part", part).drop("parts")
    parts = saved(
        dealt.groupBy("group", "part").agg(*sizes),
        "shard-parts",
    )
    cells = max(1, -(-parts.count() // cell_groups))
    schema = "group binary, part int, cell long, shard int, base long, bytes long, tokens long, rows long"
    is_heavy = share > heavy_share
    heavy = parts.where(is_heavy).withColumn("cell", F.lit(-1).cast("long"))
    first = saved(heavy.groupBy("cell").applyInPandas(_placer(None, shards), schema), "shard-heavy")
    load = np.zeros((shards, len(SIZES)))
    for row in first.groupBy("shard").agg(*(F.sum(s).alias(s) for s in SIZES)).collect():
        load[row["shard"]] = [row[s] for s in SIZES]
    room = np.maximum(sums / shards - load, 0.0) + 1e-9
    light = parts.where(~is_heavy).withColumn("cell", F.pmod(F.xxhash64("group", "part"), F.lit(cells)))
    rest = light.groupBy("cell").applyInPandas(_placer(room / room.sum(axis=0), shards), schema)
    placed = saved(first.unionByName(rest), "shard-placed")
    in_cell = placed.groupBy("shard", "cell").agg(F.sum("rows").alias("n"))
    start = F.sum("n").over(W.partitionBy("shard").orderBy("cell")) - F.col("n")
    starts = in_cell.select("shard", "cell", start.alias("start"))
    places = placed.select("group", "part", "cell", "shard", "base").join(starts, ["shard", "cell"])
    rank = F.row_number().over(W.partitionBy("group", "part").orderBy("key", "row")) - 1
    return (
        dealt.join(places, ["group", "part"])
        .withColumn("slot", F.col("start") + F.col("base") + rank)
        .select(F.col("key").alias(key), F.col("bytes").alias("size"), "text_crc32", "shard", "slot")
    )
