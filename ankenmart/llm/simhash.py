"""SimHash near-duplicates through a vantage-point tree over fingerprints.

Level i of the tree has a vantage point of its own and measures the Hamming distance to it on the i-th
slice of the bits. The tree grows with the fingerprints: slices are halved, one after the other, into two levels
each, until a leaf is expected to hold no more than ``LEAF`` of them or 16 levels are reached. Slice distances add up to the whole distance, so the triangle bounds of the levels add
up too: a fingerprint within ``radius`` of another one differs from it, in its distances to the vantage
points, by ``radius`` in total at most. Each leaf is a shard; a fingerprint lives in one and queries those
whose bounds overlap its ball. All pairs found are checked exactly.

Cases: a null or blank text has fingerprint zero and links like any other; equal fingerprints are one node;
a null ``doc_id`` never names a component, one without any other id has a null ``component_id``; an empty
table gives no rows; other columns are not looked at, but for ``keep``.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.llm.common import lower_words, saved, slices, text_of

SHINGLE = 3
RADIUS = 2
SLICES = 8
#: Fingerprints a leaf is to hold, seen from one of them and if all were random. Each level more sends more query
#: rows to neighbouring leaves, which costs more than to compare some dozens of numbers where they are.
LEAF = 64.0
SEED = 42
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint, as a signed integer."""
    words = lower_words(text)
    if not words:
        return 0
    runs = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[w] for w in words]
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(b" ".join, zip(*runs, strict=False)), itertools.repeat(SEED)), "<u8"
    )
    ones = np.zeros(64, "int64")
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...], text: str, shingle: int) -> DataFrame:
    """The kept columns and ``fp`` of each document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 1000):
            yield frame.drop(columns="text").assign(fp=[fingerprint(t, shingle) for t in frame["text"]])

    rows = docs.select(*(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)), text_of(text).alias("text"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInPandas(run, ", ".join([*fields, "fp long"]))


def _offsets(levels: int, radius: int) -> list[int]:
    """What a shard's number may differ by from that of a fingerprint within the radius, one of each
    pair of opposite signs: four bits hold a level's distance, and impossible distances name no shard."""
    out = set()
    for steps in range(radius + 1):
        for at in itertools.product([s << (4 * i) for i in range(levels) for s in (1, -1)], repeat=steps):
            out.add(sum(at))
    return sorted(x for x in out if x >= 0)


def slice_widths(n: int, leaf: float = LEAF, slices: int = SLICES) -> list[int]:
    """Bits of each level's slice. Two random slices of w bits are as far from the vantage point with a chance of
    C(2w, w) / 4^w, so the chances of all levels multiply to the share of a table that meets in one leaf."""
    widths = [64 // slices] * slices
    for i in range(slices):
        if n * math.prod(math.comb(2 * w, w) / 4**w for w in widths) <= leaf or len(widths) == 16:
            break
        widths[2 * i : 2 * i + 1] = [widths[2 * i] // 2] * 2
    return widths


def _shard(vantage: int, widths: list[int]):
    """Number of the leaf: the distance to each level's vantage point, four bits a level."""
    number, low = F.lit(0).cast("long"), 0
    for i, width in enumerate(widths):
        mask = ((1 << width) - 1) << low
        mask -= (mask >> 63) << 64  # signed
        part = F.col("fp").bitwiseXOR(F.lit(vantage)).bitwiseAND(F.lit(mask))
        number = number + F.shiftleft(F.bit_count(part).cast("long"), 4 * i)
        low += width
    return number


def close_pairs(nodes: DataFrame, radius: int = RADIUS, leaf: float = LEAF) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` that differ in ``radius`` bits at most, each once."""
    first = nodes.orderBy(F.xxhash64("fp")).limit(1).first()
    if first is None:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    widths = slice_widths(nodes.count(), leaf)
    homes = nodes.select("fp", _shard(first["fp"], widths).alias("shard"))
    # The shard itself, where each pair meets twice, and half of the overlapping ones.
    queries = homes.select(
        F.col("fp").alias("a"), F.col("shard").alias("own"),
        F.explode(F.array(*(F.lit(o).cast("long") for o in _offsets(len(widths), radius)))).alias("offset"),
    ).select("a", "own", (F.col("own") + F.col("offset")).alias("shard"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    once = (F.col("own") != F.col("shard")) | (F.col("a") < F.col("b"))
    return queries.join(homes.withColumnRenamed("fp", "b"), "shard").where(near & once).select("a", "b")


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge (a, b): large star and small star in turn until nothing
    changes; each node then hangs on the smallest of its component. Every round is written out."""
    edges = saved(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        edges = saved(small, "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    leaf: float = LEAF,
) -> DataFrame:
    """The kept columns, ``fingerprint`` in hex, ``root`` (a number of the component) and ``component_id``."""
    at = keep.index(key)
    rows = saved(fingerprints(docs, keep, text, shingle), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min(f"kept_{at}").alias("least")), "nodes")
    linked = components(close_pairs(nodes.select("fp"), radius, leaf))
    rooted = nodes.join(linked, nodes["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return rows.join(named, "fp").select(
        *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "root",
        "component_id",
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that stay: of each component the one with the smallest key, nulls last.

    A document is known by key and text, so equal rows stay once.
    """
    marked = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text_of(text)).alias("text_key"))
    found = near_duplicates(marked, ("id", "text_key"), "id", **options)
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    stay = found.groupBy("root").agg(F.min(rank).alias("kept")).select("kept.id", "kept.text_key")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.xxhash64(text_of(text)).alias("hash")
    )
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_key"))
    return rows.join(stay, same, "left_semi").dropDuplicates(["key", "hash"]).select("row.*")
