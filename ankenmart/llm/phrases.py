"""Phrases of two to four words that stand together oftener than their parts suggest, by language.

Words are numbered by falling frequency. A pair of numbers is a cell of a square tile, so frequent words meet in
few tiles: a tile with many entries is counted by direct addressing, one dense array and ``numpy.bincount``;
entries of all other tiles are sorted coordinates whose runs are added up. Pairs that reach the least count get
numbers by falling frequency again, and the pair of such a number and the word after it is a phrase of three,
counted alike, and so on. A phrase is counted only where both phrases within it that are one word shorter reach
the least count; none that does so is lost.

Texts are read once, into blocks of numbered words. Blocks exchange, level by level, distinct pairs and counts:
tiles go to buckets by a hash, a bucket adds up and replies to each block on what it sent. Where there are many
blocks, packets of some of them are first added up to one, in rounds, so that a tile that all blocks share meets
in one task as few packets. Nothing that grows with the corpus is broadcast or collected; the driver sees sums,
and the sizes of the partitions of one sort.

Cases: a null text is empty; a null language is that named ``und``; repeated rows count each; a language without
phrases that reach the least count gives no rows, nor does an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ankenmart.llm.common import saved, text_of

LEAST, SHARE, TOP = 30, 80, 2000
#: Words of a phrase at most.
LONGEST = 4
BLOCK_BYTES = 16_000_000
#: Numbers along a side of a tile; its cells have numbers of 16 bits.
SIDE = 256
CELLS = SIDE * SIDE
#: Entries from which a tile is counted by direct addressing, and such tiles at a time.
DENSE, DENSE_TILES = CELLS // 8, 64
#: Positions for each bucket of tiles, and packets of a bucket that are added up at a time.
BUCKET_ENTRIES, PACKETS = 1_000_000, 128

# Signs that end a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_MARK = b"\xff"  # in no UTF-8 text
_SIGNS = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _ENDS, b"abcdefghijklmnopqrstuvwxyz" + _MARK * len(_ENDS)
)


def pieces(text: bytes) -> list[bytes]:
    """The words of a text, A-Z lowered, and a mark where a piece ends."""
    return text.translate(_SIGNS).replace(_MARK, b" \xff ").split()


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class _Block:
    """Texts one after the other as numbers of the block's words, 0 where a piece ends."""

    def __init__(self) -> None:
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.langs: list[str] = []
        self.words: list[bytes] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        number = self.numbers.setdefault(lang, {_MARK: 0})
        words = pieces(text)
        for word in set(words):
            if word not in number:
                self.langs.append(lang)
                self.words.append(word)
                number[word] = len(self.words)
        tokens = np.zeros(len(words) + 1, "u4")
        tokens[:-1] = np.fromiter(map(number.__getitem__, words), "u4", len(words))
        self.tokens.append(tokens)
        self.size += len(text)

    def batch(self, block: int) -> pa.RecordBatch:
        tokens = np.concatenate(self.tokens)
        counts = np.bincount(tokens, minlength=len(self.words) + 1)[1:]
        edges = np.array([0, len(self.words)], "i4")
        of = lambda values: pa.ListArray.from_arrays(edges, values)
        columns = [
            pa.array([block], pa.int64()),
            pa.array([_packed(tokens)], pa.binary()),
            of(pa.array(self.langs, pa.string())),
            of(pa.array(self.words, pa.binary()).cast(pa.string())),
            of(pa.array(counts, pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "tokens", "langs", "words", "counts"])


_BLOCK = "block long, tokens binary, langs array<string>, words array<string>, counts array<long>"


def blocks(docs: DataFrame, text: str, lang: str, block_bytes: int) -> DataFrame:
    """One row a block of texts, of about so many bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, made = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block.add(name, body)
                if block.size >= block_bytes:
                    yield block.batch(made)
                    block, made = _Block(), made + 1
        if block.tokens:
            yield block.batch(made)

    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), text_of(text).cast("binary").alias("text"))
    return saved(rows.mapInArrow(run, _BLOCK), "phrase-blocks")


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows with their ``number`` in the order, from 0. The driver sees the sizes of the sort's partitions."""
    placed = saved(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    firsts = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    first = rows.sparkSession.createDataFrame([(r["part"], f) for r, f in zip(sizes, firsts, strict=False)], "part long, first long")
    return placed.join(F.broadcast(first), part == first["part"]).select(*rows.columns, (F.col("first") + at).alias("number"))


_STATE = "block long, words binary, places binary, numbers binary, positions long"


def _state(block: int, words: np.ndarray, places: np.ndarray, numbers: np.ndarray) -> pd.DataFrame:
    """``words`` are numbers of words, -1 between stretches; ``places`` are of the phrase of the level that begins
    at a word, -1 if none does, among ``numbers``, those of the level's phrases of the block."""
    row = (block, _packed(words.astype("i4")), _packed(places.astype("i4")), _packed(numbers), len(words))
    return pd.DataFrame([row], columns=["block", "words", "places", "numbers", "positions"])


def _asked(row, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words at which phrases of ``level`` words begin whose parts take part, their distinct phrases as number
    of the first words and number of the last word, and the phrase of each word."""
    words, places, numbers = _unpacked(row.words, "i4"), _unpacked(row.places, "i4"), _unpacked(row.numbers, "i8")
    at = np.flatnonzero((places[:-1] >= 0) & (places[1:] >= 0)).astype("i4") if len(places) else np.zeros(0, "i4")
    keys = places[at].astype("i8") << np.int64(32)
    if len(at):
        keys |= words[at + (level - 1)]
    keys, phrase = np.unique(keys, return_inverse=True)
    first, last = numbers[keys >> np.int64(32)], keys & np.int64((1 << 32) - 1)
    return at, first, last, phrase.astype("i4")


def _dealt(first: np.ndarray, last: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The order of the pairs by bucket, tile and cell; in that order their tiles and cells; and the buckets' edges."""
    tiles, tile = np.unique((first // SIDE) << np.int64(24) | last // SIDE, return_inverse=True)
    mixed = tiles.astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype("i8")
    ranks = np.empty(len(tiles), "i8")
    ranks[np.argsort(bucket, kind="stable")] = np.arange(len(tiles))
    cell = first % SIDE * SIDE + last % SIDE
    order = np.argsort(ranks[tile] << np.int64(16) | cell)
    edges = np.searchsorted(bucket[tile][order], np.arange(buckets + 1))
    return order, tiles[tile][order], cell[order].astype("u2"), edges


_PACKET = "bucket int, member long, tiles binary, sizes binary, cells binary, counts binary"
_PACKET_NAMES = ["bucket", "member", "tiles", "sizes", "cells", "counts"]


def _packet(bucket: int, member: int, tiles: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> tuple:
    begin = np.flatnonzero(np.diff(tiles, prepend=-1))
    sizes = np.diff(np.append(begin, len(tiles)))
    return bucket, member, tiles[begin].tobytes(), _packed(sizes.astype("u4")), _packed(cells), _packed(counts.astype("u8"))


def _added(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct tiles and cells of the packets, in order, their summed counts, and the place of each entry of
    each packet among them."""
    sizes = [_unpacked(s, "u4") for s in frame["sizes"]]
    tiles, tile = np.unique(np.concatenate([np.frombuffer(t, "i8") for t in frame["tiles"]]), return_inverse=True)
    tile = np.repeat(tile.astype("i4"), np.concatenate(sizes))
    cells = np.concatenate([_unpacked(c, "u2") for c in frame["cells"]])
    counts = np.concatenate([_unpacked(c, "u8") for c in frame["counts"]]).view("i8")
    place = lambda at: tile[at].astype("i8") << np.int64(16) | cells[at]
    dense = np.bincount(tile, minlength=len(tiles)) >= DENSE
    found, sums = [], []
    full = np.flatnonzero(dense)
    for some in np.split(full, range(DENSE_TILES, len(full), DENSE_TILES)):
        address = np.full(len(tiles), -1, "i4")
        address[some] = np.arange(len(some))
        own = np.flatnonzero(address[tile] >= 0)
        # Sums of whole numbers, exact below 2^53.
        grid = np.bincount(address[tile[own]] * np.int32(CELLS) + cells[own], counts[own], len(some) * CELLS)
        used = np.flatnonzero(grid)
        found.append(some[used // CELLS] << np.int64(16) | used % CELLS)
        sums.append(grid[used].astype("i8"))
    rest = np.flatnonzero(~dense[tile])
    places = place(rest)
    order = np.argsort(places, kind="stable")
    if len(order):
        places = places[order]
        begin = np.flatnonzero(np.diff(places, prepend=-1))
        found.append(places[begin])
        sums.append(np.add.reduceat(counts[rest[order]], begin))
    found, sums = (np.concatenate(x) for x in (found, sums))
    order = np.argsort(found)
    found, sums = found[order], sums[order]
    edges = np.cumsum([0, *(int(s.sum()) for s in sizes)]).tolist()
    entries = [np.searchsorted(found, place(slice(x, y))) for x, y in zip(edges, edges[1:], strict=False)]
    return tiles[found >> np.int64(16)], (found & (CELLS - 1)).astype("u2"), sums, entries


_REPLY = "bucket int, member long, numbers binary, first binary, last binary, counts binary"
_REPLY_NAMES = ["bucket", "member", "numbers", "first", "last", "counts"]


def _counted(packets: DataFrame, members: int, buckets: int, least: int, reply: bool, at_once: int) -> DataFrame:
    """Numbers for the entries of each packet, -1 below the least count, if a reply is wanted; as member -1 the
    phrases of a bucket that reach it, with their numbers and counts."""

    def top(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("member")
        bucket = int(frame["bucket"].iloc[0])
        tiles, cells, counts, entries = _added(frame)
        frequent = np.flatnonzero(counts >= least)
        frequent = frequent[np.argsort(-counts[frequent], kind="stable")]
        numbers = np.full(len(counts), -1, "i8")
        # By falling frequency in each bucket, the buckets taking turns: no sort over all is needed.
        numbers[frequent] = np.arange(len(frequent)) * buckets + bucket
        tile, cell = tiles[frequent], cells[frequent].astype("i8")
        first = (tile >> np.int64(24)) * SIDE + cell // SIDE
        last = (tile & np.int64((1 << 24) - 1)) * SIDE + cell % SIDE
        rows = [(bucket, -1, _packed(numbers[frequent]), _packed(first), _packed(last), _packed(counts[frequent]))]
        if reply:
            rows += [(bucket, m, _packed(numbers[e]), None, None, None) for m, e in zip(frame["member"], entries, strict=True)]
        return pd.DataFrame(rows, columns=_REPLY_NAMES)

    if members <= at_once:
        return saved(packets.groupBy("bucket").applyInPandas(top, _REPLY), "phrase-counts")

    groups = -(-members // at_once) + 1

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        tiles, cells, counts, _ = _added(frame)
        return pd.DataFrame([_packet(int(frame["bucket"].iloc[0]), int(frame["group"].iloc[0]), tiles, cells, counts)], columns=_PACKET_NAMES)

    def spread(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        numbers, (*_, entries) = _unpacked(above["numbers"].iloc[0], "i8"), _added(frame)
        rows = [(b, m, _packed(numbers[e]), None, None, None) for b, m, e in zip(frame["bucket"], frame["member"], entries, strict=True)]
        return pd.DataFrame(rows, columns=_REPLY_NAMES)

    if reply:
        packets = saved(packets, "phrase-packets")
    packets = packets.withColumn("group", F.pmod(F.xxhash64("member"), F.lit(groups)))
    merged = packets.groupBy("bucket", "group").applyInPandas(merge, _PACKET)
    counted = _counted(merged, groups, buckets, least, reply, at_once)
    if not reply:
        return counted
    down = counted.where("member >= 0").withColumnRenamed("member", "group")
    replies = packets.groupBy("bucket", "group").cogroup(down.groupBy("bucket", "group")).applyInPandas(spread, _REPLY)
    return saved(replies, "phrase-replies").unionByName(counted.where("member = -1"))


def _phrases(counted: DataFrame) -> DataFrame:
    """number, first, last and f of the phrases of a level."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                yield pd.DataFrame({c: _unpacked(data, "i8") for c, data in zip(("number", "first", "last", "f"), row, strict=True)})

    found = counted.where("member = -1").select("numbers", "first", "last", "counts")
    return found.mapInPandas(rows, "number long, first long, last long, f long")


def _begun(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """A block's words as the numbers over all blocks; words that are too seldom end a stretch."""
    row = next(left.itertuples(index=False))
    tokens = _unpacked(row.tokens, "u4")
    numbers = np.full(int(tokens.max(initial=0)) + 1, -1, "i4")
    if len(right):
        numbers[right["place"].to_numpy("i8")] = right["number"].to_numpy("i8")
    words = _stretches(numbers[tokens], 2)
    own, places = np.unique(words, return_inverse=True)
    gap = int(len(own) > 0 and own[0] == -1)
    return _state(row.block, words, places.reshape(-1) - gap, own[gap:].astype("i8"))


def _stretches(words: np.ndarray, least: int) -> np.ndarray:
    """The stretches of so many words and more, one -1 after each."""
    edge = np.diff((words >= 0).astype("i1"), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = last - first >= least
    keep = np.zeros(len(words) + 1, "i8")
    keep[first[long]] += 1
    keep[np.minimum(last[long] + 1, len(words))] -= 1
    kept = words[np.cumsum(keep)[: len(words)] > 0]
    return np.append(kept, np.int32(-1)) if len(kept) and kept[-1] >= 0 else kept


def _asker(level: int, buckets: int):
    """The distinct phrases of a level of each block, dealt to buckets."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                _, first, last, phrase = _asked(row, level)
                counts = np.bincount(phrase, minlength=len(first))
                order, tiles, cells, edges = _dealt(first, last, buckets)
                sent = [
                    _packet(b, row.block, tiles[x:y], cells[x:y], counts[order[x:y]])
                    for b, (x, y) in enumerate(zip(edges, edges[1:], strict=False))
                    if y > x
                ]
                yield pd.DataFrame(sent, columns=_PACKET_NAMES)

    return ask


def _stepper(level: int, buckets: int):
    """A block one level on, by the replies to what it asked."""

    def step(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = next(left.itertuples(index=False))
        at, first, last, phrase = _asked(row, level)
        order, *_ = _dealt(first, last, buckets)
        numbers = np.full(len(first), -1, "i8")
        if len(right):
            numbers[order] = np.concatenate([_unpacked(n, "i8") for n in right.sort_values("bucket")["numbers"]])
        words = _unpacked(row.words, "i4")
        places = np.full(len(words), -1, "i8")
        places[at] = np.where(numbers[phrase] >= 0, phrase, -1)
        # What is in no phrase of this level is in none of the next.
        held = np.zeros(len(words) + 1, "i8")
        begins = np.flatnonzero(places >= 0)
        held[begins] += 1
        np.add.at(held, begins + level, -1)
        inside = np.cumsum(held)[: len(words)] > 0
        ended = np.flatnonzero(~inside & np.append(False, inside[:-1]))
        words = np.where(inside, words, -1)
        inside[ended] = True
        return _state(row.block, words[inside], places[inside], numbers)

    return step


def counted_phrases(
    docs: DataFrame, text: str, lang: str, least: int, longest: int, block_bytes: int, bucket_entries: int, packets: int
) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Words (number, lang, word, f), occurrences of all words by language (lang, n), and for each level from two
    words on its phrases (number, first, last, f) with at least so many occurrences."""
    table = blocks(docs, text, lang, block_bytes)
    each = table.select("block", F.posexplode(F.arrays_zip("langs", "words", "counts"))).select(
        "block", (F.col("pos") + 1).alias("place"), F.col("col.langs").alias("lang"), F.col("col.words").alias("word"), F.col("col.counts").alias("n")
    )
    totals = saved(each.groupBy("lang", "word").agg(F.sum("n").alias("f")), "word-counts")
    by_lang = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    words = saved(_numbered(totals.where(F.col("f") >= least), F.col("f").desc(), F.col("lang"), F.col("word")), "words")

    known = each.select("block", "place", "lang", "word").join(words.select("lang", "word", "number"), ["lang", "word"])
    replies = known.select(F.col("block").alias("member"), "place", "number")
    begun = table.select("block", "tokens").groupBy("block").cogroup(replies.groupBy("member"))
    state = saved(begun.applyInPandas(_begun, _STATE), "phrase-state")
    levels = []
    for level in range(2, longest + 1):
        sums = state.agg(F.count(F.lit(1)).alias("members"), F.sum("positions").alias("positions")).first()
        buckets = (sums["positions"] or 0) // bucket_entries + 1
        asked = state.mapInPandas(_asker(level, buckets), _PACKET)
        more = level < longest
        counted = _counted(asked, sums["members"], buckets, least, more, packets)
        levels.append(saved(_phrases(counted), "phrases"))
        if more:
            answers = counted.where("member >= 0").select(F.col("member").alias("block"), "bucket", "numbers")
            state = saved(state.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_stepper(level, buckets), _STATE), "phrase-state")
    return words, by_lang, levels


_W = [f"w{i}" for i in range(1, LONGEST + 1)]


def phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    bucket_entries: int = BUCKET_ENTRIES,
    packets: int = PACKETS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases.

    A phrase is dropped if one that holds it occurs at least ``share`` percent as often.
    """
    words, by_lang, levels = counted_phrases(docs, text, lang, least, LONGEST, block_bytes, bucket_entries, packets)
    word = lambda i: words.select(F.col("number").alias(f"w{i}"), F.col("word").alias("_word"), F.col("f").alias(f"f{i}"))
    named = lambda rows, i: rows.join(word(i), f"w{i}")

    first = words.select(F.col("number").alias("w1"), "lang", F.col("word").alias("phrase"), F.col("f").alias("f1"))
    pairs = levels[0].select("number", F.col("first").alias("w1"), F.col("last").alias("w2"), F.col("f").alias("f12"))
    extended = F.concat_ws(" ", "phrase", "_word")
    rows = [saved(named(pairs.join(first, "w1"), 2).withColumn("phrase", extended).drop("_word"), "phrases")]
    for i, level in enumerate(levels[1:], 3):
        shorter = rows[-1].withColumnRenamed("number", "first")
        found = level.select("number", "first", F.col("last").alias(f"w{i}"), F.col("f").alias("f1" + "".join(map(str, range(2, i + 1)))))
        rows.append(saved(named(found.join(shorter, "first").drop("first"), i).withColumn("phrase", extended).drop("_word"), "phrases"))
    two, three, four = rows

    def suffix(rows: DataFrame, of: DataFrame, length: int, begin: int) -> DataFrame:
        """The count of the ``length`` words from word ``begin`` on."""
        count = "f" + "".join(str(i) for i in range(1, length + 1))
        names = {f"w{i}": f"w{i + begin - 1}" for i in range(1, length + 1)}
        own = of.select(*[F.col(a).alias(b) for a, b in names.items()], F.col(count).alias("f" + "".join(str(i) for i in range(begin, begin + length))))
        return rows.join(own, list(names.values()))

    three = suffix(three, two, 2, 2)
    four = suffix(suffix(four, two, 2, 3), rows[1], 3, 2)
    none = F.lit(None).cast("long")

    def scored(rows: DataFrame, length: int) -> DataFrame:
        """Candidates with the cut of the lowest score, of those the first."""
        names = [str(i) for i in range(1, length + 1)]
        a = F.col("f" + "".join(names))
        cuts = []
        for k in range(1, length):
            left, right = (F.col("f" + "".join(part)) for part in (names[:k], names[k:]))
            score = F.expr(f"cast(2000000 as decimal(38,0)) * f{''.join(names)} div (f{''.join(names[:k])} + f{''.join(names[k:])})")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        ids = [F.col(w) if i < length else none.alias(w) for i, w in enumerate(_W)]
        return rows.select("lang", "phrase", a.alias("a"), "cut.l", "cut.r", "cut.score", *ids)

    candidates = reduce(DataFrame.unionByName, [scored(r, i) for i, r in enumerate((two, three, four), 2)])
    spans = [(x, y) for y in (2, 3) for x in range(0, LONGEST - y + 1)]
    within = [
        F.when(F.col(_W[x + y - 1]).isNotNull() & (F.lit(y) < sum(F.col(w).isNotNull().cast("int") for w in _W)),
               F.struct(*[(F.col(_W[x + i]) if i < y else F.lit(-1).cast("long")).alias(f"s{i + 1}") for i in range(3)]))
        for x, y in spans
    ]
    longer = candidates.where(F.col("w3").isNotNull()).select("a", F.explode(F.array_compact(F.array(*within))).alias("s"))
    held = longer.groupBy("s.s1", "s.s2", "s.s3").agg(F.max("a").alias("longer"))
    same = (F.col("w1") == F.col("s1")) & (F.col("w2") == F.col("s2")) & (F.coalesce("w3", F.lit(-1)) == F.col("s3")) & F.col("w4").isNull()
    whole = F.col("longer").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * share
    kept = candidates.join(held, same, "left").where(~F.coalesce(whole, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(by_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
