"""Language-model scores from a probabilistic suffix tree.

States are contexts of up to ``depth`` words. A run of words takes part if it occurs ``least_count`` times in
training, whatever the size of the corpus, so the tree grows with it; longer runs are looked for only where
their parts take part, which loses none. A context is
retained if its next-word distribution diverges enough from that of its longest retained suffix: if count
times Kullback-Leibler divergence, the nats it saves, exceeds what its parameters cost by description
length. Distributions are smoothed towards the suffix's,
down to the unigrams of all training words. A token is scored by the longest retained suffix before it.

Texts are read once. Words become numbers within a block of documents; what the blocks exchange are their
vocabularies and, level by level, the counts of their runs. Runs go to buckets by their context; a
bucket counts and tests whole contexts, numbers the runs that take part, and replies to each block on what the block asked for, so no task and
no driver holds the tree. As a run takes part only if the run without its first word does, its last word is told by
its rank among those that follow the context without its first word, which is smaller than its number among all words.
Blocks and replies are bucketed by block, so neither is shuffled again at each level.

Cases: a null text is empty and is scored as its end alone; a null id is not held out; repeated rows are
counted and scored one by one; unseen words share the unigram estimate of count 0; without training rows
every base probability is 1; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.llm.common import Bucketed, discard, release, text_of
from ankenmart.session import scratch_path

DEPTH = 3
LEAST_COUNT = 2
#: Times the description length of a context's parameters that it must save.
DIVERGENCE = 1.0
#: Occurrences the suffix's distribution counts for in that of a context.
PULL = 6.0
BLOCK_BYTES = 10_000_000
#: Entries a bucket of words has at most, and tokens for each bucket of runs.
BUCKET_ENTRIES = 500_000
#: No word has a line end in it.
END = xxhash.xxh64_intdigest(b"\n")

_BLOCK = "block long, docs binary, no_id binary, held_out binary, lengths binary, tokens binary, ranked binary, words binary, counts binary, entries long, train_tokens long"


def _packed(values: np.ndarray) -> bytes:
    """Compressed, first bytes of all values first."""
    return zstandard.compress(np.ascontiguousarray(values).view("u1").reshape(-1, values.itemsize).T.tobytes(), 3)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


#: Lowest bits of a kept probability that look like chance: what is above them packs better alone.
_LOW = 10


def _packed_split(values: np.ndarray) -> bytes:
    """Values of 32 bits: the lowest bits as they are, end to end, after the others, packed."""
    high = _packed(values >> np.uint32(_LOW))
    low = np.unpackbits((values & np.uint32((1 << _LOW) - 1)).astype(">u2").view("u1").reshape(-1, 2), axis=1)[:, 16 - _LOW :]
    return np.uint32(len(high)).tobytes() + high + np.packbits(low).tobytes()


def _unpacked_split(data: bytes) -> np.ndarray:
    end = 4 + int(np.frombuffer(data[:4], "u4")[0])
    high = _unpacked(data[4:end], "u4")
    low = np.zeros((len(high), 16), "u1")
    low[:, 16 - _LOW :] = np.unpackbits(np.frombuffer(data[end:], "u1"), count=len(high) * _LOW).reshape(-1, _LOW)
    return high << np.uint32(_LOW) | np.packbits(low, axis=1).view(">u2").ravel()


def _packed_rising(values: np.ndarray) -> bytes:
    """Sorted values, as the gaps between them."""
    return _packed(np.append(values[:1], np.diff(values)))


def _unpacked_rising(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(_unpacked(data, kind), dtype=kind)


def _packed_within(values: np.ndarray, sizes: np.ndarray) -> bytes:
    """Values that rise within groups of such sizes, as the gaps between them."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    gaps[first] = values[first]
    return _packed(gaps)


def _unpacked_within(data: bytes, kind: str, sizes: np.ndarray) -> np.ndarray:
    gaps = _unpacked(data, kind)
    sums, first = np.cumsum(gaps, dtype="u8"), np.cumsum(sizes, dtype="i8") - sizes
    before = np.append(np.zeros(1, "u8"), sums)[first]
    return (sums - np.repeat(before, sizes)).astype(kind)


def _packed_ranked(values: np.ndarray, rising: bool = False) -> bytes:
    """Values of which some are frequent: each one's rank, as small numbers pack better, after those ranked. If most
    follow an equal or a smaller one, they are ranked by size and ranks travel as gaps."""
    distinct, place, times = np.unique(values, return_inverse=True, return_counts=True)
    order = np.arange(len(distinct)) if rising else np.argsort(-times, kind="stable")
    rank = np.empty(len(order), "u4")
    rank[order] = np.arange(len(order), dtype="u4")
    pack = _packed_rising if rising else _packed
    ranked = pack(distinct[order])
    return np.uint32(len(ranked)).tobytes() + ranked + pack(rank[place])


def _unpacked_ranked(data: bytes, kind: str, rising: bool = False) -> np.ndarray:
    unpack, end = _unpacked_rising if rising else _unpacked, 4 + int(np.frombuffer(data[:4], "u4")[0])
    return unpack(data[4:end], kind)[unpack(data[end:], "u4")]


def _packed_by_word(p: np.ndarray, words: np.ndarray, bits: int) -> bytes:
    """Values that hang on a word only, and fall as its number rises among words of a bucket, given by ``words``,
    which may repeat: once a word."""
    n, which = _words_back(words, bits)
    each = np.empty(n, p.dtype)
    each[which] = p
    return _packed_ranked(each, rising=True)


def _unpacked_by_word(data: bytes, kind: str, words: np.ndarray, bits: int) -> np.ndarray:
    return _unpacked_ranked(data, kind, rising=True)[_words_back(words, bits)[1]]


def _words_back(words: np.ndarray, bits: int) -> tuple[int, np.ndarray]:
    """How many distinct words there are, and which of them each is, bucket by bucket from the last number back."""
    back = _LAST - words.astype("i8")
    distinct, _, which = _distinct(back & np.int64((1 << bits) - 1), back)
    return len(distinct), which


#: Bits of a probability that the divergence test leaves out: 12 significant ones are kept, within 2 ** -12.
_LEFT_OUT = np.uint32(12)


def _short(p: np.ndarray) -> np.ndarray:
    return p.astype("f4").view("u4") + (np.uint32(1) << _LEFT_OUT - np.uint32(1)) >> _LEFT_OUT


def _long(p: np.ndarray) -> np.ndarray:
    return (p << _LEFT_OUT).view("f4")


def _order(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The places of pairs of numbers from 0 on, in the order of the pairs, then of the places. One sort of numbers
    that hold both and the place, if they fit, takes a fraction of the time of sorting places."""
    n = len(high)
    low_bits, bits = int(low.max(initial=0)).bit_length(), n.bit_length()
    if int(high.max(initial=0)).bit_length() + low_bits + bits > 63:
        return np.lexsort((low, high))
    packed = (high.astype("i8") << np.int64(low_bits + bits)) | (low.astype("i8") << np.int64(bits)) | np.arange(n)
    packed.sort()
    return packed & np.int64((1 << bits) - 1)


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, and for each pair which of them it is."""
    order = _order(high, low)
    high, low = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    which = np.empty(len(order), "i4")
    which[order] = np.cumsum(new, dtype="i4") - np.int32(1)
    return high[new], low[new], which


class _Block:
    """Documents in a row: their tokens as numbers of the block's words, and the words as hashes."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.texts: list[str] = []
        self.size = 0

    def add(self, id_, text: str, held_out: bool) -> None:
        self.rows.append((id_, held_out))
        self.texts.append(text)
        self.size += len(text)

    def _words(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct words as UTF-8, which of them each word of the texts is, and the words of each text."""
        found = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(self.texts, pa.large_string())))
        words = found.flatten()
        there = pc.not_equal(words, "")  # none before the first space, after the last or in an empty text
        before = np.append(0, np.cumsum(there.to_numpy(zero_copy_only=False)))
        numbered = words.filter(there).dictionary_encode()
        distinct = numbered.dictionary.cast(pa.large_binary()).to_pylist()
        return distinct, numbered.indices.to_numpy(), np.diff(before[found.offsets.to_numpy()])

    def frame(self, block: int) -> pd.DataFrame:
        distinct, number, n_words = self._words()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), "u8", len(distinct))
        hashes = np.append(hashes, np.uint64(END))
        words, place = np.unique(hashes, return_inverse=True)
        place = place.astype("u4")
        lengths = n_words + 1
        every = np.full(lengths.sum(), place[-1])
        inner = np.ones(len(every), bool)
        inner[np.cumsum(lengths) - 1] = False
        every[inner] = place[number]
        held_out = np.array([h for _, h in self.rows], bool)
        counts = np.bincount(every[np.repeat(~held_out, lengths)], minlength=len(words))
        ranked = np.argsort(-np.bincount(every, minlength=len(words)), kind="stable").astype("u4")
        rank = np.empty_like(ranked)  # small numbers for frequent words pack better
        rank[ranked] = np.arange(len(ranked), dtype="u4")
        no_id = np.array([pd.isna(i) for i, _ in self.rows])
        row = {
            "block": block,
            "docs": np.array([0 if pd.isna(i) else int(i) for i, _ in self.rows], "i8").tobytes(),
            "no_id": no_id.tobytes(),
            "held_out": held_out.tobytes(),
            "lengths": lengths.astype("u4").tobytes(),
            "tokens": _packed(rank[every]),
            "ranked": _packed(ranked),
            "words": _packed_rising(words),
            "counts": _packed(counts.astype("u4")),
            "entries": len(words),
            "train_tokens": int(counts.sum()),
        }
        return pd.DataFrame([row])


def blocks(docs: DataFrame, key: str, text: str, parts: int, held: int, block_bytes: int) -> DataFrame:
    """One row a block of documents, of about so many characters."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, made = _Block(), TaskContext.get().partitionId() << 32
        for frame in frames:
            for id_, body in frame.itertuples(index=False, name=None):
                name = b"" if pd.isna(id_) else str(int(id_)).encode()
                block.add(id_, body, name != b"" and zlib.crc32(name) % parts == held)
                if block.size >= block_bytes:
                    yield block.frame(made)
                    block, made = _Block(), made + 1
        if block.rows:
            yield block.frame(made)

    rows = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    return rows.mapInPandas(run, _BLOCK)


def _bucket_edges(words: np.ndarray, bits: int) -> np.ndarray:
    starts = np.arange(1, 1 << bits, dtype="u8") << np.uint64(64 - bits) if bits else np.array([], "u8")
    return np.concatenate([[0], np.searchsorted(words, starts), [len(words)]])


#: The last number a word can have.
_LAST = np.int64((1 << 32) - 1)
_REPLIES = "level int, bucket int, block long, first binary, second binary, third binary, fourth binary, known long"
_REPLY = ["level", "bucket", "block", "first", "second", "third", "fourth", "known"]


def word_counts(table: DataFrame, bits: int, least: int) -> DataFrame:
    """Training counts of each block's words, over all blocks, as replies of level 0: of the bucket's share of
    the block's words, ``first`` has the counts and ``second`` a number from 1 on, 0 for a word that takes no
    part in the tree. Block -1 has the number of ``known`` words of the bucket."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                words, counts = _unpacked_rising(row.words, "u8"), _unpacked(row.counts, "u4")
                edges = _bucket_edges(words, bits)
                yield pd.DataFrame(
                    [(b, row.block, _packed_rising(words[x:y]), _packed(counts[x:y])) for b, (x, y) in enumerate(zip(edges, edges[1:], strict=False)) if y > x],
                    columns=["bucket", "block", "words", "counts"],
                )

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        words = [_unpacked_rising(w, "u8") for w in frame["words"]]
        counts = np.concatenate([_unpacked(c, "u4") for c in frame["counts"]])
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype("i8")
        ends = np.cumsum([len(w) for w in words])
        numbers, bucket = np.zeros(len(totals), "i8"), int(frame["bucket"].iloc[0])
        frequent = np.flatnonzero(totals >= least)
        # The frequent ones get small numbers, which pack better.
        numbers[frequent[np.argsort(-totals[frequent], kind="stable")]] = (np.arange(len(frequent)) << bits) + bucket + 1
        rows = [(0, bucket, b, _packed(totals[p]), _packed(numbers[p]), None, None, 0) for b, p in zip(frame["block"], np.split(place, ends[:-1]), strict=True)]
        rows.append((0, bucket, -1, None, None, None, None, int((totals > 0).sum())))
        return pd.DataFrame(rows, columns=_REPLY)

    dealt = table.select("block", "words", "counts").mapInPandas(deal, "bucket int, block long, words binary, counts binary")
    return dealt.groupBy("bucket").applyInPandas(total, _REPLIES)


def _judged(
    context: np.ndarray, n: np.ndarray, totals: np.ndarray, p: np.ndarray, pull: float, divergence: float
) -> tuple[np.ndarray, np.ndarray]:
    """Whether each context is a state, and the probability it leaves to its suffix. ``n`` is per context; per
    run there are its context, its count and what the context's longest retained suffix says of its last word."""
    p = _long(_short(p)).astype("f8")
    share = totals / (n[context] + pull)
    left = 1 - np.bincount(context, totals, len(n)) / (n + pull)
    gain = np.bincount(context, share * np.log(share / p), len(n)).astype("f8")  # whole numbers without runs
    rest_below = np.maximum(1 - np.bincount(context, p, len(n)), 1e-12)
    gain += left * np.log(np.maximum(left, 1e-12) / rest_below)
    seen = np.bincount(context, minlength=len(n))
    cost = (seen + 1) / 2 * np.log(np.maximum(n, 2))
    return (seen > 0) & (n * gain >= divergence * cost), left


@dataclass
class Tree:
    """The same tree in memory, for corpora of one task; tests compare with it. Levels of runs: level k holds runs of k + 1 words as sorted keys, the number of the run's first k
    words in the level below times ``stride`` plus the last word's. ``kept`` and ``rest`` are per run as a
    context: whether it is a state, and the probability it leaves to its suffix."""

    words: np.ndarray
    counts: np.ndarray
    tokens: int
    known: int
    pull: float
    keys: list[np.ndarray] = field(default_factory=list)
    totals: list[np.ndarray] = field(default_factory=list)
    kept: list[np.ndarray] = field(default_factory=list)
    rest: list[np.ndarray] = field(default_factory=list)

    @property
    def stride(self) -> int:
        return len(self.words) + 1

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.tokens + 0.5 * (self.known + 1))

    def number(self, words: np.ndarray) -> np.ndarray:
        """Number of each word in the tree, -1 if it takes no part."""
        return _find(self.words, words)

    def runs(self, level: int, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Number of each run (a run of the level below, a word), -1 if it takes no part."""
        out = np.full(len(last), -1, "i8")
        some = np.flatnonzero((before >= 0) & (last >= 0))
        out[some] = _find(self.keys[level - 1], before[some] * self.stride + last[some])
        return out

    def smoothed(self, p: np.ndarray, level: int, context: np.ndarray, run: np.ndarray) -> np.ndarray:
        """p improved by contexts of ``level`` words: where they are states, their share of the
        run plus what they leave to p."""
        state = np.flatnonzero(context >= 0)
        state = state[self.kept[level - 1][context[state]]]
        own = np.zeros(len(state))
        seen = run[state] >= 0
        before = self.counts if level == 1 else self.totals[level - 2]
        own[seen] = self.totals[level - 1][run[state][seen]] / (before[context[state][seen]] + self.pull)
        out = p.copy()
        out[state] = own + self.rest[level - 1][context[state]] * p[state]
        return out

    def add_level(self, keys: np.ndarray, totals: np.ndarray, divergence: float) -> None:
        """Add runs one word longer, and test the contexts they follow."""
        level = len(self.keys) + 1
        order = np.argsort(keys)
        self.keys.append(keys[order])
        self.totals.append(totals[order])
        context, last = np.divmod(self.keys[-1], self.stride)
        n = self.counts if level == 1 else self.totals[level - 2]
        # What the longest retained suffix says of the same words.
        p = self.unigram(self.counts[last])
        words = [last]
        run = context
        for below in range(level - 1, 0, -1):
            run, word = np.divmod(self.keys[below - 1][run], self.stride)
            words.append(word)
        if level > 1:
            words.append(run)
        history = words[:0:-1] if level > 1 else []  # first to last word of the context
        for k in range(1, level):
            c = history[-k]
            for j, w in enumerate(history[len(history) - k + 1 :], 1):
                c = self.runs(j, c, w)
            p = self.smoothed(p, k, c, self.runs(k, c, last))
        kept, left = _judged(context, n, self.totals[-1], p, self.pull, divergence)
        self.kept.append(kept)
        self.rest.append(left)


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(values), -1, "i8")
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1).astype("i8")


def _bucket(ids: np.ndarray, bits: int) -> np.ndarray:
    """A bucket by the low ``bits`` of the id and a hash of the others, so that these tell an id within its bucket:
    the gaps between them are those of the ids of one bucket, however many buckets there are."""
    x = (ids >> np.int64(bits)).astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31)) ^ ids.astype("u8")) & np.uint64((1 << bits) - 1)).astype("i8")


class _Walk:
    """A block's tokens on their way through the levels, by the replies to the block.

    ``place`` is the run of so many words as levels passed that ends with each token, among the block's runs,
    -1 if a part of it takes no part; ``total`` and ``id``, its number among all, are per run, both 0 if it takes
    no part. ``name`` is per run too, what tells it from the others of its context: a word's number, a longer run's rank
    among those of the context that take part."""

    def __init__(self, row, words: pd.DataFrame, tokens: int, known: int, pull: float, bits: int, word_bits: int) -> None:
        words = words.sort_values("bucket")
        totals = np.concatenate([_unpacked(t, "i8") for t in words["first"]])
        numbers = np.concatenate([_unpacked(t, "i8") for t in words["second"]])
        if numbers.max(initial=0) > _LAST:
            raise OverflowError("words that take part are numbered with 32 bits")
        self.place = _unpacked(row.ranked, "u4").astype("i4")[_unpacked(row.tokens, "u4")]
        lengths = np.frombuffer(row.lengths, "u4")
        self.first = np.cumsum(lengths, dtype="i8") - lengths
        self.learnt = np.repeat(~np.frombuffer(row.held_out, bool), lengths)
        self.count = totals[self.place]
        self.total = np.where(numbers > 0, totals, 0)
        self.id, self.name = numbers, numbers.astype("u4")
        self.level = 0
        self.pull, self.bits, self.word_bits = pull, bits, word_bits
        self.base = (self.count + 0.5) / (tokens + 0.5 * (known + 1))
        self.p = self.base.copy()

    def ask(self) -> None:
        """Find the contexts before the tokens and the runs one word longer, as far as their parts take part."""
        before = np.full(len(self.place), -1, "i4")
        before[1:] = self.place[:-1]
        before[self.first] = -1
        self.after = np.flatnonzero(before >= 0)
        self.after = self.after[self.total[before[self.after]] > 0]
        used = np.zeros(len(self.total), bool)
        used[before[self.after]] = True
        contexts = np.flatnonzero(used)
        bucket = _bucket(self.id[contexts], self.bits)
        order = _order(bucket, self.id[contexts])
        contexts = contexts[order]
        self.edges = np.searchsorted(bucket[order], np.arange((1 << self.bits) + 1))
        rank = np.zeros(len(self.total), "i4")
        rank[contexts] = np.arange(len(contexts), dtype="i4")
        self.context = rank[before[self.after]]
        self.context_id, self.context_n = self.id[contexts], self.total[contexts]
        ends = self.place[self.after]
        # The run without its first word takes part too.
        some = np.flatnonzero(ends >= 0)
        some = some[self.total[ends[some]] > 0]
        self.whole = self.after[some]
        self.follows, self.last, self.run = _distinct(self.context[some], self.name[ends[some]])

    def dealt(self) -> Iterator[tuple]:
        """What has been asked for, by bucket of context."""
        counts = np.bincount(self.run, self.learnt[self.whole], len(self.last)).astype("u4")
        p = np.zeros(len(self.last), "u4")
        p[self.run] = _short(self.p[self.whole])  # the same at each token of a run
        learnt = counts > 0
        edges = self.edges
        runs = np.bincount(self.follows, minlength=len(self.context_id)).astype("u4")
        ends = np.searchsorted(self.follows, edges)
        for b, (x, y, u, v) in enumerate(zip(edges, edges[1:], ends, ends[1:], strict=False)):
            if y > x:
                yield (
                    b, _packed_rising(self.context_id[x:y] >> np.int64(self.bits)), _packed(self.context_n[x:y][runs[x:y] > 0]), _packed(runs[x:y]),
                    _packed_within(self.last[u:v], runs[x:y]), _packed(counts[u:v]), _packed_split(p[u:v][learnt[u:v]]) if self.level else _packed_by_word(p[u:v], self.last[u:v], self.word_bits),
                )

    def take(self, replies: pd.DataFrame) -> None:
        """Go one level on: ``first`` has the occurrences of each context's runs and one more, 0 if it is no state,
        ``second`` the count of each run, 0 if it takes no part, ``third`` the ranks in their contexts of those that do,
        ``fourth`` how many runs take part in contexts before theirs, both null at the last level."""
        replies = replies.sort_values("bucket")
        each = [_unpacked(t, "i8") for t in replies["second"]]
        followed = np.concatenate([_unpacked(f, "i8") for f in replies["first"]] or [np.zeros(0, "i8")])
        self.total = np.concatenate(each or [np.zeros(0, "i8")])
        self.id, self.name = np.zeros(len(self.total), "i8"), np.zeros(len(self.total), "u4")
        begin = 0
        for bucket, totals, third, fourth in zip(replies["bucket"], each, replies["third"], replies["fourth"], strict=True):
            if third is not None:
                some = begin + np.flatnonzero(totals > 0)
                sizes = _sizes(self.follows[some])
                self.name[some] = _unpacked_within(third, "u4", sizes)
                before = np.repeat(_unpacked_rising(fourth, "i8"), sizes)
                self.id[some] = (before + self.name[some] + 1 << self.bits) + bucket
            begin += len(totals)
        self.level += 1
        self.place = np.full(len(self.place), -1, "i4")
        self.place[self.whole] = self.run
        own = np.zeros(len(self.place))
        own[self.whole] = self.total[self.run]
        state = np.flatnonzero(followed[self.context] > 0)
        at, context = self.after[state], self.context[state]
        n = self.context_n[context] + self.pull
        self.p[at] = own[at] / n + (1 - (followed[context] - 1) / n) * self.p[at]


def _sizes(groups: np.ndarray) -> np.ndarray:
    """How many of each group there are, of groups that rise."""
    first = np.flatnonzero(np.append(np.ones(min(len(groups), 1), bool), groups[1:] != groups[:-1]))
    return np.diff(first, append=len(groups))


_ASKED = "bucket int, block long, contexts binary, n binary, runs binary, last binary, counts binary, p binary"


def run_counts(
    asked: DataFrame, level: int, least: int, pull: float, divergence: float, word_bits: int, last_level: bool = False
) -> DataFrame:
    """Replies of a level: counts of runs over all blocks, and the test of their contexts. The runs of the last
    level need no numbers, since no longer ones are asked for. ``n`` is there for contexts with runs only, since one
    without any is no state."""

    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        each = [_unpacked_rising(c, "i8") for c in frame["contexts"]]
        runs = [_unpacked(r, "u4") for r in frame["runs"]]
        distinct, _, place = _distinct(np.concatenate(each), np.zeros(sum(map(len, each)), "u1"))
        n = np.zeros(len(distinct), "i8")
        sizes = np.concatenate(runs)
        n[place[sizes > 0]] = np.concatenate([_unpacked(x, "i8") for x in frame["n"]])
        lasts = [_unpacked_within(x, "u4", r) for x, r in zip(frame["last"], runs, strict=True)]
        counts = np.concatenate([_unpacked(x, "u4") for x in frame["counts"]])
        here = counts > 0
        if level == 1:  # p hangs on the last word only
            p = np.concatenate([_unpacked_by_word(x, "u4", w, word_bits) for x, w in zip(frame["p"], lasts, strict=True)])[here]
        else:
            p = np.concatenate([_unpacked_split(x) for x in frame["p"]])
        follows, _, run = _distinct(np.repeat(place, sizes), np.concatenate(lasts))
        totals = np.bincount(run, counts, len(follows)).astype("i8")
        below = np.ones(len(follows))
        below[run[here]] = _long(p)  # the same from each block
        some = totals >= least
        context, bucket = follows[some], int(frame["bucket"].iloc[0])
        kept, _ = _judged(context, n, totals[some], below[some], pull, divergence)
        followed = np.where(kept, np.bincount(context, totals[some], len(n)).astype("i8") + 1, 0)
        totals = np.where(some, totals, 0)
        # Of those that take part, in the order of each block's runs.
        before = np.searchsorted(context, np.arange(len(n)))
        rank = (np.cumsum(some) - 1 - before[follows]).astype("u4")
        rows = []
        context_ends, run_ends = (np.cumsum([int(x) for x in ends])[:-1] for ends in ([len(c) for c in each], [r.sum() for r in runs]))
        for block, c, r in zip(frame["block"], np.split(place, context_ends), np.split(run, run_ends), strict=True):
            names = None, None
            if not last_level:
                part = r[some[r]]
                sizes = _sizes(follows[part])
                names = _packed_within(rank[part], sizes), _packed_rising(before[follows[part[np.cumsum(sizes) - sizes]]])
            rows.append((level, bucket, block, _packed(followed[c]), _packed(totals[r]), *names, 0))
        return pd.DataFrame(rows, columns=_REPLY)

    return asked.groupBy("bucket").applyInPandas(judge, _REPLIES)


def scores(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    parts: int = 5,
    held: int = 1,
    depth: int = DEPTH,
    least_count: int = LEAST_COUNT,
    divergence: float = DIVERGENCE,
    pull: float = PULL,
    block_bytes: int = BLOCK_BYTES,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of each document.

    Training rows are those whose crc32(key as text) mod ``parts`` is not ``held``.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "read")
    blocks(docs, key, text, parts, held, block_bytes).write.parquet(path)
    read = spark.read.schema(_BLOCK).parquet(path)
    sums = read.agg(F.sum("entries").alias("entries"), F.sum("train_tokens").alias("tokens")).first()
    tokens = sums["tokens"] or 0
    bits, run_bits = (max((n or 0) // bucket_entries, 1).bit_length() - 1 for n in (sums["entries"], tokens))
    answers = Bucketed(spark, "replies", "block")
    # Replies are not dealt by block first: a task judges many buckets, so a block's replies are in few files, and they
    # would be on disk twice while what was asked is there too.
    replies = answers.add(word_counts(read, bits, least_count), dealt=False)
    known = replies.where("block < 0").agg(F.sum("known")).first()[0] or 0
    release(spark)
    # The vocabularies have been counted; the texts go on without them.
    table = Bucketed(spark, "blocks", "block").add(read.drop("words", "counts"), dealt=False)
    discard(spark, path)
    texts = table.select("block", "docs", "no_id", "held_out", "lengths", "tokens", "ranked")

    def walked(left: pd.DataFrame, right: pd.DataFrame, level: int) -> tuple:
        """The block's row, and its walk through the levels below this one."""
        row = next(left.itertuples(index=False))
        walk = _Walk(row, right[right["level"] == 0], tokens, known, pull, run_bits, bits)
        for below in range(1, level):
            walk.ask()
            walk.take(right[right["level"] == below])
        return row, walk

    def asker(level: int):
        def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            row, walk = walked(left, right, level)
            walk.ask()
            found = [(b, row.block, *rest) for b, *rest in walk.dealt()]
            return pd.DataFrame(found, columns=["bucket", "block", "contexts", "n", "runs", "last", "counts", "p"])

        return ask

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row, walk = walked(left, right, depth + 1)
        return pd.DataFrame(
            {
                "id": pd.array(np.frombuffer(row.docs, "i8"), "Int64").copy(),
                "held_out": np.frombuffer(row.held_out, bool),
                "n_tokens": np.frombuffer(row.lengths, "u4").astype("i8"),
                "n_known": np.add.reduceat((walk.count > 0).astype("i8"), walk.first),
                "train_tokens": tokens,
                "base_score": np.add.reduceat(np.log10(walk.base), walk.first),
                "score": np.add.reduceat(np.log10(walk.p), walk.first),
            }
        ).assign(id=lambda f: f["id"].mask(np.frombuffer(row.no_id, bool)))

    for level in range(1, depth + 1):
        release(spark)
        pairs = texts.groupBy("block").cogroup(replies.where("block >= 0").groupBy("block"))
        asked = pairs.applyInPandas(asker(level), _ASKED)
        replies = answers.add(run_counts(asked, level, least_count, pull, divergence, bits, level == depth), dealt=False)
        del pairs, asked
    release(spark)
    found = texts.groupBy("block").cogroup(replies.where("block >= 0").groupBy("block")).applyInPandas(
        score, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return found.withColumnRenamed("id", key)
