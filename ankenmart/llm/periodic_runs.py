"""Runs of periodic words in whole texts, by suffix-tree extension of Lyndon roots.

A run is a stretch of words with smallest period q, of at least ``least`` words and ``times`` periods, that no
neighbouring word extends. Its Lyndon root, under the order of words that fits the word after the run, is the
longest Lyndon word at its place, so the longest Lyndon words at all places, under an order and its reverse,
are candidates for all runs. A suffix tree (Ukkonen) gives both orders of the suffixes; the depths its Euler
tour passes between two leaves give, as range minima from a sparse table, the common words of two places in
constant time. The tree of the words extends a root to the right, that of the reversed words to the left.

A word of a run stands in it ``times`` times at least and a pair of neighbours ``times`` - 1 times. Words and
pairs that occur more seldom in a text are in no run; the trees are built of the stretches between them,
which loses none and leaves little of prose.

A text is worked on where it is read: no shuffle, and memory for the trees of one stretch.

Cases: a null text is empty, and an empty one has no words, no runs and an empty collapsed text; ids may be
null or repeated, each row is a text of its own; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.llm.common import text_of

#: Words a run has at least, and periods.
LEAST, TIMES = 6, 4


def suffix_tree(words: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's tree of the words, the last of which is 0 and stands nowhere else; words are below ``size``.

    For each node its parent, the first word and the length of the edge to it, and whether it is a leaf.
    The root is node 0.
    """
    n = len(words)
    start, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    node = edge = length = waiting = 0
    for i, word in enumerate(words):
        waiting += 1
        last = 0
        while waiting:
            if not length:
                edge = i
            place = node * size + words[edge]
            below = child.get(place)
            if below is None:
                child[place] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                first = start[below]
                span = end[below] - first
                if length >= span:
                    node = below
                    edge += span
                    length -= span
                    continue
                if words[first + length] == word:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(start)
                child[place] = split
                child[split * size + word] = split + 1
                start += (first, i)
                end += (first + length, n)
                link += (0, 0)
                start[below] = first + length
                child[split * size + words[first + length]] = below
                if last:
                    link[last] = split
                last = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    nodes = np.fromiter(child.values(), "i8", len(child))
    places = np.fromiter(child.keys(), "i8", len(child))
    parent, first_word = np.zeros(len(start), "i8"), np.zeros(len(start), "i8")
    parent[nodes], first_word[nodes] = places // size, places % size
    ends = np.array(end, "i8")
    return parent, first_word, ends - np.array(start, "i8"), ends == n


def _tour(parent: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The nodes in the order an Euler tour first meets them, children by their key."""
    order = np.lexsort((-key[1:], parent[1:])) + 1  # the last pushed child is met first
    edges = np.searchsorted(parent[order], np.arange(len(parent) + 1)).tolist()
    children, met, stack = order.tolist(), [], [0]
    while stack:
        node = stack.pop()
        met.append(node)
        x, y = edges[node], edges[node + 1]
        if y > x:
            stack += children[x:y]
    return np.array(met, "i8")


class CommonWords:
    """How many words two places of a text have in common, from the Euler tour of its suffix tree.

    ``rank`` is the place of each suffix in the order of words, ``reverse_rank`` in that of the words reversed;
    in both the end comes before all words.
    """

    def __init__(self, codes: np.ndarray, both: bool = True) -> None:
        words, n = [*(codes + 1).tolist(), 0], len(codes) + 1
        size = int(codes.max(initial=0)) + 2
        parent, first_word, length, leaf = suffix_tree(words, size)
        met = _tour(parent, first_word)
        depth = [0] * len(parent)
        up, along = parent.tolist(), length.tolist()
        for node in met[1:].tolist():
            depth[node] = depth[up[node]] + along[node]
        depth = np.array(depth, "i8")
        suffix = n - depth

        def ranked(tour: np.ndarray) -> np.ndarray:
            rank = np.empty(n, "i4")
            rank[suffix[tour[leaf[tour]]]] = np.arange(n, dtype="i4")
            return rank

        self.rank = ranked(met)
        if both:
            self.reverse_rank = ranked(_tour(parent, np.where(first_word > 0, size - first_word, 0)))
        # The tour turns at the parent of the node it meets after a leaf: the lowest common ancestor of two
        # leaves is the highest of the turns between them.
        after = np.flatnonzero(leaf[met[:-1]]) + 1
        row = depth[parent[met[after]]].astype("i4")
        self.minima = [row]
        while len(row) > (step := 1 << (len(self.minima) - 1)):
            row = np.minimum(row[:-step], row[step:])
            self.minima.append(row)

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words from each place of ``a`` and its other place in ``b`` on."""
        x, y = self.rank[a], self.rank[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((y - x).astype("f8"))[1] - 1
        out = np.empty(len(x), "i8")
        for k in np.unique(level):
            at = level == k
            row = self.minima[k]
            out[at] = np.minimum(row[x[at]], row[y[at] - (1 << int(k))])
        return out


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """The next place whose suffix ranks lower: where the longest Lyndon word at a place ends."""
    ranks, out, stack = rank.tolist(), [0] * (len(rank) - 1), [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        own = ranks[i]
        while ranks[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, "i8")


def stretch_runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Start, length and period of the runs of a stretch of numbered words, ``times`` being 3 or more."""
    n = len(codes)
    right = CommonWords(codes)
    begin = np.arange(n)
    ends = np.concatenate([_next_smaller(right.rank), _next_smaller(right.reverse_rank)])
    begin = np.concatenate([begin, begin])
    some = (ends - begin) * times <= n
    begin, ends = begin[some], ends[some]
    period, more = ends - begin, right.between(begin, ends)
    # The first root of a run starts within its first period: all but two periods lie right of that root.
    some = more > (times - 2) * period - 1
    begin, ends, period, more = begin[some], ends[some], period[some], more[some]
    if not len(begin):
        return np.empty((0, 3), "i8")
    left = CommonWords(np.ascontiguousarray(codes[::-1]), both=False).between(n - begin, n - ends)
    length = left + period + more
    found = np.stack([begin - left, length, period], axis=1)
    return np.unique(found[length >= np.maximum(least, times * period)], axis=0)


def text_runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Start, length and period of the runs of a text of numbered words, by start, then period."""
    none = np.empty((0, 3), "i8")
    if len(codes) < least:
        return none
    often = np.bincount(codes)[codes] >= times
    joined = often[:-1] & often[1:]
    at = np.flatnonzero(joined)
    if len(at) < least - 1:
        return none
    pairs, place, counts = np.unique(codes[at] * (codes.max() + 1) + codes[at + 1], return_inverse=True, return_counts=True)
    joined[at] = (counts >= times - 1)[place]
    edge = np.diff(joined.astype("i1"), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
    long = last - first >= least
    found = [none]
    for x, y in zip(first[long], last[long], strict=True):
        own, numbered = np.unique(codes[x:y], return_inverse=True)
        found.append(stretch_runs(numbered.astype("i8"), least, times) + [x, 0, 0])
    return np.concatenate(found)


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Words that no run contains after its first period."""
    change = np.zeros(n + 1, "i8")
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


_FOUND = "{} {}, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed binary"


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """key, n_words, runs (start, length and period of each, by start, then period) and the collapsed text of
    each row: its words but those a run repeats, joined by one space. ``times`` is 3 or more."""
    if times < 3:
        raise ValueError("runs are found from three periods on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, collapsed = [], [], []
            for body in batch.column(1).to_pylist():
                words = body.split()  # of bytes, so at ASCII white space
                number: dict[bytes, int] = {}
                codes = np.array([number.setdefault(w, len(number)) for w in words], "i8")
                runs = text_runs(codes, least, times)
                if len(runs):
                    words = [words[i] for i in np.flatnonzero(_kept(len(words), runs))]
                counts.append(len(codes))
                found.append(runs)
                collapsed.append(b" ".join(words))
            ends = np.cumsum([0, *map(len, found)]).astype("i4")
            runs = np.concatenate(found or [np.empty((0, 3), "i8")])
            parts = [pa.ListArray.from_arrays(ends, np.ascontiguousarray(runs[:, i])) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), *parts, pa.array(collapsed, pa.binary())],
                names=[batch.schema.names[0], "n_words", "starts", "lengths", "periods", "collapsed"],
            )

    rows = docs.select(key, text_of(text).cast("binary").alias("_text"))
    kind = rows.schema[key].dataType.simpleString()
    found = rows.mapInArrow(run, _FOUND.format(f"`{key}`", kind))
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select(key, "n_words", runs.alias("runs"), F.col("collapsed").cast("string").alias("collapsed"))
