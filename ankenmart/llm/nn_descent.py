"""Approximate nearest neighbours by inner product: NN-descent builds the graph, greedy search reads it.

The graph begins with the best neighbours found in leaves of random-projection trees. Each step then joins
the neighbours of neighbours: the members of a node's list, sampled from both directions of its edges, are
compared with each other, and every member keeps the best it has met. A query walks the graph from its own
neighbours, in rounds that expand its best unexpanded nodes. Steps go on until few list entries change, rounds
until every node of every query's beam is expanded, so the effort follows the data at every size. All rows are indexed; sampling concerns edges
only, and its loss is measured as recall against brute force. Vectors travel as 16-bit floats, each
scaled by its own power of two, which travels along and is multiplied back into the scores; the last
check computes the measure in double precision on the original ones.

Cases: vectors that are null, zero, hold null or non-finite components, have no id, or differ in length
from most take no part; equal vectors are one node, and the smallest ids of each stand for them; rows of one id count once, by the least vector; equal measures go to the smaller
id; fewer candidates than asked for are all returned; an empty table gives no rows; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ankenmart.llm.common import saved

NEIGHBOURS = 20
DEGREE = 64
LEAF = 256
TREES = 10
#: Share of list entries a step must change for another step.
DELTA = 0.1
#: Members of a node's list taken from either direction, and what each member takes from one list.
SAMPLE = 28
TAKE = 16
BEAM, EXPANDED = 96, 32
#: Nodes, and queries with all they meet in a round, that one task holds together.
BLOCK, QUERY_BLOCK = 256, 32

_LISTS = "node long, ids binary, scores binary"


def valid(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vector (doubles) of the rows that take part, one an id."""
    kept = rows.select(F.col(key).cast("long").alias("node"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("node").isNotNull()
        & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = kept.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.where(F.size("vector") == (lengths["n"] if lengths else 0)).groupBy("node").agg(F.min("vector").alias("vector"))


def _packed(vector: np.ndarray) -> bytes:
    """16-bit floats after the power of two they are to be multiplied by."""
    power = np.frexp(np.abs(vector).max())[1]
    return np.int16(power).tobytes() + np.ldexp(vector, -power).astype("f2").tobytes()


def _matrix(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Scaled vectors, and what a score with each is to be multiplied by: the same power of two less for all."""
    x = np.frombuffer(b"".join(vectors), "f2").reshape(len(vectors), -1)
    return x[:, 1:].astype("f4"), np.ldexp(1.0, x[:, 0].copy().view("i2") - 64)


def _places(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 on in the order of the values, and how many there can be: the values less the least where
    they are near each other, else their ranks."""
    least, span = int(values.min()), int(values.max()) - int(values.min()) + 1
    if span < 1 << 31:
        return values - least, span
    ranked, places = np.unique(values, return_inverse=True)
    return places, len(ranked)


def _best(nodes: np.ndarray, ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Of each node the ``most`` best ids, each id once."""
    if not len(nodes):
        return nodes, ids, scores
    (node, _), (id_, n) = _places(nodes), _places(ids)
    pair = node * n + id_
    order = np.argsort(pair)
    pair = pair[order]
    new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    scores, order = np.fmax.reduceat(scores[order], new), order[new]
    nodes, ids = nodes[order], ids[order]
    group = np.cumsum(np.append(False, nodes[1:] != nodes[:-1]))
    if group[-1] < 1 << 16:  # sorted by counting
        group = group.astype("u2")
    # By node and id before, so that stable sorts leave equal scores by id.
    order = np.argsort(-scores, kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    nodes, ids, scores = nodes[order], ids[order], scores[order]
    first = np.searchsorted(nodes, nodes, side="left")
    some = np.arange(len(nodes)) - first < most
    return nodes[some], ids[some], scores[some]


def _lists(nodes: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
    """Sorted edges as one row a node."""
    starts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.zeros(0, "i8")
    ends = np.append(starts[1:], len(nodes)) if len(nodes) else starts
    return pd.DataFrame(
        {
            "node": nodes[starts],
            "ids": [ids[a:b].astype("i8").tobytes() for a, b in zip(starts, ends, strict=True)],
            "scores": [scores[a:b].astype("f8").tobytes() for a, b in zip(starts, ends, strict=True)],
        }
    )


def _edges(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    ids = np.frombuffer(b"".join(frame["ids"]), "i8")
    nodes = np.repeat(frame["node"].to_numpy("i8"), [len(x) // 8 for x in frame["ids"]])
    return nodes, ids, np.frombuffer(b"".join(frame["scores"]), "f8")


def _blocks(column: str, n: int, size: int = BLOCK) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(max(1, -(-n // size)))).cast("int").alias("block")


def _improved(n: int, degree: int, old: DataFrame, met: DataFrame) -> DataFrame:
    """One list a node of the old lists and those that were met, and the number of its entries that no old one has."""

    def merge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        nodes, ids, scores = (np.concatenate(both) for both in zip(_edges(left), _unpacked(right), strict=True))
        out = _lists(*_best(nodes, ids, scores, degree))
        had = {node: np.frombuffer(ids, "i8") for node, ids in zip(left["node"], left["ids"], strict=True)}
        none = np.zeros(0, "i8")
        new = [(~np.isin(np.frombuffer(ids, "i8"), had.get(node, none))).sum() for node, ids in zip(out["node"], out["ids"], strict=True)]
        return out.assign(changed=np.array(new, "i8"))

    pairs = old.select("*", _blocks("node", n)).groupBy("block").cogroup(met.groupBy("home"))
    return pairs.applyInPandas(merge, _LISTS + ", changed long")


_MET = "home int, nodes binary, sizes binary, ids binary, scores binary"


def _by_home(nodes: np.ndarray, ids: np.ndarray, scores: np.ndarray, homes: np.ndarray) -> pd.DataFrame:
    """Sorted edges as one row for all nodes of a home, the block of a node's list: the rows a block sends are never
    more than there are blocks, nor than the nodes that met in it."""
    order = np.argsort(homes, kind="stable")
    nodes, ids, scores, homes = nodes[order], ids[order], scores[order], homes[order]
    starts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.zeros(0, "i8")
    sizes = np.diff(starts, append=len(nodes))
    home = homes[starts]
    first = np.flatnonzero(np.append(True, home[1:] != home[:-1])) if len(home) else np.zeros(0, "i8")
    lists = list(zip(first, np.append(first[1:], len(home)), strict=True)) if len(home) else []
    edges = np.append(starts, len(nodes))
    return pd.DataFrame(
        {
            "home": home[first],
            "nodes": [nodes[starts[a:b]].astype("i8").tobytes() for a, b in lists],
            "sizes": [sizes[a:b].astype("i4").tobytes() for a, b in lists],
            "ids": [ids[edges[a] : edges[b]].astype("i8").tobytes() for a, b in lists],
            "scores": [scores[edges[a] : edges[b]].astype("f8").tobytes() for a, b in lists],
        }
    )


def _unpacked(frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    nodes, sizes, ids, scores = (np.frombuffer(b"".join(frame[c]), t) for c, t in (("nodes", "i8"), ("sizes", "i4"), ("ids", "i8"), ("scores", "f8")))
    return np.repeat(nodes, sizes), ids, scores


def _merged(lists: DataFrame, n: int, degree: int) -> DataFrame:
    """One list a node, and the number of its entries."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        out = _lists(*_best(*_edges(frame), degree))
        return out.assign(changed=np.array([len(ids) // 8 for ids in out["ids"]], "i8"))

    return lists.select("*", _blocks("node", n)).groupBy("block").applyInPandas(merge, _LISTS + ", changed long")


def start(vectors: DataFrame, n: int, dim: int, degree: int, leaf: int, trees: int) -> DataFrame:
    """Best neighbours within leaves of a forest: a tree cuts by the signs of its hyperplanes, a leaf that
    holds too many is dealt by hash. The first tree deals by hash alone, so that each node gets a list."""
    depth = max(0, int(np.ceil(np.log2(max(n / leaf, 1)))))
    planes = np.random.default_rng(5).standard_normal((dim, max(depth, 1) * trees)).astype("f4")

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            signs = (_matrix(frame["vector"])[0] @ planes > 0).reshape(len(frame), trees, -1)[:, :, :depth]
            number = signs @ (1 << np.arange(depth, dtype="i8")) if depth else np.zeros((len(frame), trees), "i8")
            number[:, 0] = 0
            for tree in range(trees):
                yield frame.assign(tree=tree, leaf=number[:, tree])

    def nearest(frame: pd.DataFrame) -> pd.DataFrame:
        (x, scale), ids, k = _matrix(frame["vector"]), frame["node"].to_numpy("i8"), min(degree, len(frame) - 1)
        if not k:
            return pd.DataFrame({"node": ids, "ids": b"", "scores": b""})
        s = x @ x.T * scale
        np.fill_diagonal(s, -np.inf)
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        found = np.take_along_axis(s, top, axis=1)
        return pd.DataFrame({"node": ids, "ids": [ids[t].tobytes() for t in top], "scores": [f.tobytes() for f in found]})

    placed = vectors.mapInPandas(leaves, "node long, vector binary, tree int, leaf long")
    sizes = placed.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / leaf).alias("parts"))
    parted = placed.join(sizes, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))
    found = parted.groupBy("tree", "leaf", "part").applyInPandas(nearest, _LISTS)
    return saved(_merged(found, n, degree), "graph")


def _pairs(graph: DataFrame, most: int, seed: int) -> DataFrame:
    """(node, member): ``most`` of each list, others for each seed."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            heads = [
                np.random.default_rng((seed, node & (1 << 63) - 1)).permutation(np.frombuffer(x, "i8"))[:most]
                for node, x in zip(frame["node"].tolist(), frame["ids"], strict=True)
            ]
            nodes = np.repeat(frame["node"].to_numpy("i8"), [len(h) for h in heads])
            yield pd.DataFrame({"node": nodes, "member": np.concatenate(heads) if heads else nodes})

    return graph.mapInPandas(run, "node long, member long")


def both_ways(graph: DataFrame, forward: int, backward: int, seed: int = 0) -> DataFrame:
    """(node, member) of the lists and of the nodes in whose lists one is, either a sample by hash."""
    out = _pairs(graph, forward, seed)
    order = W.partitionBy("node").orderBy(F.xxhash64("node", "member", F.lit(seed)), "member")
    back = out.select(F.col("member").alias("node"), F.col("node").alias("member"))
    some = back.withColumn("place", F.row_number().over(order)).where(F.col("place") <= backward).drop("place")
    return out.unionByName(some)


def descend(graph: DataFrame, vectors: DataFrame, n: int, degree: int, sample: int, take: int, seed: int) -> DataFrame:
    """One step: the members of each list meet."""

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["node", "member"])
        (x, scale), ids, nodes = _matrix(frame["vector"]), frame["member"].to_numpy("i8"), frame["node"].to_numpy("i8")
        starts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(nodes)), strict=True):
            own, part = np.unique(ids[a:b], return_index=True)
            if len(own) < 2:
                continue
            s = x[a:b][part] @ x[a:b][part].T * scale[a:b][part]
            np.fill_diagonal(s, -np.inf)
            k = min(take, len(own) - 1)
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out.append((np.repeat(own, k), own[top].ravel(), np.take_along_axis(s, top, axis=1).ravel()))
        joined = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, t) for t in ("i8", "i8", "f8")]
        best = _best(*joined, degree)
        each, place = np.unique(ids, return_index=True)
        return _by_home(*best, frame["home"].to_numpy("i4")[place][np.searchsorted(each, best[0])])

    members = both_ways(graph, sample, sample, seed).join(vectors.withColumnRenamed("node", "member"), "member")
    dealt = members.select("*", _blocks("member", n).alias("home"), _blocks("node", n))
    met = dealt.groupBy("block").applyInPandas(meet, _MET)
    return saved(_improved(n, degree, graph.drop("changed"), met), "graph")


def descended(graph: DataFrame, vectors: DataFrame, n: int, degree: int, sample: int, take: int, delta: float) -> DataFrame:
    """Steps until one changes less than ``delta`` of the entries."""
    step = 0
    while True:
        step += 1
        graph = descend(graph, vectors, n, degree, sample, take, step)
        sums = graph.agg(F.sum("changed").alias("changed"), F.sum(F.octet_length("ids") / 8).alias("entries")).first()
        if (sums["changed"] or 0) <= delta * (sums["entries"] or 0):
            return graph


_STATE = "block int, node long, vector binary, ids binary, scores binary, expanded binary"


def _frontier(row, beam: int, expanded: int) -> np.ndarray:
    """Places of the best nodes of the beam not yet expanded."""
    done = np.frombuffer(row.expanded, bool)
    best = np.argsort(-np.frombuffer(row.scores, "f8"), kind="stable")[:beam]
    return best[~done[best]][:expanded]


def _unexpanded(beam: int):
    """Whether a beam holds a node that is not expanded."""

    @F.pandas_udf("boolean")
    def any_left(scores: pd.Series, expanded: pd.Series) -> pd.Series:
        best = [np.argsort(-np.frombuffer(s, "f8"), kind="stable")[:beam] for s in scores]
        return pd.Series([not np.frombuffer(e, bool)[b].all() for e, b in zip(expanded, best, strict=True)], dtype=bool)

    return any_left


def search(
    graph: DataFrame, vectors: DataFrame, queries: DataFrame, n_queries: int, degree: int, beam: int, expanded: int
) -> DataFrame:
    """(node, member): the beam of each query (a node of the graph) once all of it is expanded. A round expands at
    least one node of each query that is not done, and nodes only leave a beam for better ones, so rounds end."""
    paths = both_ways(graph, degree, degree)
    paths = saved(paths.groupBy("node").agg(F.collect_set("member").alias("members")), "paths")
    state = (
        queries.select("node")
        .join(graph.drop("changed"), "node")
        .join(vectors, "node")
        .select(_blocks("node", n_queries, QUERY_BLOCK), "node", "vector", "ids", "scores", F.expr("cast(repeat('\\0', length(ids) div 8) as binary)").alias("expanded"))
    )
    state = saved(state, "search")

    def fronts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = [np.frombuffer(r.ids, "i8")[_frontier(r, beam, expanded)] for r in frame.itertuples(index=False)]
            counts = [len(a) for a in at]
            yield pd.DataFrame(
                {
                    "block": np.repeat(frame["block"].to_numpy("i4"), counts),
                    "query": np.repeat(frame["node"].to_numpy("i8"), counts),
                    "node": np.concatenate(at) if at else np.zeros(0, "i8"),
                }
            )

    def unseen(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        near = right.groupby("query")["members"].agg(lambda m: np.unique(np.concatenate(m.tolist())))
        out = []
        for row in left.itertuples(index=False):
            if row.node in near.index:
                new = np.setdiff1d(near[row.node], np.append(np.frombuffer(row.ids, "i8"), row.node))
                out.append(pd.DataFrame({"block": row.block, "query": row.node, "node": new}))
        return pd.concat(out) if out else pd.DataFrame({"block": [], "query": [], "node": []})

    def advance(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values(["query", "node"])
        (x, scale), query, met = _matrix(right["vector"]) if len(right) else (None, None), right["query"].to_numpy(), right["node"].to_numpy("i8")
        out = []
        for row in left.itertuples(index=False):
            done = np.frombuffer(row.expanded, bool).copy()
            done[_frontier(row, beam, expanded)] = True
            a, b = np.searchsorted(query, [row.node, row.node + 1])
            scores = x[a:b] @ _matrix([row.vector])[0][0] * scale[a:b] if b > a else np.zeros(0)
            out.append(
                (
                    row.block, row.node, row.vector, row.ids + met[a:b].tobytes(),
                    row.scores + scores.astype("f8").tobytes(), done.tobytes() + bytes(b - a),
                )
            )
        return pd.DataFrame(out, columns=["block", "node", "vector", "ids", "scores", "expanded"])

    # Done when no query's beam holds a node that is not expanded.
    left = F.sum(_unexpanded(beam)("scores", "expanded").cast("long"))
    while state.agg(left.alias("left")).first()["left"]:
        front = state.mapInPandas(fronts, "block int, query long, node long")
        reached = front.join(paths, "node").select("block", "query", "members").groupBy("block")
        new = state.groupBy("block").cogroup(reached).applyInPandas(unseen, "block int, query long, node long")
        scored = new.join(vectors, "node").groupBy("block")
        state = saved(state.groupBy("block").cogroup(scored).applyInPandas(advance, _STATE), "search")

    def beams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                best = np.argsort(-np.frombuffer(row.scores, "f8"), kind="stable")[:beam]
                yield pd.DataFrame({"node": row.node, "member": np.frombuffer(row.ids, "i8")[best]})

    return state.mapInPandas(beams, "node long, member long")


def nearest(
    rows: DataFrame,
    every: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    neighbours: int = NEIGHBOURS,
    degree: int = DEGREE,
    leaf: int = LEAF,
    trees: int = TREES,
    delta: float = DELTA,
    sample: int = SAMPLE,
    take: int = TAKE,
    beam: int = BEAM,
    expanded: int = EXPANDED,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found of each row whose id is divisible by ``every``."""
    whole = saved(valid(rows, key, vector), "vectors")
    # A result has no more of one vector's ids than these, the query itself apart.
    place = F.row_number().over(W.partitionBy("vector").orderBy("node"))
    least = whole.withColumn("place", place).where(F.col("place") <= neighbours + 1)
    classes = least.groupBy("vector").agg(F.sort_array(F.collect_list("node")).alias("ids"))
    classes = saved(classes.select(F.get("ids", F.lit(0)).alias("node"), "vector", "ids"), "classes")
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    n = stats["n"]

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"node": frame["node"], "vector": [_packed(v) for v in frame["vector"]]})

    vectors = saved(classes.select("node", "vector").mapInPandas(pack, "node long, vector binary"), "packed")
    graph = start(vectors, n, stats["dim"] or 1, degree, leaf, trees)
    graph = descended(graph, vectors, n, degree, sample, take, delta)
    asked = whole.where(F.col("node") % every == 0).withColumnRenamed("node", "query_id")
    asked = saved(asked.join(classes.select("node", "vector"), "vector").select("query_id", "node"), "asked")
    queries = saved(asked.select("node").distinct(), "queries")
    found = search(graph, vectors, queries, max(1, queries.count()), degree, beam, expanded)
    found = found.unionByName(queries.select("node", F.col("node").alias("member")))  # copies of the query
    product = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    exact = (
        found.join(classes.select("node", F.col("vector").alias("a")), "node")
        .join(classes.select(F.col("node").alias("member"), F.col("vector").alias("b"), "ids"), "member")
        .select("node", product.alias("score"), F.explode("ids").alias("vec_id"))
    )
    near = F.row_number().over(W.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    best = exact.withColumn("place", near).where(F.col("place") <= neighbours + 1).drop("place")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    each = asked.join(best, "node").where(F.col("query_id") != F.col("vec_id"))
    return each.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= neighbours)
