"""The corpus operators against brute force, and on odd tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ankenmart.llm import mixing, nn_descent, packing, pii, quality, queries, sharding, simhash, suffix_tree, token_files
from ankenmart.llm import tokens, weighted_sampling
from ankenmart.llm.common import order_key
from ankenmart.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20_000
ODD = [
    (1, "plain words here, a.b@c.org", "x"), (1, "plain words here, a.b@c.org", "x"), (2, None, "x"), (3, "", None),
    (4, " \t\n", None), (None, "no id at all", "y"), (None, None, "y"), (5, LONG, "y"), (6, "word", "y"),
    (7, "same text twice over", "z"), (8, "same text twice over", "z"), (9, "<|endoftext|> 日本。 x²  y \n z", None),
]
CLASHES = "id row body spans base size copies score predicted kept_0 lane shard fp text_key hash key bucket place block order".split()


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    rows = rows.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
    return rows.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 14 <= len(d) <= 19 and sum(c if i % 2 == 0 else 2 * c - 9 * (c > 4) for i, c in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_pii_base_spans(spark, texts):
    found = by_id(queries.op1_weakly_supervised_pii(spark, SF_DIR))
    for id_, text in texts.items():
        want = base_spans(text)
        assert found[id_]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) <= set(found[id_]["spans"].split(","))


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c_d@e.fg x@y.z. .@-.- a@b", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004 1.2.3", "9" * 30_000, "a" * 30_000,
        "4111 1111 1111 1111-4111111111111111 4111-1111-1111-1111 1", "é4111111111111111ü +1 (234) 567-8901 +12345",
        "😀x@y.zz 😀 +4912345678901", "+1-" + "2" * 40, "",
    ],
)
def test_pii_odd_texts(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.find(docs, pii.Model({}, (-9.0,) + (0.0,) * 13)).select(pii.listed("spans").alias("s")).first()
    assert row["s"] == base_spans(text)


def test_pii_adds_and_redacts(spark):
    docs = spark.createDataFrame(
        [(1, "Dr. Meier, phone 555-123-4567, mail a@b.com and ssn 123-45-6789.", 0)], "doc_id long, text string, n_chars long"
    )
    row = pii.redact(docs).first()
    assert row["text"] == "[NAME], phone [LOCAL_PHONE], mail [EMAIL] and ssn [NATIONAL_ID]."
    assert row["n_chars"] == len(row["text"])


def test_em_finds_the_better_labeler():
    votes = np.array(list(itertools.product((-1, 1), repeat=3)))
    truth = np.random.default_rng(0).random(4000) < 0.5
    rates = (0.95, 0.95, 0.55)
    drawn = np.stack([np.where(np.random.default_rng(i + 1).random(4000) < r, truth, ~truth) for i, r in enumerate(rates)], 1)
    counts = np.array([((drawn * 2 - 1) == v).all(axis=1).sum() for v in votes], float)
    _, table = pii._em(votes, counts, 50)
    assert table[1, 0, 2] > 0.9 and table[1, 1, 2] > 0.9 and table[1, 2, 2] < 0.65


def test_tokens_equal_the_library(texts):
    library, own = Tokenizer.from_file(tokens.TOKENIZER), tokens.Encoder(tokens.TOKENIZER, remembered=50)
    odd = ["a  b", "a \n b", "x.'s it's, we'll! foo.- b!", "<|endoftext|> x", " lead  ", "t\t\tx\x1c!", "  z. é. 日本。½. x²."]
    every = [*texts.values(), *odd, ""]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in every]
    assert own.encode(every) == want and own.encode(every) == want


def test_packing(spark, texts):
    library = Tokenizer.from_file(tokens.TOKENIZER)
    rows = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), lane_pieces=100).collect()
    places, pieces = collections.defaultdict(list), collections.defaultdict(dict)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id][r.piece] = r
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for id_, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n in range(len(pieces[id_])):
            r = pieces[id_][n]
            assert r.start == at and (r.length == 2048 or n == 0)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    assert len(places) <= 1.08 * sum(r.length for r in rows) / 2048 + 2


def test_open_bins_are_bounded_and_fit_best():
    bins, free, draw = packing.OpenBins(100, 5), {}, np.random.default_rng(2)
    for length in draw.integers(1, 101, 500).tolist():
        fits = [f for f in free.values() if f >= length]
        bin_, offset = bins.place(length)
        assert (100 - offset) == (min(fits) if fits else 100)
        free[bin_] = 100 - offset - length
        if not free[bin_]:
            del free[bin_]
        if len(free) > 5:
            del free[min(free, key=lambda b: (free[b], b != max(k for k in free if free[k] == free[b])))]
        assert bins.count == len(free) and sorted(free.values()) == sorted(f for f in range(101) for _ in bins.bins[f])


def test_suffix_tree(spark, texts):
    found = by_id(queries.op3_suffix_tree_scores(spark, SF_DIR))
    counts = collections.Counter()
    for id_, text in texts.items():
        if zlib.crc32(str(id_).encode()) % 5 != 1:
            counts.update([*words(text), "\n"])
    n, v = sum(counts.values()), len(counts)
    for id_, text in texts.items():
        own, r = [*words(text), "\n"], found[id_]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_suffix_tree_learns_contexts_and_sums_to_one(spark):
    rows = [(i, ("a b c d " if i % 2 else "x b e f ") * 30) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_tree.scores(docs).collect()
    assert all(r.score / r.n_tokens > -0.12 for r in found)  # "b" is followed by c or e as the word before it says
    tree = suffix_tree.Tree(np.array([1, 2, 3], "u8"), np.array([50, 30, 20]), 100, 3, 6.0)
    tree.add_level(np.array([1, 4 + 0, 8 + 2], "i8"), np.array([40, 25, 15]), 0.0)
    for context in range(3):
        p = tree.unigram(tree.counts.astype(float))
        last = np.arange(3)
        q = tree.smoothed(p, 1, np.full(3, context), tree.runs(1, np.full(3, context), last))
        unseen = (0.5 / (100 + 0.5 * 4)) * tree.rest[0][context]
        assert math.isclose(q.sum() + unseen, 1.0, rel_tol=1e-9)


def test_suffix_tree_keeps_rare_runs_whatever_the_corpus(spark):
    draw = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 30_000, 1500)) for _ in range(1500)]
    in_training = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1][:3]
    for i in in_training:
        texts[i] += " north pole"
    held = next(i for i in itertools.count(9_000_000) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = [*enumerate(texts), (held, "north pole")]
    found = by_id(suffix_tree.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)))[held]
    # 3 occurrences are below 2e-6 of all tokens; they are enough to expect "pole" after "north".
    assert found.held_out and found.train_tokens * 2e-6 > 3
    assert found.score - found.base_score > 3


def test_suffix_tree_equals_the_tree_in_memory(spark, texts):
    some = dict(list(texts.items())[:120])
    docs = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(5)
    found = by_id(suffix_tree.scores(docs, block_bytes=20_000, bucket_entries=2_000))
    runs = [collections.Counter() for _ in range(4)]
    for id_, text in some.items():
        if zlib.crc32(str(id_).encode()) % 5 != 1:
            own = [*words(text), "\n"]
            for k in range(4):
                runs[k].update(tuple(own[i : i + k + 1]) for i in range(len(own) - k))
    kept = [{r: n for r, n in level.items() if n >= 2} for level in runs]
    names = sorted(w for (w,) in kept[0])
    tree = suffix_tree.Tree(np.arange(len(names), dtype="u8"), np.array([kept[0][(w,)] for w in names]), sum(runs[0].values()), len(runs[0]), suffix_tree.PULL)
    number = {(w,): i for i, w in enumerate(names)}
    numbers = [number]
    for k in range(1, 4):
        keyed = {numbers[-1][r[:-1]] * tree.stride + number[r[-1:]]: r for r in kept[k]}
        tree.add_level(np.array(list(keyed), "i8"), np.array([kept[k][r] for r in keyed.values()]), suffix_tree.DIVERGENCE)
        numbers.append({keyed[x]: i for i, x in enumerate(tree.keys[-1].tolist())})
    for id_, text in some.items():
        own = [*words(text), "\n"]
        total = 0.0
        for i, w in enumerate(own):
            p = tree.unigram(np.array([float(runs[0][(w,)])]))
            for k in range(1, min(i, 3) + 1):
                context, run = (numbers[len(r) - 1].get(r, -1) for r in (tuple(own[i - k : i]), tuple(own[i - k : i + 1])))
                p = tree.smoothed(p, k, np.array([context]), np.array([run]))
            total += math.log10(p[0])
        assert math.isclose(found[id_].score, total, rel_tol=1e-9)


def test_packed_values():
    draw = np.random.default_rng(1)
    for kind in ("u1", "u4", "i8", "f4", "f8"):
        for n in (0, 1, 1000):
            values = draw.integers(0, 200, n).astype(kind)
            assert np.array_equal(suffix_tree._unpacked(suffix_tree._packed(values), kind), values)
    for values in ([], [7], [0, 5, 5, 1 << 63, (1 << 64) - 1]):
        values = np.array(values, "u8")
        assert np.array_equal(suffix_tree._unpacked_rising(suffix_tree._packed_rising(values), "u8"), values)
    sizes = np.array([0, 3, 0, 1, 2, 0], "u4")
    values = np.array([5, 9, (1 << 32) - 1, 0, 2, 2], "u4")
    assert np.array_equal(suffix_tree._unpacked_within(suffix_tree._packed_within(values, sizes), "u4", sizes), values)
    none = np.zeros(0, "u4")
    assert len(suffix_tree._unpacked_within(suffix_tree._packed_within(none, none), "u4", none)) == 0
    p = 10.0 ** draw.uniform(-14, 0, 1000)
    kept = suffix_tree._long(suffix_tree._short(p))
    assert (np.abs(kept / p - 1) <= 2**-12).all()
    assert np.array_equal(suffix_tree._long(suffix_tree._short(kept)), kept)


def test_slices_are_halved_as_the_table_grows():
    sizes = [10**k for k in range(12)]
    widths = [simhash.slice_widths(n) for n in sizes]
    assert widths[0] == [8] * 8 and widths[-1] == [4] * 16
    assert all(sum(w) == 64 for w in widths) and [len(w) for w in widths] == sorted(len(w) for w in widths)
    for n, w in zip(sizes, widths, strict=True):
        met = n * math.prod(math.comb(2 * b, b) / 4**b for b in w)
        assert met <= simhash.LEAF or len(w) == 16


def test_simhash(spark, texts):
    found = by_id(queries.op4_vantage_point_simhash(spark, SF_DIR))
    for id_, text in texts.items():
        w = words(text)
        runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert int(found[id_]["fingerprint"], 16) == want


def test_vantage_point_tree_finds_every_close_pair(spark):
    draw = np.random.default_rng(3)
    centres = draw.integers(0, 1 << 63, 40, dtype="u8")
    prints = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(15):
            prints.add(c ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(1, 4), replace=False)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints] + [0, -1]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {frozenset(r) for r in simhash.close_pairs(nodes).collect()}
    rows = simhash.close_pairs(nodes).count()
    want = {frozenset(p) for p in itertools.combinations(signed, 2) if ((p[0] ^ p[1]) & ((1 << 64) - 1)).bit_count() <= 2}
    assert found == want and rows == len(want)
    for leaf in (len(signed) / 1e7, 0):  # some slices halved, all of them
        deeper = simhash.close_pairs(nodes, leaf=leaf).collect()
        assert {frozenset(r) for r in deeper} == want and len(deeper) == len(want)
    parent = {p: p for p in signed}
    for a, b in map(sorted, want):
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)

    def root(p):
        return p if parent[p] == p else root(parent[p])

    edges = spark.createDataFrame([tuple(p) for p in want], "a long, b long")
    assert all(r.root == root(r.node) for r in simhash.components(edges).collect())


def test_nn_descent(spark):
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((20, 16)) * 2
    x = (centres[draw.integers(0, 20, 3000)] + draw.standard_normal((3000, 16))).astype("f4")
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0, None] * 8), (None, [1.0] * 16), (5080, [1.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(8)
    found = collections.defaultdict(dict)
    for r in nn_descent.nearest(table, leaf=200, trees=6, degree=32).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(found) == set(range(0, 3000, 20))
    s = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(s, -np.inf)
    hits = 0
    for q, got in found.items():
        assert sorted(got) == list(range(1, 21))
        assert all(math.isclose(score, s[q, v], rel_tol=1e-9) for v, score in got.values())
        hits += len({v for v, _ in got.values()} & set(np.argsort(-s[q])[:20].tolist()))
    assert hits / (20 * len(found)) >= 0.9


def recall(spark, x, **given):
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    found = collections.defaultdict(dict)
    for r in nn_descent.nearest(table, **given).collect():
        found[r.query_id][r.rank] = r.vec_id
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    best = {q: np.lexsort((np.arange(len(x)), -s[q]))[:20].tolist() for q in range(0, len(x), 20)}
    return sum(len(set(best[q]) & set(found[q].values())) for q in best) / (20 * len(best)), found, best


def test_nn_descent_with_an_outlier(spark):
    x = np.random.default_rng(6).standard_normal((1500, 16))
    x[7] *= 1e10
    assert recall(spark, x, leaf=2048)[0] >= 0.95


def test_nn_descent_with_many_copies(spark):
    x = np.random.default_rng(7).integers(-8, 9, (2500, 16)) / 4.0  # sums are exact
    x[3] *= 4  # long enough for copies to be the best of copies
    x[np.random.default_rng(8).permutation(2500)[:1000]] = x[3]
    share, found, best = recall(spark, x, leaf=200)
    assert share >= 0.9
    for q in best:
        if (x[q] == x[3]).all():  # of copies those of the smallest ids come first
            assert [found[q][i + 1] for i in range(20)] == best[q]


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in nn_descent.nearest(table).orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert nn_descent.nearest(table.where("false")).count() == 0


def test_weighted_sampling(spark, texts):
    found = by_id(queries.op6_weighted_sampling_fingerprints(spark, SF_DIR))
    ids = sorted(texts, reverse=True)
    off = []
    for i, id_ in enumerate(ids):
        text, following = texts[id_], texts[ids[(i + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[id_]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (collections.Counter(words(t)) for t in (text, edited, following))
        for got, x, y in ((r.near_edited, a, b), (r.near_next, a, c)):
            off.append(got - sum((x & y).values()) / max(sum((x | y).values()), 1))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.1
    prints = collections.defaultdict(set)
    for id_, text in texts.items():
        prints[text].add(found[id_].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


CHAINS = {
    "outlier": [(i, f"text {i}") for i in range(300)] + [(10**15, "far off"), (-(10**15), "far below")],
    "no ids": [(i if i % 3 else None, f"text {i}") for i in range(300)],
    "one id": [(i if i % 3 else 7, f"text {i}") for i in range(300)],
    "equal rows": [(i, f"text {i}") for i in range(50)] + [(20, "the same")] * 333 + [(None, None)] * 100 + [(None, "x")] * 30,
    "all equal": [(1, "the same")] * 95,
    "one row": [(1, "alone")],
    "ends": [(-(1 << 63), "least"), ((1 << 63) - 1, "most"), (0, "zero"), (-1, "below")],
}


@pytest.mark.parametrize("name", CHAINS)
def test_chain_of_odd_ids(spark, name):
    held, given = 20, CHAINS[name]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    rows = [r for r in weighted_sampling.with_next(docs, "doc_id", "text", held).collect()]
    here = [r for r in rows if not r.guest]
    in_ = collections.Counter(r.bucket for r in here)
    assert max(in_.values()) <= 3 * held and len(in_) >= len(set(given)) // (3 * held)
    assert collections.Counter(r.bucket for r in rows if r.guest).keys() == in_.keys()
    got = collections.Counter()
    for r in here:
        got[r.id, r.text, r.next_text] += r.copies
    # Rows of an id may come in any order, the same in all runs: each is followed by one of its id, or by the next id.
    order = {(r.id, r.text) for r in here}
    keys = {(r.id, r.text): r.key for r in spark.createDataFrame(sorted(order, key=str), "id long, text string").select(
        "id", "text", order_key(F.col("id"), F.col("text"), descending=True).alias("key")).collect()}
    chain = sorted(((i, t or "") for i, t in given), key=lambda r: keys[r])
    ids = [i for i, _ in chain]
    assert ids == sorted((i for i in ids if i is not None), reverse=True) + [None] * ids.count(None)
    assert got == collections.Counter((i, t, n) for (i, t), (_, n) in zip(chain, chain[1:] + chain[:1], strict=True))
    printed = weighted_sampling.fingerprint_edits(docs, bucket_docs=held).collect()
    assert collections.Counter(r.doc_id for r in printed) == collections.Counter(ids)
    edits = collections.Counter((t[: len(t) - len(t) // 2] + n[: len(t) // 2]) for (_, t), (_, n) in zip(chain, chain[1:] + chain[:1], strict=True))
    assert collections.Counter(r.edited_sha256 for r in printed) == {hashlib.sha256(t.encode()).hexdigest(): c for t, c in edits.items()}


def test_mixing_of_a_hot_group_without_ids(spark):
    """Two thirds of the rows have no id, half of them are equal; the words taken are still those of the targets."""
    docs = spark.range(1, 3001).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 1, "the same four words").otherwise(F.concat(F.lit("these four words "), "id")).alias("text"),
    )
    rows = mixing.mix(docs, keep=("doc_id", "text")).collect()
    assert len(rows) == 3000 and {r.copies for r in rows} <= {0, 1, 2}
    assert sum(r.copies * r.size for r in rows) == 4 * 3000 * 1.5
    again = mixing.mix(docs.repartition(7), keep=("doc_id", "text")).collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(map(tuple, again))


def test_mixing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("source", F.expr("case when doc_id % 3 = 0 then 'big' else source end"))
    rows = mixing.mix(docs, keep=("doc_id", "source")).collect()
    sources = sorted({r.source for r in rows})
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert 0 <= r.copies <= 2
        size[r.source] += r.size
        taken[r.source] += r.copies * r.size
        target[r.source] = float(r.target)
    left, open_, want = 1.5 * sum(size.values()), {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}, {}
    while open_:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        for s in full or open_.copy():
            want[s] = 2 * size[s] if full else share[s]
        if not full:
            break
        left -= sum(want[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s not in full}
    for s in sources:
        assert math.isclose(target[s], want[s], rel_tol=1e-6)
        assert abs(taken[s] - target[s]) <= 0.01 * target[s] + 30
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(5), keep=("doc_id", "source")).collect()))


def test_sharding(spark, texts):
    rows = sharding.shard(spark.read.parquet(f"{SF_DIR}/documents.parquet"), cell_groups=100, heavy_share=0.02).collect()
    slots, load = collections.defaultdict(list), collections.Counter()
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(texts)
    assert max(load.values()) <= 1.05 * sum(load.values()) / 8


def test_sharding_splits_a_hot_group(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'the same text', 'text ' || id)").alias("text"))
    rows = sharding.shard(docs).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    assert len(rows) == 8 and max(r.b for r in rows) <= 1.03 * min(r.b for r in rows) and max(r.n for r in rows) <= 1.1 * min(r.n for r in rows)


def test_sharding_splits_groups_of_many_rows_and_few_bytes(spark):
    rows = []
    for i in range(6000):
        if i % 3 == 0:
            rows.append((None, None))  # by the key alone these would stay together
        else:
            rows.append((i, f"text {i // 30 * 30 if i % 30 < 3 else i} " + "some words " * (400 + i // 30 * 30 % 90)))
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    load = [[r for r in found if r["shard"] == s] for s in range(8)]
    for size in (len, lambda x: sum(r["size"] for r in x), lambda x: sum(r["doc_id"] is None for r in x)):
        assert max(map(size, load)) <= 1.1 * min(map(size, load))
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in load)
    at = {r["doc_id"]: r["shard"] for r in found}
    assert all(at[i + 1] == at[i + 2] for i in range(0, 6000, 30))  # a pair is no hot group


def test_token_files(spark, texts):
    library = Tokenizer.from_file(tokens.TOKENIZER)
    manifest = token_files.write_token_files(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"), scratch_path(spark, "t"), sequence=64, batch=16, file_docs=60
    )
    assert 4 <= manifest.count() <= 5 and max(r.n_docs for r in manifest.collect()) <= 60
    at = 0
    for r in token_files.read_token_files(manifest).orderBy("doc_id").collect():
        ids = np.array([*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    first = manifest.orderBy("file").first()
    with pa.memory_map(first.sequences.removeprefix("file:")) as source:
        reader = token_files.SequenceReader(source)
        ids, mask = reader.sequence_at(first.n_tokens // 64)
        assert len(ids) == 64 and mask.sum() == first.n_tokens % 64


@pytest.mark.parametrize("name", CHAINS)
def test_token_files_of_odd_keys(spark, name):
    held, given = 20, CHAINS[name]
    library = Tokenizer.from_file(tokens.TOKENIZER)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    manifest = token_files.write_token_files(docs, scratch_path(spark, "t"), sequence=16, batch=4, file_docs=held)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == len(given) and max(sizes) <= 3 * held
    by_text = {(i, t or ""): np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in given}
    sums = {k: (len(ids), zlib.crc32(ids)) for k, ids in by_text.items()}
    rows = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == collections.Counter(
        (i, *sums[i, t or ""]) for i, t in given
    )
    assert [r.start for r in rows] == [0, *itertools.accumulate(r.n_tokens for r in rows)][:-1]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert order == sorted(order)
    again = token_files.write_token_files(docs.repartition(3), scratch_path(spark, "t"), sequence=16, batch=4, file_docs=held + 7)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, token_files.read_token_files(again).collect()), key=str)


def test_quality(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = queries.op10_bradley_terry_quality(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.97 * len(held)


def test_slope_is_that_of_the_loss():
    draw = np.random.default_rng(1)
    weights, better, worse = draw.standard_normal(7), draw.standard_normal((40, 7)), draw.standard_normal((40, 7))
    loss = lambda w: np.log1p(np.exp(-(better - worse) @ w)).mean() + quality.DECAY / 2 * w @ w
    steps = np.eye(7) * 1e-6
    want = [(loss(weights + e) - loss(weights - e)) / 2e-6 for e in steps]
    assert np.allclose(quality.slope(weights, better, worse), want, atol=1e-7)


def test_threshold_is_the_quantile_over_all_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    again = docs.withColumns({c: F.lit(c) for c in CLASHES}).unionByName(docs.limit(30).withColumns({c: F.lit(c) for c in CLASHES}))
    model = quality.train(again, labels.unionByName(labels.limit(9)), sample=60)
    marked = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    raw = sorted((float(quality.features(r.text) @ model.weights), marked[r.doc_id]) for r in again.collect() if r.doc_id in marked)
    below = sum(x < model.threshold for x, _ in raw)
    assert len(raw) > 200 and abs(below - sum(q == 0 for _, q in raw)) <= 1
    assert math.isclose(model.scale, float(np.std([x for x, _ in raw])) / 4, rel_tol=1e-6)


def test_shapes_are_those_of_whole_tokens():
    assert quality.shape("ab1-" * 9 + "X") == "a0-" * 9 + "A" != quality.shape("ab1-" * 9 + "x")


def test_quality_of_odd_rows_by_a_trained_model(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.train(docs, labels)
    assert model.weights.any()
    got = collections.Counter((r.doc_id, round(r.score, 9), r.predicted) for r in quality.score(odd, model).collect())
    want = collections.Counter()
    for id_, text, _ in ODD:
        p = float(model.scores(quality.features(text)[None])[0])
        want[id_, round(p, 9), int(p >= 0.5)] += 1
    assert got == want and quality.score(odd.where("false"), model).count() == 0
    assert quality.train(odd, labels.where("false")).scores(np.zeros((1, len(model.weights))))[0] == 0.5


def test_one_class_gives_the_same_score_to_all(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score(odd, quality.train(odd, labels)).collect()
    assert len(scored) == len(ODD) and {r.score for r in scored} == {0.5}


EACH = {
    "pii": lambda d: pii.redact(d),
    "suffix_tree": lambda d: suffix_tree.scores(d),
    "simhash": lambda d: simhash.near_duplicates(d),
    "weighted_sampling": lambda d: weighted_sampling.fingerprint_edits(d),
    "mixing": lambda d: mixing.mix(d),
    "sharding": lambda d: sharding.shard(d),
    "packing": lambda d: packing.pack(d),
    "token_files": lambda d: token_files.read_token_files(token_files.write_token_files(d, token_files.token_folder(d.sparkSession))),
}


@pytest.mark.parametrize("name", EACH)
def test_odd_rows_and_empty_tables(odd, name):
    rows = EACH[name](odd).collect()
    ids = collections.Counter(r["doc_id"] for r in rows)
    want = collections.Counter(i for i, _, _ in ODD)
    if name == "packing":  # the long text has several pieces
        assert ids.keys() == want.keys() and ids[5] > 1 and ids[None] == 2 and ids[1] == 2
    else:
        assert ids == want
    assert EACH[name](odd.where("false")).count() == 0


def test_odd_rows_through_the_stages(spark, odd):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(1, ODD[0][1]), (2, ""), (0, "no id at all"), (5, LONG), (6, "word"), (7, "same text twice over"), (9, ODD[-1][1])]
    )
    mixed = corpus_pipeline.mix(spark, odd, SF_DIR)
    assert mixed.columns == odd.columns and mixed.count() >= 1
    assert corpus_pipeline.classify(spark, odd.where("false"), SF_DIR).count() == 0


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id for r in corpus_pipeline.classify(spark, docs, SF_DIR).collect()}
    assert rows and {r.doc_id for r in rows} <= good
    whole = collections.defaultdict(list)
    for r in rows:
        whole[r.sequence_id].append((r.offset, r.length))
    for parts in whole.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_pipeline_of_odd_and_no_rows(spark, odd, tmp_path):
    """Labels for all ids and enough plain documents to learn from: each stage's decisions show in the result."""
    plain = odd.limit(1).drop("doc_id", "text", "source").crossJoin(
        spark.range(100, 160).select(
            F.col("id").alias("doc_id"), F.lit("x").alias("source"),
            F.when(F.col("id") % 2 == 0, F.concat(F.lit("the cat of house "), "id", F.lit(" sat and it was good that day.")))
            .otherwise(F.concat(F.lit("$$$ ### "), F.col("id") * 7919, F.lit(" !!! >>> <<< @@@"))).alias("text"),
        )
    )
    docs = odd.unionByName(plain)
    labels = docs.where("doc_id >= 100").select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    for name, rows in (("some", docs), ("none", docs.where("false"))):
        rows.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.where(F.lit(name == "some")).write.parquet(str(tmp_path / name / "labels.parquet"))
    kept = corpus_pipeline.classify(spark, spark.read.parquet(str(tmp_path / "some" / "documents.parquet")), str(tmp_path / "some"))
    assert kept.columns == docs.columns
    good = {r.doc_id for r in kept.collect()}
    assert {i for i in good if i and i >= 100} <= set(range(100, 160, 2)) and len(good) > 10
    out = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    assert out and {r.doc_id for r in out} <= good
    places = collections.defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_pii_of_a_text_with_many_spans(spark):
    line = "é a.b@c.org 10.0.0.1 +1 (555) 123-4567 James Smith 😀 "
    rows = [(1, line * 1500, 0), (2, "x" * 1022 + " " + line * 40, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    model = pii.Model({}, (9.0,) + (0.0,) * 13)  # takes all
    found = pii.find(docs, model)
    for r in found.select("row.*", pii.listed("base").alias("base"), pii.listed("spans").alias("spans")).collect():
        assert r.base == base_spans(r.text)
        names = [f"name:{m.start()}:{m.end()}" for m in re.finditer("James Smith", r.text)]
        assert set(r.spans.split(",")) == {*r.base.split(","), *names}
    want = {i: re.sub(r"a\.b@c\.org", "[EMAIL]", t).replace("10.0.0.1", "[IP]").replace("+1 (555) 123-4567", "[PHONE]").replace("James Smith", "[NAME]") for i, t, _ in rows}
    assert {r["row"]["doc_id"]: r["changed"] for r in pii.redacted(found, "changed").collect()} == want


def test_words_are_encoded_once_whatever_stands_around_them(texts):
    library, own = Tokenizer.from_file(tokens.TOKENIZER), tokens.Encoder(tokens.TOKENIZER)
    direct, given = own._direct, []
    own._direct = lambda some: given.extend(some) or direct(some)
    around = ["so wordé### and", "so wordé%%% and,", "so wordé... and\nso", "so wordé\nand wordé$$$ and", "so (wordé) 日本 and"]
    odd = ["  so", "so  \nand", "\n\n \nso", "so\n and \n\n  so ", "x\x1cy so's we'll-x.'", " ", "", "ꟁꟂ ȹǀ ⅷ so", "\n so"]
    for every in (around, odd + around, list(texts.values())):
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in every]
        given.clear()
        assert own.encode(every) == want
        assert every is not around or not any("wordé" in x and "(" not in x for x in given)
        assert own.encode(every) == want
    assert not any(x.isspace() or not x for x in own.after)


def test_frequent_probabilities_travel_as_their_rank():
    random = np.random.default_rng(3)
    values = random.choice(random.integers(0, 1 << 20, 300).astype("u4"), 20_000, p=np.arange(1, 301) / 45_150)
    packed = suffix_tree._packed_ranked(values)
    assert np.array_equal(suffix_tree._unpacked_ranked(packed, "u4"), values)
    assert len(packed) < 0.7 * len(suffix_tree._packed(values))
    assert len(suffix_tree._unpacked_ranked(suffix_tree._packed_ranked(values[:0]), "u4")) == 0


def test_what_met_in_a_block_goes_out_as_a_row_a_home():
    random = np.random.default_rng(4)
    nodes = np.sort(random.integers(-500, 500, 9000))
    ids, scores = random.integers(0, 1 << 40, 9000), random.random(9000)
    rows = nn_descent._by_home(nodes, ids, scores, (nodes % 7).astype("i4"))
    assert rows["home"].tolist() == [*range(7)]
    assert all(set(np.frombuffer(x, "i8") % 7) == {home} for home, x in zip(rows["home"], rows["nodes"], strict=True))
    assert set(zip(*nn_descent._unpacked(rows), strict=True)) == set(zip(nodes, ids, scores, strict=True))
    assert not len(nn_descent._by_home(nodes[:0], ids[:0], scores[:0], nodes[:0].astype("i4")))


def test_pairs_are_ordered_with_and_without_room_for_their_place():
    random = np.random.default_rng(6)
    for most in (20, 1 << 40):
        high, low = (random.choice(random.integers(0, most, 30), 3000) for _ in range(2))
        pairs = sorted(set(zip(high.tolist(), low.tolist(), strict=True)))
        order = suffix_tree._order(high, low)
        assert order.tolist() == sorted(range(3000), key=lambda i: (high[i], low[i], i))
        first, second, which = suffix_tree._distinct(high, low)
        assert list(zip(first.tolist(), second.tolist(), strict=True)) == pairs
        assert (first[which] == high).all() and (second[which] == low).all()
    assert [len(x) for x in suffix_tree._distinct(high[:0], low[:0])] == [0, 0, 0]


def test_contexts_and_probabilities_take_as_much_in_many_buckets_as_in_few():
    """Gaps between the contexts of a bucket do not grow with the number of buckets, and no two have the same number."""
    ids = np.unique(np.random.default_rng(7).integers(1, 1 << 20, 200_000))
    taken = []
    for bits in (0, 4, 8):
        buckets = suffix_tree._bucket(ids, bits)
        told = [np.sort(ids[buckets == b] >> bits) for b in range(1 << bits)]
        assert all((np.diff(t) > 0).all() for t in told)
        assert max(map(len, told)) < 2 * min(map(len, told))
        taken.append(sum(len(suffix_tree._packed_rising(t)) for t in told))
    assert max(taken) < 1.4 * min(taken)
    words = np.random.default_rng(8).integers(1, 5000, 20_000).astype("u4")
    p = suffix_tree._short(1 / (1 + (words.astype("i8") - 1 >> 3) // 4.0))
    packed = suffix_tree._packed_by_word(p, words, 3)
    assert np.array_equal(suffix_tree._unpacked_by_word(packed, "u4", words, 3), p)
    assert len(packed) < 0.2 * len(suffix_tree._packed_ranked(p))


def test_longer_runs_are_told_by_ranks_within_their_context():
    """A block's walk: words have large numbers, the last words of runs after two words have ranks below 3."""
    block = suffix_tree._Block()
    for i in range(40):
        block.add(i, f"the  cat sat\n{'on' if i % 2 else 'by'} a MAT " + " ".join(f"w{i}x{j} w{i}x{j}" for j in range(50)), False)
    row = next(block.frame(0).itertuples(index=False))
    words, counts = suffix_tree._unpacked_rising(row.words, "u8"), suffix_tree._unpacked(row.counts, "u4").astype("i8")
    assert counts.sum() == row.train_tokens == 40 * (6 + 100 + 1) and len(words) == 40 * 50 + 7 + 1
    numbers = np.where(counts >= 2, np.argsort(np.argsort(-counts, kind="stable")) + 1, 0)
    replies = pd.DataFrame({"bucket": [0], "first": [suffix_tree._packed(counts)], "second": [suffix_tree._packed(numbers)]})
    walk = suffix_tree._Walk(row, replies, row.train_tokens, len(words), 6.0, 0, 0)
    assert walk.name.max() > 1000
    walk.ask()
    totals = np.bincount(walk.run, minlength=len(walk.last)).astype("i8")
    some = totals >= 2
    starts = np.searchsorted(walk.follows[some], np.arange(len(walk.context_id)))
    sizes = suffix_tree._sizes(walk.follows[some])
    ranks = (np.arange(some.sum()) - starts[walk.follows[some]]).astype("u4")
    reply = [
        suffix_tree._packed(np.ones(len(walk.context_id), "i8")), suffix_tree._packed(totals * some),
        suffix_tree._packed_within(ranks, sizes), suffix_tree._packed_rising(starts[np.unique(walk.follows[some])]),
    ]
    walk.take(pd.DataFrame([(0, *reply)], columns=["bucket", "first", "second", "third", "fourth"]))
    assert walk.id[some].tolist() == [*range(1, some.sum() + 1)] and not walk.id[~some].any()
    walk.ask()
    assert len(walk.last) and walk.last.max() < 3


def test_low_bits_of_probabilities_travel_as_they_are():
    p = suffix_tree._short(10.0 ** np.random.default_rng(9).uniform(-6, 0, 3000))
    packed = suffix_tree._packed_split(p)
    assert np.array_equal(suffix_tree._unpacked_split(packed), p)
    assert len(packed) < len(suffix_tree._packed(p))
    for few in (p[:0], p[:1], np.array([0, (1 << 32) - 1], "u4")):
        assert np.array_equal(suffix_tree._unpacked_split(suffix_tree._packed_split(few)), few)


@pytest.mark.parametrize("spread", [9, 2**40, 2**63 - 1])
def test_the_best_of_each_node_are_those_of_a_plain_sort(spread):
    """Near and far ids, repeated pairs, equal scores; ranks are used where ids are far apart."""
    rng = np.random.default_rng(3)
    known = np.append(rng.integers(-spread, spread, 12), [spread, -spread])
    nodes, ids, scores = rng.choice(known, 3000), rng.choice(known, 3000), rng.integers(-5, 6, 3000) / 7
    highest = {}
    for node, i, score in zip(nodes.tolist(), ids.tolist(), scores.tolist()):
        highest[node, i] = max(score, highest.get((node, i), -math.inf))
    want = []
    for node in sorted(set(nodes.tolist())):
        each = sorted((-s, i) for (at, i), s in highest.items() if at == node)
        want += [(node, i, -s) for s, i in each[:4]]
    assert [*zip(*(c.tolist() for c in nn_descent._best(nodes, ids, scores, 4)))] == want
    places, n = nn_descent._places(known)
    assert n <= max(2 * spread + 1, 14) and n < 1 << 31 and np.array_equal(np.argsort(places), np.argsort(known))
    assert [len(c) for c in nn_descent._best(nodes[:0], ids[:0], scores[:0], 4)] == [0, 0, 0]
