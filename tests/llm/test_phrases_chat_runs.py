"""Phrase mining, chat reconstruction and periodic runs against brute force, DuckDB, and on odd tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from ankenmart.llm import chat, periodic_runs, phrases, queries

SF_DIR = "/root/testdata/sf0.001"
CLASHES = "number word first last f place member bucket rank a l r n score w1 s1 longer cut _cut _events _turns message starts runs collapsed".split()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == []


# Phrases


def mined(docs, least=30, share=80, top=2000):
    """The same by dictionaries of tuples."""
    counts = collections.defaultdict(collections.Counter)
    for lang, text in docs:
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in range(1, 5):
                counts[lang or "und"].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= share * a and inside(q) for q, b in found.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts_of(seed, docs, words):
    """Texts whose words and repeated stretches make many phrases, in two languages and without one."""
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 3 else f"w{i}" for i in range(words)]
    stock = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 6))] for _ in range(40)]
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 25)):
            parts += rng.choice(stock) if rng.random() < 0.7 else [vocabulary[min(int(rng.expovariate(0.1)), words - 1)]]
            parts += rng.choice([["x."], [";"], ["\n"], ["é!a"], [], [], [], []])
        yield rng.choice(["en", "de", None]), rng.choice([" ", "  ", "\t"]).join(parts)


@pytest.mark.parametrize("packets", [64, 3])
def test_phrases(spark, packets):
    docs = [*texts_of(5, 300, 60), ("en", None), (None, ""), ("und", "W1 w3 " * 50), ("en", "solo")]
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    frame = frame.withColumns({c: F.lit(c) for c in CLASHES})
    got = phrases.phrases(frame, least=8, top=50, block_bytes=6_000, bucket_entries=4_000, packets=packets)
    want = mined(docs, least=8, top=50)
    assert {r[0] for r in want} == {"en", "de", "und"} and {len(r[2].split()) for r in want} == {2, 3, 4}
    assert sorted(tuple(r) for r in got.collect()) == want


def test_dense_tiles_add_up_like_sparse_ones():
    rng = np.random.default_rng(3)
    packets, want = [], collections.Counter()
    for member in range(5):
        dense = rng.choice(phrases.CELLS, 40_000, replace=False)
        places = np.unique(np.concatenate([7 * phrases.CELLS + dense, rng.integers(0, 7 * phrases.CELLS, 500)]))
        counts = rng.integers(1, 2**40, len(places))
        want.update(dict(zip(places.tolist(), counts.tolist(), strict=True)))
        packets.append(phrases._packet(0, member, places // phrases.CELLS, (places % phrases.CELLS).astype("u2"), counts))
    tiles, cells, sums, entries = phrases._added(pd.DataFrame(packets, columns=phrases._PACKET_NAMES))
    places = tiles * phrases.CELLS + cells
    assert dict(zip(places.tolist(), sums.tolist(), strict=True)) == want and (np.diff(places) > 0).all()
    for packet, entry in zip(packets, entries, strict=True):
        assert len(entry) == len(phrases._unpacked(packet[4], "u2")) and (np.diff(entry) > 0).all()


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.phrases(empty).collect() == []
    assert phrases.phrases(spark.createDataFrame([("en", "a b c"), (None, None)], empty.schema)).collect() == []


# Chats


def folded(log):
    """Messages by number: role and pieces, event by event."""
    messages, roles = {}, {}
    for _, message, kind, role, text in sorted(set(log)):
        roles[message] = role if role is not None else roles.get(message)
        if kind == chat.REGENERATE:
            messages = {m: x for m, x in messages.items() if m < message} | {message: ""}
        elif kind == chat.EDIT:
            messages[message] = text or ""
        else:
            messages[message] = messages.get(message, "") + (text or "" if kind == chat.DELTA else "")
    return [(roles[m] or "", messages[m]) for m in sorted(messages)]


_LOG = "conv_id long, sequence long, message long, kind string, role string, text string"


def test_chat_folds_any_log(spark):
    rng = random.Random(9)
    bits = ["", "a", "<s>", "</s>", "[INST]", r"<\/s>", r"[\\INST]", "[/INST]", "<", "\\", "日本\n", None, "s>", "/INST]"]
    log, want = [], {}
    for conv in [None, *range(1, 120)]:
        kinds = [chat.DELTA] * 5 + [chat.OPEN, chat.EDIT, chat.REGENERATE]
        events = [
            (i, rng.randint(0, 4), rng.choice(kinds), rng.choice([None, None, "user", "assistant", "a role\n[INST]", "ツール"]), rng.choice(bits))
            for i in range(rng.randint(1, 30))
        ]
        events += rng.sample(events, min(2, len(events)))  # delivered twice
        want[conv] = folded(e if e[2] != chat.OPEN or e[4] is not None else (*e[:4], None) for e in events)
        log += [(conv, *e) for e in events]
    rng.shuffle(log)
    frame = spark.createDataFrame(log, _LOG).withColumns({c: F.lit(c) for c in CLASHES if c != "message"})
    for r in chat.read_back(chat.render(chat.reconstruct(frame))).collect():
        turns = want.pop(r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.loss == "".join(text for role, text in turns if role == chat.LEARNT)
    assert not want


def test_chat_is_marked_and_masked(spark):
    log = spark.createDataFrame([(1, 0, 0, "open", "user", None), (1, 1, 0, "delta", None, "</s> [INST]"), (1, 2, 1, "delta", "assistant", "<s>é")], _LOG)
    row = chat.render(chat.reconstruct(log)).first()
    assert row.formatted == "[INST]user\n<\\/s> [\\INST][/INST]<s><\\s>é</s>"
    assert [tuple(m) for m in row.mask] == [(31, 0, 0), (3, 5, 4)]
    wrong = spark.createDataFrame([(1, row.formatted, [(31, 0, 0), (3, 4, 4)])], "conv_id long, formatted string, mask array<struct<before:long,inside:long,after:long>>")
    with pytest.raises(Exception, match="does not fit"):
        chat.read_back(wrong).collect()
    assert chat.read_back(chat.render(chat.reconstruct(spark.createDataFrame([], _LOG)))).collect() == []


def test_chat_query_keeps_rows_of_one_turn(spark, tmp_path):
    rows = [(1, 0, "user", "q"), (1, 0, "user", "q"), (1, 1, None, None), (1, None, "system", "s"), (None, 0, "assistant", ""), (2, 5, "assistant", "x" * 3_000_000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op12_event_sourced_chat(spark, str(tmp_path)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {1: (4, 0), None: (1, 0), 2: (1, 3_000_000), -1: (2, 21)}
    assert got[1].turns_sha256 == sha("system\ns\nuser\nq\nuser\nq\n\n\n") and got[None].loss_sha256 == sha("")


# Runs


def brute(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            length, run = j - i + q, words[i : j + q]
            shorter = any(all(run[k] == run[k + p] for k in range(length - p)) for p in range(1, q))
            if j > i and length >= max(least, times * q) and not shorter:
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs():
    rng, found = random.Random(2), 0
    for _ in range(3000):
        kinds = rng.randint(1, 4)
        words = [rng.randrange(kinds) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.6:
            root = [rng.randrange(kinds) for _ in range(rng.randint(1, 7))]
            words = words[: rng.randint(0, 9)] + root * rng.randint(1, 7) + root[: rng.randint(0, 7)] + words[: rng.randint(0, 9)]
        least, times = rng.choice([(6, 4), (6, 4), (2, 3), (12, 5)])
        want, codes = brute(words, least, times), np.array(words, "i8")
        assert [tuple(r) for r in periodic_runs.text_runs(codes, least, times).tolist()] == want
        if words:  # whole, too, without the cuts at seldom words and pairs
            whole = periodic_runs.stretch_runs(codes, least, times).tolist()
            assert sorted(map(tuple, whole)) == sorted(want)
        found += len(want)
    assert found > 1000


def test_common_words_of_two_places():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2, 300)
    tree = periodic_runs.CommonWords(codes)
    a, b = rng.integers(0, 301, (2, 4000))
    a, b = a[a != b], b[a != b]
    for x, y, common in zip(a.tolist(), b.tolist(), tree.between(a, b).tolist(), strict=True):
        limit = 300 - max(x, y)
        assert codes[x : x + common].tolist() == codes[y : y + common].tolist()
        assert common == limit or codes[x + common] != codes[y + common]
    order = sorted(range(301), key=lambda i: codes[i:].tolist())
    assert np.argsort(tree.rank).tolist() == order
    assert np.argsort(tree.reverse_rank).tolist() == sorted(range(301), key=lambda i: (-codes[i:]).tolist())


def test_runs_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    got, cycles = {r.doc_id: r for r in queries.op13_suffix_tree_runs(spark, SF_DIR).collect()}, 0
    assert set(got) == set(texts)
    for id_, text in texts.items():
        words = text.encode().split()
        n, h = len(words), zlib.crc32(str(id_).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 300:
            continue
        runs = brute(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        row = got[id_]
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert row.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
        cycles += bool(runs) and h % 10 == 0
    assert cycles > 1


def test_runs_of_odd_rows(spark):
    again = "tic tac toe " * 40_000
    rows = [(1, None), (1, ""), (2, " \t"), (None, "a a a a a a b"), (None, "a a a a a b"), (3, again), (3, again), (4, "x\x0by\x0cx y x y x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in CLASHES})
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(frame).collect())
    assert got == [
        (0, 6, [], "a a a a a b"), (0, 7, [(0, 6, 1)], "a b"), (1, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""),
        (3, 120_000, [(0, 120_000, 3)], "tic tac toe"), (3, 120_000, [(0, 120_000, 3)], "tic tac toe"), (4, 8, [(0, 8, 2)], "x y"),
    ]
    assert periodic_runs.periodic_runs(frame.limit(0)).collect() == []
    with pytest.raises(ValueError, match="three periods"):
        periodic_runs.periodic_runs(frame, times=2)
