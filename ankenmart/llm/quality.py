"""Quality classifier by Bradley-Terry ranking: pairs of a better and a worse document, logistic loss on
the difference of their features, a threshold at a quantile of the scores.

The weights are fitted on a bounded sample of the labelled documents, the one bounded step. The threshold comes
from the scores of all labelled documents that may be learnt from.

Cases: a null text is empty and is scored like any other; labels that are null or other than 0 and 1 are
not learnt from, repeated ones count as 1 if any says so; without both labels every score is 0.5; an empty
table gives no rows; labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ankenmart.llm.common import id_crc32, saved, slices, text_of

SAMPLE = 6_000
SHAPES, WORDS, STATISTICS = 256, 1024, 8
STEPS, PAIRS, RATE, DECAY = 600, 512, 0.05, 1e-4
REMEMBERED = 200_000
#: Bits of the map of labelled ids, and ranks the quantile tells apart.
BITS, ACCURACY = 1 << 20, 100_000

_UPPER, _LOWER, _DIGIT = re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"[0-9]+")
_known: dict[str, int] = {}


def shape(token: str) -> str:
    """Runs of capitals, small letters and digits as one A, a and 0; other signs as they are."""
    return _DIGIT.sub("0", _UPPER.sub("A", _LOWER.sub("a", token)))


def _places(token: str) -> int:
    """The token's places among shapes and words, in one number."""
    word = re.sub(r"\W+", "", token).lower()
    return zlib.crc32(shape(token).encode("utf-8", "replace")) % SHAPES * WORDS + zlib.crc32(word.encode("utf-8", "replace")) % WORDS


def features(text: str | None) -> np.ndarray:
    """Roots of the shares of token shapes and words (both hashed), and a few statistics."""
    text = text or ""
    tokens = text.split()
    if len(_known) > REMEMBERED:
        _known.clear()
    distinct = set(tokens)
    for token in distinct:
        if token not in _known:
            _known[token] = _places(token)
    places = np.fromiter(map(_known.__getitem__, tokens), "int64", len(tokens))
    out = np.zeros(SHAPES + WORDS + STATISTICS)
    n, chars = max(len(tokens), 1), max(len(text), 1)
    out[:SHAPES] = np.sqrt(np.bincount(places // WORDS, minlength=SHAPES) / n)
    out[SHAPES : SHAPES + WORDS] = np.sqrt(np.bincount(places % WORDS, minlength=WORDS) / n)
    lines = text.split("\n")
    raw = np.frombuffer(text.encode("utf-8", "replace"), "u1")
    kinds = np.bincount(raw, minlength=256)
    repeated = np.count_nonzero(places[1:] == places[:-1]) + np.count_nonzero(places[2:] == places[:-2])
    out[SHAPES + WORDS :] = (
        np.log1p(len(tokens)) / 10,
        len(text) / n / 10,
        (kinds[33:48].sum() + kinds[58:65].sum()) / chars,
        kinds[65:91].sum() / chars,
        len(distinct) / n,
        len(set(lines)) / len(lines),
        kinds[48:58].sum() / chars,
        repeated / n,
    )
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    threshold: float
    scale: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((rows @ self.weights - self.threshold) / self.scale, -700, 700)))


def slope(weights: np.ndarray, better: np.ndarray, worse: np.ndarray) -> np.ndarray:
    """Of the mean logistic loss of the pairs' differences, with the decay of the weights."""
    gap = better - worse
    wrong = 1 / (1 + np.exp(np.clip(gap @ weights, -700, 700)))
    return DECAY * weights - wrong @ gap / len(gap)


def fit(rows: np.ndarray, good: np.ndarray, steps: int = STEPS, pairs: int = PAIRS) -> Model:
    """Weights from pairs drawn anew at each step; the threshold leaves the share of good ones above."""
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    weights = np.zeros(SHAPES + WORDS + STATISTICS)
    if not len(better) or not len(worse):
        return Model(weights, 0.0, 1.0)
    draw, squares = np.random.default_rng(10), np.full(len(weights), 1e-6)
    for _ in range(steps):
        step = slope(weights, rows[draw.choice(better, pairs)], rows[draw.choice(worse, pairs)])
        squares += step**2
        weights -= RATE * step / np.sqrt(squares)
    scores = rows @ weights
    threshold = float(np.quantile(scores, len(worse) / len(rows), method="midpoint"))
    return Model(weights, threshold, float(scores.std()) / 4 or 1.0)


def _marked(labels: DataFrame) -> DataFrame:
    """label_id and quality of the labelled ids that may be learnt from: crc32(id) mod 3 is not 1."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (id_crc32() % 3 != 1))
    return usable.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("quality"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Learn weights from at most ``sample`` labelled documents, those of the smallest hash of the id, and the
    threshold from all of them."""
    marked = _marked(labels)
    first = marked.orderBy(F.xxhash64("label_id", F.lit(3)), "label_id").limit(sample)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 500):
            x = [features(t).astype("float32").tobytes() for t in frame["text"]]
            yield pd.DataFrame({"quality": frame["quality"], "order": frame["order"], "x": x})

    chosen = (
        docs.select(F.col(key).alias("id"), text_of(text).alias("text"))
        .join(F.broadcast(first), F.col("id") == F.col("label_id"))
        .select("quality", F.xxhash64("id", "text").alias("order"), "text")
    )
    # Repeated rows of one id would exceed the sample: the limit holds for rows too.
    found = chosen.mapInPandas(run, "quality int, order long, x binary").orderBy("order").limit(sample).collect()
    rows = np.array([np.frombuffer(r["x"], "<f4") for r in found], "float64").reshape(len(found), SHAPES + WORDS + STATISTICS)
    model = fit(rows, np.array([r["quality"] == 1 for r in found], bool))
    return _at_quantile(docs, marked, model, key, text) if model.weights.any() else model


def _at_quantile(docs: DataFrame, marked: DataFrame, model: Model, key: str, text: str) -> Model:
    """The model with the threshold that leaves the share of good ones among all marked documents above it.

    A bitmap of hashed ids, whatever their number of one size, spares the features of most other documents; the
    join that decides has ids and scores only.
    """
    place = lambda id_: F.pmod(F.xxhash64(F.col(id_).cast("long")), F.lit(BITS))
    at = marked.select((place("label_id") + 1).alias("at"))  # bitmaps count from 1
    blocks = at.groupBy(F.bitmap_bucket_number("at").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    marks = np.zeros(BITS, bool)
    for row in blocks.collect():  # BITS / 32768 rows at most
        bits = np.unpackbits(np.frombuffer(row["bits"], "u1"), bitorder="little")
        marks[(row["block"] - 1) * len(bits) : row["block"] * len(bits)] = bits

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 500):
            some = frame[marks[frame["at"].to_numpy("i8")]]
            if len(some):
                yield pd.DataFrame({"id": some["id"], "raw": np.array([features(t) for t in some["text"]]) @ model.weights})

    given = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), place(key).alias("at"), text_of(text).alias("text"))
    raw = given.mapInPandas(run, "id long, raw double")
    raw = saved(raw.join(marked, F.col("id") == F.col("label_id")).select("raw", "quality"), "label-scores")
    total = raw.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good"), F.stddev_pop("raw").alias("spread")).first()
    if not total["n"]:
        return model
    # Bounded memory: the rank is right to one in ACCURACY. Between the value there and the next one.
    below = raw.agg(F.percentile_approx("raw", 1 - total["good"] / total["n"], ACCURACY)).first()[0]
    above = raw.where(F.col("raw") > below).agg(F.min("raw")).first()[0]
    return Model(model.weights, below if above is None else (below + above) / 2, float(total["spread"]) / 4 or 1.0)


def _scored(docs: DataFrame, model: Model, keep: tuple[str, ...], text: str) -> DataFrame:
    """The kept columns as kept_0, kept_1 and so on, ``score`` and ``predicted``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, 500):
            p = model.scores(np.array([features(t) for t in frame["scored_text"]]))
            yield frame.drop(columns="scored_text").assign(score=p, predicted=(p >= 0.5).astype("int32"))

    rows = docs.select(*(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)), text_of(text).alias("scored_text"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "scored_text"]
    return rows.mapInPandas(run, ", ".join([*fields, "score double, predicted int"]))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, ``score`` from 0 to 1 and ``predicted`` (1 from 0.5 on)."""
    return _scored(docs, model, keep, text).withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents predicted good, as they are."""
    rows = _scored(docs, model, tuple(docs.columns), text).where("predicted = 1")
    return rows.select(*(F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)))
