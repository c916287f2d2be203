"""Personal data by weak supervision, in DataFrame operations only.

Regular expressions propose spans. Labelers vote for or against each: the strict format, a checksum or
value range, a gazetteer, the words before it, its borders. Expectation-maximisation estimates how reliable
each labeler is, and a logistic span classifier is trained on the resulting probabilities. Spans of the
base rules are always kept; the classifier adds others that overlap none of them.

All documents are counted: fitting needs only how often each pattern of kind and votes occurs, and there
are at most ``len(KINDS) * 3 ** len(LABELERS)`` patterns, whatever the size of the corpus.

Cases: a null text is empty; equal starts are ordered by kind; repeated rows give repeated results; an
empty table gives no rows; without any proposal nothing is added; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ankenmart.llm.common import text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "national_id", "local_phone", "iban", "name")
LABELERS = ("format", "value", "gazetteer", "context", "border")
EM_STEPS, DESCENT_STEPS, ACCEPT = 50, 400, 0.5

# Titles and given names, mail domains' ends, calling codes, card prefixes, context words.
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame"
GIVEN_NAMES = (
    "James|John|Robert|Michael|William|David|Mary|Patricia|Jennifer|Linda|Elizabeth|Susan|Hans|Peter|Klaus|"
    "Anna|Ursula|Sabine|Jean|Pierre|Michel|Marie|Nathalie|Isabelle|José|Antonio|Manuel|María|Carmen|Lucía"
)
TOP_DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|ch|at|it|jp"
CALLING_CODES = "1|7|20|27|30|31|32|33|34|36|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CARD_PREFIXES = "4|5[1-5]|2[2-7]|3[47]|6011|65"
CONTEXT = {
    "email": "mail|contact|write|correo|courriel",
    "ip": r"\bip\b|host|server|address|login|from",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|fax|mobile|teléfono|téléphone",
    "national_id": "ssn|social security|passport|national id|ausweis",
    "local_phone": "phone|call|tel|fax|mobile|teléfono|téléphone",
    "iban": "iban|account|konto|compte|cuenta",
    "name": "name|signed|dear|regards|sincerely|call|contact",
}
AGAINST = "version|isbn|issn|invoice|order|page|rev\\.|build|doi"

# Linear in the text: runs are taken whole (++), and tried once from where they begin.
_MAIL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": rf"(?<!\p{{L}})(?=[A-Z])(?:(?:{TITLES})\.? |(?:{GIVEN_NAMES}) )\p{{Lu}}\p{{Ll}}+(?!\p{{L}})",
}
#: What a text must hold for the pattern to be tried at all.
GATES = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
    "national_id": r"[0-9]-[0-9]{2}-[0-9]", "local_phone": r"[0-9]{3}[.-][0-9]{4}", "iban": r"[A-Z]{2}[0-9]{2}",
    "name": rf"\b(?:{TITLES}|{GIVEN_NAMES})\b",
}
#: Entries of an array that are folded one after the other; folds copy what they have at each entry.
CHUNK = 128
#: Code points of the pieces in which parts of a text are looked up.
PIECE = 1024


def _folded(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The running folds of numbers, in time that grows with the square of their count."""
    empty = F.array().cast("array<int>")
    last = lambda done, x: F.when(F.size(done) == 0, x).otherwise(step(F.element_at(done, -1), x))
    return F.aggregate(values, empty, lambda done, x: F.concat(done, F.array(last(done, x))))


def chunk_folds(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running folds within chunks. They and ``whole_folds`` stand in projections of their own."""
    n = F.ceil(F.size(values) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.slice(values, (i - 1) * CHUNK + 1, F.lit(CHUNK)))
    return F.transform(chunks, lambda c: _folded(c, step))


def whole_folds(chunks: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running folds of all, from those within chunks."""
    before = F.concat(F.array(F.lit(None).cast("int")), _folded(F.transform(chunks, lambda c: F.get(c, F.size(c) - 1)), step))
    shifted = F.zip_with(chunks, F.slice(before, F.lit(1), F.size(chunks)), lambda c, b: F.transform(c, lambda x: F.when(b.isNull(), x).otherwise(step(b, x))))
    return F.flatten(shifted)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def near(pieces: str, begin: Column, length: Column) -> Column:
    """A part of a text, no longer than a piece, by its pieces: costs two pieces, wherever it is."""
    first = F.floor(begin / PIECE).cast("int")
    some = F.concat(*(F.coalesce(F.get(pieces, first + i), F.lit("")) for i in (0, 1)))
    return F.substring(some, (begin - first * PIECE + 1).cast("int"), length.cast("int"))


def part(pieces: str, begin: Column, length: Column) -> Column:
    """A part of any length."""
    first = F.floor(begin / PIECE).cast("int")
    count = F.floor((begin + length) / PIECE).cast("int") - first + 1
    some = F.array_join(F.slice(pieces, first + 1, F.greatest(count, F.lit(0))), "")
    return F.substring(some, (begin - first * PIECE + 1).cast("int"), length.cast("int"))


def matched(text: Column, pattern: str, gate: str) -> Column:
    """All leftmost matches, each after the length of the text between it and the one before; what follows the
    last has no match. NULL if there is none. Lengths add up to places in code points."""
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.char_length(gap).alias("gap"), match.alias("match")),
    )
    return F.when(text.rlike(gate), F.filter(parts, lambda p: p["match"].isNotNull()))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(2 * digit - F.when(digit > 4, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1)))
    total = F.aggregate(places, F.lit(0), lambda sum_, i: sum_ + worth(i))
    return (F.char_length(digits) > 0) & (total % 10 == 0)


def base_rule(kind: str, match: Column) -> Column:
    """Whether a match of the base pattern is a base span."""
    n = F.char_length(_digits(match))
    if kind == "ip":
        small = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{small}(?:\.{small}){{3}}$")
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True) if kind == "email" else F.lit(False)


def _vote(for_: Column, against: Column | None = None) -> Column:
    vote = F.when(for_, 1)
    return vote.otherwise(0) if against is None else vote.when(against, -1).otherwise(0)


def _votes(kind: str, match: Column, before: Column, border: Column) -> list[Column]:
    """One vote a labeler: 1 for personal data, -1 against, 0 for no opinion."""
    n = F.char_length(_digits(match))
    form = {
        "email": match.rlike(r"^[A-Za-z0-9][^@]{1,63}@[A-Za-z0-9.-]{4,}$"),
        "ip": match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"),
        "card": match.rlike(r"^[0-9]{14,19}$|^[0-9]{4}([ -][0-9]{4}){3}$"),
        "phone": match.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?[ .0-9-]+$"),
        "iban": match.rlike(r"^[A-Z]{2}[0-9]{2}"),
    }.get(kind, F.lit(True))
    value = {
        "ip": base_rule("ip", match),
        "card": base_rule("card", match),
        "phone": n.between(10, 15),
        "national_id": ~match.rlike("^(?:000|666|9)|-00-|-0000$"),
        "local_phone": n == 10,
        "iban": F.char_length(F.replace(match, F.lit(" "), F.lit(""))).between(15, 34),
    }.get(kind, F.lit(True))
    gazetteer = {
        "email": match.rlike(rf"\.(?:{TOP_DOMAINS})$"),
        "ip": ~match.rlike(r"^(?:0|127|255)\."),
        "card": match.rlike(f"^(?:{CARD_PREFIXES})"),
        "phone": match.rlike(rf"^\+(?:{CALLING_CODES})"),
        "name": match.rlike(f"^(?:{GIVEN_NAMES}) "),
    }.get(kind)
    context = _vote(before.rlike(rf"(?i)(?:{CONTEXT[kind]})"), before.rlike(f"(?i)(?:{AGAINST})"))
    return [
        _vote(form, ~form),
        _vote(value, ~value),
        F.lit(0) if gazetteer is None else _vote(gazetteer, ~gazetteer),
        context,
        _vote(~border, border),
    ]


def proposals(docs: DataFrame, text: str = "text") -> DataFrame:
    """The given columns as ``row``, ``proposed``: start, kind (its number), end, base, votes of each, and
    ``pieces`` of the text where there are any."""
    body = F.col("body")
    rows = docs.select(F.struct(*docs.columns).alias("row"), text_of(text).alias("body"))
    # What later steps refer to more than once stands in a projection of its own.
    rows = rows.select("*", *(matched(body, PATTERNS[k], GATES[k]).alias(f"_{k}") for k in KINDS))
    some = reduce(lambda a, b: a | b, (F.coalesce(F.size(f"_{k}") > 0, F.lit(False)) for k in KINDS))
    lengths = lambda k: F.transform(f"_{k}", lambda p: p["gap"] + F.char_length(p["match"]))
    rows = rows.select("*", F.when(some, pieces(body)).alias("pieces"), *(lengths(k).alias(f"_length_{k}") for k in KINDS)).drop("body")
    rows = rows.select("*", *(chunk_folds(F.col(f"_length_{k}"), _sum).alias(f"_chunks_{k}") for k in KINDS))
    rows = rows.select("*", *(whole_folds(F.col(f"_chunks_{k}"), _sum).alias(f"_end_{k}") for k in KINDS))

    def judged(kind: str) -> Column:
        def judge(found: Column, end: Column) -> Column:
            match = found["match"]
            start = end - F.char_length(match)
            before = near("pieces", F.greatest(start - 40, F.lit(0)), F.least(start, F.lit(40)))
            after = near("pieces", end, F.lit(1))
            border = F.substring(before, F.lit(-1), F.lit(1)).rlike(r"[\p{L}0-9_/=]") | after.rlike(r"[\p{L}0-9_/=]")
            return F.struct(
                start.alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                end.alias("end"),
                base_rule(kind, match).alias("base"),
                F.array(*_votes(kind, match, before, border)).alias("votes"),
            )

        return F.when(F.size(f"_{kind}") > 0, F.zip_with(f"_{kind}", f"_end_{kind}", judge))

    empty = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean,votes:array<int>>>")
    every = F.concat(*(F.coalesce(judged(k), empty) for k in KINDS))
    return rows.select("row", every.alias("proposed"), "pieces")


@dataclass(frozen=True)
class Model:
    """``accuracy``: each labeler's share of right votes as EM sees it; ``weights``: bias, kinds, votes."""

    accuracy: dict[str, float]
    weights: tuple[float, ...]

    def logit(self, kind: Column, votes: Column) -> Column:
        terms = [F.when(kind == i, w).otherwise(0.0) for i, w in enumerate(self.weights[1 : 1 + len(KINDS)])]
        terms += [votes[i] * w for i, w in enumerate(self.weights[1 + len(KINDS) :])]
        return reduce(lambda a, b: a + b, terms, F.lit(self.weights[0]))


def _em(votes: np.ndarray, counts: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each pattern, and what each labeler votes (-1, 0, 1) on either class."""
    p = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    hits = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(steps):
        prior = (counts @ p + 1) / (counts.sum() + 2)
        table = []
        for belief in (1 - p, p):
            sums = np.einsum("n,nlv->lv", counts * belief, hits) + 1
            table.append(sums / sums.sum(axis=1, keepdims=True))
        log = [np.einsum("nlv,lv->n", hits, np.log(t)) for t in table]
        p = 1 / (1 + np.exp(np.clip(log[0] + np.log(1 - prior) - log[1] - np.log(prior), -500, 500)))
    return p, np.stack(table)


def _classifier(x: np.ndarray, p: np.ndarray, counts: np.ndarray, steps: int) -> np.ndarray:
    """Logistic regression on the patterns, each weighing its count."""
    weights, share = np.zeros(x.shape[1]), counts / counts.sum()
    squares = np.full(x.shape[1], 1e-8)
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
        slope = x.T @ (share * (guess - p)) + 1e-4 * weights
        squares += slope**2
        weights -= 0.2 * slope / np.sqrt(squares)
    return weights


def fit(docs: DataFrame, text: str = "text", em_steps: int = EM_STEPS, descent_steps: int = DESCENT_STEPS) -> Model:
    """Count the patterns of all proposals, then fit on the bounded table of counts."""
    # Not explode: the filter that Spark infers from it would work out all proposals a second time, from the text.
    found = proposals(docs.select(text), text).select(F.explode_outer("proposed").alias("p")).where(F.col("p").isNotNull())
    table = found.groupBy("p.kind", "p.votes").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes").collect()
    if not table:
        return Model({}, (-1.0,) + (0.0,) * (len(KINDS) + len(LABELERS)))
    votes = np.array([r["votes"] for r in table])
    counts = np.array([r["n"] for r in table], float)
    p, confusion = _em(votes, counts, em_steps)
    kinds = np.eye(len(KINDS))[[r["kind"] for r in table]]
    weights = _classifier(np.hstack([np.ones((len(table), 1)), kinds, votes]), p, counts, descent_steps)
    right = confusion[1, :, 2] * (counts @ p) + confusion[0, :, 0] * (counts @ (1 - p))
    accuracy = right / np.maximum((counts[:, None] * (votes != 0)).sum(axis=0), 1)
    return Model(dict(zip(LABELERS, accuracy.clip(0, 1).tolist(), strict=True)), tuple(weights.tolist()))


def find(docs: DataFrame, model: Model, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The given columns as ``row``, ``base`` and ``spans``: arrays of start, kind, end, ordered so."""
    least = float(np.log(accept / (1 - accept)))
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    rows = proposals(docs, text)
    base = F.transform(F.filter("proposed", lambda s: s["base"]), plain)
    added = F.filter("proposed", lambda s: ~s["base"] & (model.logit(s["kind"], s["votes"]) > least))
    rows = rows.select("row", "pieces", F.array_sort(base).alias("base"), F.transform(added, plain).alias("_added"))
    # In the order of base starts and added ends, an added span stands after all base spans that begin before its
    # end; it overlaps none of them if the furthest end of those is not beyond its start.
    event = lambda at, begins, reach, s: F.struct(at.alias("at"), F.lit(begins).alias("begins"), reach.alias("reach"), plain(s).alias("span"))
    events = F.array_sort(
        F.concat(
            F.transform("base", lambda b: event(b["start"], 1, b["end"], b)),
            F.transform("_added", lambda s: event(s["end"], 0, F.lit(0), s)),
        )
    )
    rows = rows.withColumn("_events", F.when(F.size("_added") > 0, events))
    reach = F.transform("_events", lambda e: e["reach"])
    rows = rows.withColumn("_chunks", chunk_folds(reach, lambda a, b: F.greatest(a, b)))
    rows = rows.withColumn("_reach", whole_folds(F.col("_chunks"), lambda a, b: F.greatest(a, b)))
    apart = F.filter(
        F.zip_with("_events", "_reach", lambda e, r: F.when((e["begins"] == 0) & (r <= e["span"]["start"]), e["span"])),
        lambda s: s.isNotNull(),
    )
    spans = F.array_sort(F.concat("base", apart))
    return rows.select("row", "pieces", "base", F.when(F.size("_added") > 0, spans).otherwise(F.col("base")).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(rows: DataFrame, name: str) -> DataFrame:
    """The rows of ``find`` with the text as ``name``: each span, or run of overlapping ones, replaced by its kind in
    brackets. NULL without spans."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    furthest = lambda a, b: F.greatest(a, b)
    some = F.when(F.size("spans") > 0, F.transform("spans", lambda s: s["end"]))
    rows = rows.withColumn("_chunks", chunk_folds(some, furthest))
    rows = rows.withColumn("_reach", whole_folds(F.col("_chunks"), furthest))

    def one(s: Column, reach: Column) -> Column:
        length = s["start"] - reach
        gap = F.when(length <= PIECE, near("pieces", reach, length)).otherwise(part("pieces", reach, length))
        return F.when(s["start"] >= reach, F.concat(gap, F.get(names, s["kind"]))).otherwise("")

    before = F.slice(F.concat(F.array(F.lit(0)), "_reach"), F.lit(1), F.size("spans"))
    last = F.element_at("_reach", -1)
    rest = part("pieces", last, F.size("pieces") * PIECE - last)
    whole = F.concat(F.array_join(F.zip_with("spans", before, one), ""), rest)
    return rows.withColumn(name, F.when(F.size("spans") > 0, whole)).drop("_chunks", "_reach")


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with personal data replaced, and their lengths with it."""
    found = find(docs, fit(docs, text), text)
    changed = redacted(found, "changed")
    new = {
        text: F.coalesce(F.col("changed"), F.col("row")[text]),
        n_chars: F.when(F.size("spans") > 0, F.char_length("changed")).otherwise(F.col("row")[n_chars]),
    }
    kinds = {f.name: f.dataType for f in docs.schema}
    return changed.select(*(new.get(c, F.col("row")[c]).cast(kinds[c]).alias(c) for c in docs.columns))
