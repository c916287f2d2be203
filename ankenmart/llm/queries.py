"""One registered query an operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ankenmart.llm import (
    chat,
    mixing,
    nn_descent,
    packing,
    periodic_runs,
    phrases,
    pii,
    quality,
    sharding,
    simhash,
    suffix_tree,
    token_files,
    weighted_sampling,
)
from ankenmart.llm.common import documents, id_crc32, text_of

Query = Callable[[SparkSession, str], DataFrame]


def op1_weakly_supervised_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    return found.select(
        "row.doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op3_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(documents(spark, sf_dir))


def op4_vantage_point_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op5_nn_descent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_weighted_sampling_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprint_edits(documents(spark, sf_dir))


def op7_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select(
        "doc_id", "size", "source_size", F.col("target").cast("double"), (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op8_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir))
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op9_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(documents(spark, sf_dir), token_files.token_folder(spark))
    return token_files.read_token_files(manifest)


def op10_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", (id_crc32() % 3 == 1).alias("held_out"), "score", "predicted")


def _as_log(rows: DataFrame) -> DataFrame:
    """A log that ends in the given turns. Each text is streamed in two deltas. Before, a learnt turn has a draft
    and a message after it, both gone with its regeneration; a system turn has a draft that an edit replaces."""
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text, role, at = text_of(), F.col("role"), F.col("message")
    half = F.floor(F.char_length(text) / 2).cast("int")
    first, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.char_length(text))

    def event(step: int, kind: str, text=None, role=None, message=at):
        none = F.lit(None).cast("string")
        return F.struct(
            (at * 8 + step).alias("sequence"), message.alias("message"), F.lit(kind).alias("kind"),
            (none if role is None else role).alias("role"), (none if text is None else text).alias("text"),
        )

    streamed = [event(5, chat.DELTA, first), event(6, chat.DELTA, rest)]
    learnt = [
        event(1, chat.DELTA, rest), event(2, chat.OPEN, role=F.lit("user"), message=at + 1),
        event(3, chat.DELTA, first, message=at + 1), event(4, chat.REGENERATE), *streamed,
    ]
    edited = [event(1, chat.DELTA, rest), event(2, chat.EDIT, first), event(6, chat.DELTA, rest)]
    events = F.when(role == chat.LEARNT, F.array(event(0, chat.OPEN, role=role), *learnt))
    events = events.when(role == "system", F.array(event(0, chat.OPEN, role=role), *edited))
    events = events.otherwise(F.array(event(0, chat.OPEN, role=role), *streamed))
    numbered = rows.withColumn("message", F.row_number().over(by_turn).cast("long"))
    return numbered.select("conv_id", F.inline(events))


def op11_tiled_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(documents(spark, sf_dir))


#: What both turns of conversation -1 say.
_SAID = "</s>[INST] ok [/INST]"


def op12_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise(chat.LEARNT)
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(_SAID).alias("text"))
    read = chat.read_back(chat.render(chat.reconstruct(_as_log(rows.unionByName(more)))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def _as_cycle(docs: DataFrame) -> DataFrame:
    """The documents; a tenth of them, by id, repeat a stretch of their words up to the end."""
    h = id_crc32()
    g = F.floor(h / 10)
    words = F.filter(F.split(text_of(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size("_words"), F.lit(1))
    begin = F.pmod(g, n).cast("int")
    period = (F.floor((n - begin) / (g % 8 + 3)) + 1).cast("int")
    repeats = F.ceil((n - begin) / period).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("_words", begin + 1, period), repeats))
    cycled = F.array_join(F.slice(F.concat(F.slice("_words", F.lit(1), begin), cycle), F.lit(1), n), " ")
    picked = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_words"))
    return picked.select("doc_id", F.when(F.size("_words") > 0, cycled).otherwise(F.col("text")).alias("text"))


def op13_suffix_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_as_cycle(documents(spark, sf_dir)))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    found = found.withColumn("best", best)
    start, period = -F.col("best.col2"), -F.col("best.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.floor(F.col("best.length") * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_weakly_supervised_pii,
        op2_best_fit_packing,
        op3_suffix_tree_scores,
        op4_vantage_point_simhash,
        op5_nn_descent_search,
        op6_weighted_sampling_fingerprints,
        op7_entropy_mixing,
        op8_vector_sharding,
        op9_arrow_token_files,
        op10_bradley_terry_quality,
        op11_tiled_phrases,
        op12_event_sourced_chat,
        op13_suffix_tree_runs,
    )
}

_PHRASES = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
pieces AS (SELECT doc, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM texts),
split AS (SELECT doc, lang, p, regexp_split_to_array(piece, '[\x20\x09]+') AS words FROM pieces),
every AS (SELECT doc, lang, p, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
runs AS (
  SELECT lang, word AS w1, lead(word, 1) OVER near AS w2, lead(word, 2) OVER near AS w3, lead(word, 3) OVER near AS w4
  FROM every WHERE word <> '' WINDOW near AS (PARTITION BY doc, p ORDER BY i)),
counts AS (
  SELECT lang, [w1] AS words, count(*)::HUGEINT AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT * FROM counts WHERE len(words) > 1),
cuts AS (
  SELECT c.lang, c.words, c.f AS a, k, x.f AS l, y.f AS r, 2000000 * c.f // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.words = c.words[:k]
  JOIN counts y ON y.lang = c.lang AND y.words = c.words[k + 1:]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
parts AS (
  SELECT lang, words[b:e] AS words, f FROM (
    SELECT lang, words, f, b, unnest(range(b + 1, len(words) + 1)) AS e
    FROM (SELECT *, unnest(range(1, len(words))) AS b FROM candidates))
  WHERE e - b + 1 < len(words)),
held AS (SELECT lang, words, max(f) AS longer FROM parts GROUP BY ALL),
kept AS (
  SELECT s.*, array_to_string(s.words, ' ') AS phrase FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.words = s.words
  WHERE h.longer IS NULL OR 100 * h.longer < 80 * s.a),
totals AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""

# Lengths by the template: 7 signs around a learnt turn, 14 and the role around any other, and a backslash for
# each control string inside a text.
_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?INST\]'))
    + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(role) END)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

#: Newton iterations, bin packing, tokenizers and trained models are beyond SQL; tests compare with brute force.
ORACLES: dict[str, str] = {"op11_tiled_phrases": _PHRASES, "op12_event_sourced_chat": _CHAT}
