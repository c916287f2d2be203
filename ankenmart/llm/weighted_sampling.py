"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

For each of the samples a term of weight w gets r and c from Gamma(2, 1) and b from U(0, 1), all drawn by
hashing the term, and t = floor(ln w / r + b). The term with the least ln a = ln c - r (t - b + 1) is
sampled with t. Texts agree on a sample with the generalised Jaccard similarity of their weights as
probability. Since ln a follows from term and t, the least ln a itself stands for the pair.

Cases: a null text is empty; a text without words has an empty fingerprint, like any other such text and
unlike all others; rows of equal id are ordered by a hash of the text, rows without id come last; rows of one
id and text follow each other; the next document of the only one is itself; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ankenmart.llm.common import WORD, key_starts, order_key, saved, starts_before, text_of

SAMPLES = 32
BUCKET_DOCS = 1000
MOST_BUCKETS = 200_000
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def term_runs(text: Column) -> Column:
    """The words, A-Z lowered and sorted, each with its repeats as one string: in the row, unshuffled."""
    words = F.regexp_extract_all(F.translate(text, _CAPITALS, _SMALL), F.lit(WORD), F.lit(0))
    return F.regexp_extract_all(F.array_join(F.sort_array(words), " "), F.lit(r"([^ ]++)(?: \1(?= |$))*+"), F.lit(0))


def _uniform(bits: Column) -> Column:
    return (bits + 0.5) / float(1 << 32)


def _low(hash_: Column) -> Column:
    return hash_.bitwiseAND(F.lit((1 << 32) - 1))


def log_sample(term_hash: str, log_weight: str, sample: int) -> Column:
    """ln a of a term in one sample."""
    first = F.xxhash64(F.col(term_hash), F.lit(sample))
    second = F.xxhash64(F.col(term_hash), F.lit(sample), F.lit("c"))
    third = F.xxhash64(F.col(term_hash), F.lit(sample), F.lit("b"))
    gamma = lambda h: -F.ln(_uniform(_low(h)) * _uniform(F.shiftrightunsigned(h, 32)))
    r, log_c, b = gamma(first), F.ln(gamma(second)), _uniform(_low(third))
    t = F.floor(F.col(log_weight) / r + b)
    return log_c - r * (t - b + 1.0)


def sampled(rows: DataFrame, runs: str, by: list[str], samples: int = SAMPLES) -> DataFrame:
    """One row for each value of ``by`` with ``signature``: an array of the least ln a of each sample, as
    floats, so that the last bits of a logarithm don't matter. Null where there is no term."""
    run = rows.select(*by, F.explode_outer(runs).alias("run"))
    term = F.substring_index("run", " ", 1)
    weight = (F.char_length("run") + 1) / (F.char_length(term) + 1)
    hashed = run.select(*by, F.xxhash64(term).alias("term"), F.when(F.col("run").isNotNull(), F.ln(weight)).alias("log_weight"))
    least = hashed.groupBy(*by).agg(*(F.min(log_sample("term", "log_weight", i)).alias(f"s{i}") for i in range(samples)))
    return least.select(*by, F.array(*(F.col(f"s{i}").cast("float") for i in range(samples))).alias("signature"))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of samples on which two signatures agree."""
    same = [F.when(F.get(a, F.lit(i)).eqNullSafe(F.get(b, F.lit(i))), 1).otherwise(0) for i in range(samples)]
    return sum(same[1:], same[0]) / float(samples)


def as_text(signature: str) -> Column:
    """Eight hex digits a sample; empty for a text without words."""
    parts = F.transform(signature, lambda x: F.lpad(F.hex(_low(F.xxhash64(x))), 8, "0"))
    return F.when(F.get(signature, F.lit(0)).isNull(), "").otherwise(F.lower(F.array_join(parts, "")))


def _repeats_counted(rows: DataFrame, hot: list[str], bucket_docs: int) -> DataFrame:
    """Rows whose key is hot, which are equal rows, as few rows with ``copies``, the last of one copy."""
    keys = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], "key string"))
    n = F.col("n").cast("long")
    rests = F.transform(
        F.sequence(F.lit(0).cast("long"), F.greatest(n - 2, F.lit(0)), F.lit(bucket_docs).cast("long")),
        lambda at: F.struct(F.least(F.lit(bucket_docs), n - 1 - at).cast("int").alias("copies"), F.lit(False).alias("visits")),
    )
    parts = F.concat(F.filter(rests, lambda part: part["copies"] > 0), F.array(F.struct(F.lit(1).alias("copies"), F.lit(True).alias("visits"))))
    counted = rows.join(keys, "key", "left_semi").groupBy("id", "text", "key").agg(F.count(F.lit(1)).alias("n"))
    dealt = counted.select("id", "text", "key", F.explode(parts).alias("part")).select("id", "text", "key", "part.*")
    return rows.join(keys, "key", "left_anti").unionByName(dealt)


def with_next(docs: DataFrame, key: str, text: str, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """Columns id, text, next_text, copies, bucket, place and guest, hash-partitioned by bucket.

    Keys of the chain are sorted first, 33 bytes a row, and cut into buckets of ``bucket_docs`` rows whatever the
    ids are; equal or missing ids are cut by the hash of the text. Rows of a bucket meet in one window, and the
    first row of the bucket that follows visits as a guest, which has no successor of its own. Equal rows beyond
    a bucket are counted where they are read and travel as few rows with ``copies``.
    """
    rows = docs.select(
        F.col(key).alias("id"), text_of(text).alias("text"), order_key(F.col(key), text_of(text), descending=True).alias("key"),
        F.lit(1).alias("copies"), F.lit(True).alias("visits"),
    )
    listed = key_starts(saved(rows.select("key"), "keys"), bucket_docs, MOST_BUCKETS)
    hot = sorted({a for a, b in zip(listed, listed[1:], strict=False) if a == b})
    distinct = sorted(set(listed)) or [""]
    starts = F.split(F.lit(",".join(distinct)), ",")
    if hot:
        rows = _repeats_counted(rows, hot, bucket_docs)
    rows = rows.withColumn("bucket", starts_before("key", starts, len(distinct)) - 1)
    first = F.col("visits") & (F.col("key") == F.get(starts, F.col("bucket")))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("bucket") - 1, F.lit(len(distinct))).alias("bucket"), F.lit(True).alias("guest"))
    at = F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own)))
    order = W.partitionBy("bucket").orderBy("guest", "key", F.desc("copies"))
    return rows.select("id", "text", "key", "copies", at.alias("at")).select("id", "text", "key", "copies", "at.bucket", "at.guest").select(
        "id", "text", "copies", "bucket", "guest",
        F.lead("text").over(order).alias("next_text"), F.row_number().over(order).alias("place"),
    )


def edited_text(text: str, following: str) -> Column:
    """The second half of the code points replaced by as many of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(F.coalesce(following, F.lit("")), F.lit(1), half))


def fingerprint_edits(
    docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES, bucket_docs: int = BUCKET_DOCS
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness; texts are shuffled once.

    All that follows the shuffle groups and orders within a bucket, so it stays where the texts are.
    """
    chained = with_next(docs, key, text, bucket_docs).withColumn("edited", edited_text("text", "next_text"))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")),
    )
    rows = chained.select(
        "bucket", "place", "guest", "id", "copies", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(sides).alias("s"),
    ).where(~F.col("guest") | (F.col("s.side") == 0))
    by = ["bucket", "place", "guest", "id", "copies", "n_chars", "edited_sha256", "side"]
    runs = rows.select(*by[:-1], F.col("s.side").alias("side"), term_runs(F.col("s.body")).alias("runs"))
    signed = sampled(runs, "runs", by, samples)
    order = W.partitionBy("bucket").orderBy("place", "side")
    found = signed.select(
        "*", F.lead("signature", 1).over(order).alias("edited"), F.lead("signature", 2).over(order).alias("following")
    ).where("side = 0 AND NOT guest")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return each.select(
        F.col("id").alias(key), "n_chars", "edited_sha256",
        as_text("signature").alias("fingerprint"), as_text("edited").alias("edited_fingerprint"),
        likeness("signature", "edited", samples).alias("near_edited"),
        likeness("signature", "following", samples).alias("near_next"),
    )
