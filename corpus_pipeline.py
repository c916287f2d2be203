"""From raw documents to packed sequences: filter, deduplicate, redact, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ankenmart.llm import mixing, packing, pii, quality, simhash
from ankenmart.llm.common import documents, saved

#: The stages share Python workers, so the tokenizer's memory is kept below that of a job of its own.
REMEMBERED = 250_000


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go. It learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id."""
    return simhash.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    mixed = mixing.mix(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text"), keep=("row", "doc_id"))
    repeated = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return mixed.where("copies > 0").select("row", repeated).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the sequences."""
    return packing.pack(docs, remembered=REMEMBERED)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", deduplicate),
    ("PII", redact),
    ("mixing", mix),
    ("best-fit packing", pack),
]

#: Trained models, Newton iterations and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written out and read back before the next.

    Null and empty texts are classified like any other; near duplicates without an id are one document each text;
    repeated rows stay once; a null source is a source of its own; other columns of documents, whatever their
    names, are carried to the last stage; without documents, or if all are rejected, there are no rows.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
