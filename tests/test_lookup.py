from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from ankenmart.operators.lookup import lookup


def test_left_join_keeps_rows_and_null_keys_never_match(spark):
    facts = spark.createDataFrame([("1", "a"), ("2", None), ("3", "z")], "id string, fk string")
    dim = spark.createDataFrame([("a", "A", 1), (None, "N", 2)], "key string, name string, other int")
    got = lookup(facts, dim, "fk", "key", "role", ["name"])
    assert got.columns == ["id", "fk", "role__name"]
    assert rows(got) == [("1", "a", "A"), ("2", None, None), ("3", "z", None)]


def test_hot_key_is_split_when_the_dimension_is_too_large_to_broadcast(spark, tmp_path):
    """A third of the rows on one key and a third without any: AQE splits their partitions."""
    facts = spark.range(0, 300_000, numPartitions=8).select(
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string"))
        .alias("fk"),
    )
    dim = spark.range(0, 300_000).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = lookup(facts, dim, "fk", "key", "role", ["name"])
        assert got.count() == 300_000
        # The sums keep the columns in the shuffle, whose bytes AQE goes by.
        out = got.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.hash("filler")), F.max("id"), F.max("role__name")
        )
        assert max(r.n for r in out.collect()) < 60_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_large_dimension_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(2_000_000).select(
        F.col("id").cast("string").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("name")
    ).write.parquet(path)
    facts = spark.range(10).select(F.col("id").cast("string").alias("fk"))
    plan = lookup(facts, spark.read.parquet(path), "fk", "key", "role", ["name"])
    assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()
