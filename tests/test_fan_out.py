from __future__ import annotations

from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ankenmart.operators.fan_out import _deal, fan_out, hot_keys
from ankenmart.operators.layout import ranges_of


def _sides(spark, headers, lines):
    one = spark.createDataFrame(headers, "k string, h string")
    many = spark.createDataFrame(lines, "k string, id string")
    return one, many


def _plain(one, many):
    lines = many.select(F.col("k").alias("mk"), "id")
    return one.join(lines, F.col("k") == F.col("mk"), "left").select("k", "h", "id")


SKEWED = (
    [("a", "hot"), ("b", "few"), ("c", "none"), (None, "no key"), ("b", "same key twice")],
    [("a", f"a{i}") for i in range(50)]
    + [("b", f"b{i}") for i in range(4)]
    + [("x", f"x{i}") for i in range(50)]  # hot, without a header
    + [(None, "n1"), (None, "n2")],
)


def test_hot_key_is_sliced_and_nothing_changes(spark):
    one, many = _sides(spark, *SKEWED)
    hot = hot_keys(many, "k", slice_rows=10)
    assert rows(hot) == [("a", 5), ("x", 5)]
    got = fan_out(one, many, "k", "id", hot).select("k", "h", "id")
    assert rows(got) == rows(_plain(one, many))


def test_empty_slices_give_no_rows(spark):
    # Equal ids all fall into one of the slices; the copies of the others must vanish.
    one, many = _sides(spark, [("a", "hot")], [("a", "same")] * 30)
    got = fan_out(one, many, "k", "id", hot_keys(many, "k", slice_rows=10)).select("k", "h", "id")
    assert rows(got) == [("a", "hot", "same")] * 30


def test_slices_are_even(spark):
    many = spark.range(30_000).select(F.lit("a").alias("k"), F.col("id").cast("string").alias("id"))
    dealt = _deal(many, hot_keys(many, "k", slice_rows=1000), "k", F.col("id"))
    sizes = [r["count"] for r in dealt.groupBy("_slice").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 1300


def test_per_key_tables_reach_every_slice(spark):
    one, many = _sides(spark, *SKEWED)
    extra = spark.createDataFrame([("a", 1), ("c", 3)], "k string, e int")
    hot = hot_keys(many, "k", slice_rows=10)
    got = fan_out(one, many, "k", "id", hot, [extra]).select("k", "h", "id", "e")
    want = _plain(one, many).join(extra.withColumnRenamed("k", "ek"), F.col("k") == F.col("ek"), "left")
    assert rows(got) == rows(want.select("k", "h", "id", "e"))


def test_many_side_is_shuffled_once(spark):
    one, many = _sides(spark, *SKEWED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fan_out(one, many, "k", "id", hot_keys(many, "k")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1
    # One exchange a side, and one of counted keys for each use of the hot list.
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("partial_count") == 2


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    headers=st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=5),
    lines=st.lists(st.sampled_from(["a", "b", "x", None]), min_size=1, max_size=25),
    slice_rows=st.integers(1, 6),
)
def test_any_data_joins_as_plainly(spark, headers, lines, slice_rows):
    one, many = _sides(
        spark,
        [(k, f"h{i}") for i, k in enumerate(headers)],
        [(k, f"l{i}") for i, k in enumerate(lines)],
    )
    got = fan_out(one, many, "k", "id", hot_keys(many, "k", slice_rows)).select("k", "h", "id")
    assert rows(got) == rows(_plain(one, many))


def test_ranges_partition_the_join_by_its_own_shuffles(spark):
    headers = [(f"k{i:03d}", i) for i in range(300)] + [(None, -1), ("k003", 5000)]
    details = [(f"k{i * 7 % 320:03d}", f"d{i}") for i in range(2000)] + [("k150", f"h{i}") for i in range(3000)] + [(None, "x")]
    one = spark.createDataFrame(headers, "k string, a long")
    many = spark.createDataFrame(details, "k string, line string")
    counts = one.select("k").unionByName(many.select("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    ranges, hot = ranges_of(counts, "k", "n", 400), hot_keys(many, "k", 300)
    per_key = one.where("k IS NOT NULL").select("k", F.length("k").alias("c")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, want = (fan_out(one, many, "k", "line", hot, [per_key], r) for r in (ranges, None))
        assert plan_of(got).count("REPARTITION_BY_NUM") == 3 and plan_of(got).count("hashpartitioning") < plan_of(want).count("hashpartitioning")
        assert rows(got) == rows(want)
        spans = got.groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).orderBy("p").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:])) and max(s.n for s in spans) <= 1000
    assert sum(s.lo <= "k150" <= s.hi for s in spans) > 5
    assert ranges_of(counts.limit(0), "k", "n").count == 1
