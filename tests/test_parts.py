"""Jobs done part by part of the opportunities."""

from __future__ import annotations

import pytest
from conftest import AS_OF, SF_DIR, rows
from pyspark.sql import functions as F

from ankenmart.operators.layout import Ranges
from ankenmart.operators.parts import in_parts, parts
from ankenmart.plans import pipeline, rollups
from ankenmart.plans.marts import BY_OPPORTUNITY, LINES, fact_opportunity_line_item
from ankenmart.plans.sales_semantics import LINE_ITEMS
from ankenmart.plans.wide import gold_opportunity_line_item_wide, line_item_wide_by_opportunity, write_by_opportunity
from fixtures.crm import crm_source


def _odd(tables):
    """The tables with an opportunity and a line that come twice, and some of either without an opportunity."""

    def odd(table):
        some = tables[table].limit(3)
        return tables[table].unionByName(some).unionByName(some.withColumn("opportunity_id", F.lit(None).cast("string")))

    return {**tables, **{t: odd(t) for t in ("stg_opportunity", LINES)}}


@pytest.mark.parametrize("make", [fact_opportunity_line_item, gold_opportunity_line_item_wide])
def test_parts_give_the_rows_of_the_whole(spark, tables, make):
    odd = {n: t.localCheckpoint() if n in ("stg_opportunity", LINES) else t for n, t in _odd(tables).items()}
    parted = parts(odd, BY_OPPORTUNITY, LINES, 2000)
    sizes = [part[LINES].count() for part in parted]
    assert len(sizes) == 3 and sum(sizes) == odd[LINES].count() and max(sizes) < 3000
    assert rows(in_parts(odd, BY_OPPORTUNITY, LINES, make, 2000)) == rows(make(odd))


@pytest.mark.parametrize("starts", [(), ("b",), ("b", "d", "f", "h"), ("b", "d", "d", "d", "h", "h"), ("d", "d", "d", "d")])
@pytest.mark.parametrize("most", [1, 2, 3])
def test_each_key_is_in_the_ranges_of_one_part(spark, starts, most):
    whole = Ranges(starts)
    keys = spark.createDataFrame([(k,) for k in "abcdefghi"] + [(None,)], "key string")
    each = [(ranges, keys.where(own(F.col("key")))) for ranges, own in whole.parts(most)]
    assert sorted(r.key or "" for _, own in each for r in own.collect()) == ["", *"abcdefghi"]
    assert sum(ranges.count for ranges, _ in each) == whole.count
    for ranges, own in each:
        numbers = [r.n for s in range(8) for r in own.select(ranges.place(F.col("key"), F.lit(s)).alias("n")).collect()]
        assert all(0 <= n < ranges.count for n in numbers)


def test_a_build_in_parts_writes_the_same_marts(spark, tables, tmp_path, monkeypatch):
    held = pipeline.ranges_of
    monkeypatch.setattr(pipeline, "ranges_of", lambda *a: held(*a, held=500))
    monkeypatch.setattr(pipeline, "RANGE_ROWS", 500)
    monkeypatch.setattr(pipeline, "PART_ROWS", 1500)
    made = []
    monkeypatch.setattr(pipeline, "Part", lambda *a, part=pipeline.Part: made.append(part(*a)) or made[-1])
    built = pipeline.build(spark, crm_source(spark, SF_DIR), str(tmp_path), AS_OF)
    assert len(made) >= 8 and set(built.status.values()) == {"built"}
    assert rows(built.marts[pipeline.LINE_FACT]) == rows(fact_opportunity_line_item(tables))
    assert rows(built.marts["gold_opportunity_line_item_wide"]) == rows(gold_opportunity_line_item_wide(tables))


def test_tables_by_opportunity_are_written_in_parts(spark, tables, tmp_path):
    name = write_by_opportunity(tables, "in_parts", str(tmp_path), buckets=3, slice_rows=5, part_rows=2500)
    assert rows(line_item_wide_by_opportunity(spark, name)) == rows(gold_opportunity_line_item_wide(tables))
    plan = line_item_wide_by_opportunity(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_rollups_of_parts_leave_nothing_but_the_rollups(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(rollups, "scratch_path", lambda spark, label: f"{tmp_path}/scratch/{label}")
    metrics, dimensions = [m.name for m in LINE_ITEMS.metrics], ["フェーズ", "受注エリア"]
    needed = LINE_ITEMS.columns_for(metrics, dimensions)
    whole = gold_opportunity_line_item_wide(tables, labels=needed)
    each = [gold_opportunity_line_item_wide(part, labels=needed) for part in parts(tables, BY_OPPORTUNITY, LINES, 2500)]
    made = rollups.write_rollups(LINE_ITEMS, each, [dimensions], str(tmp_path / "out"))
    assert rows(rollups.query(spark, LINE_ITEMS, made, metrics, dimensions)) == rows(LINE_ITEMS.query(whole, metrics, dimensions))
    assert not [p for p in (tmp_path / "scratch").iterdir() if p.is_dir()]
