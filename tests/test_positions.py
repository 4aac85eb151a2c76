from __future__ import annotations

import random

import pytest
from postloom.operators import positions
from pyspark.sql import functions as F


@pytest.fixture
def numbered(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="7")
    rows = [(i, random.Random(i).choice([None, 1, 2, 3])) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(3)
    order = [F.desc("v"), F.asc("id")]
    expected = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    return positions.write_ordered(df, order, str(tmp_path / "ordered")), expected


def test_positions(numbered):
    got = {r.position: (r.id, r.v) for r in positions.with_positions(numbered[0]).collect()}
    assert got == dict(enumerate(numbered[1], 1))
    assert numbered[0].select("_range").distinct().count() == 7


@pytest.mark.parametrize(("size", "start"), [(10, 0), (25, 500), (400, 300), (10, 995), (5, 1000), (0, 3)])
def test_pages(numbered, size, start):
    assert [tuple(r) for r in positions.page(numbered[0], size, start).collect()] == numbered[1][start : start + size]


def test_a_page_reads_its_ranges_only(numbered):
    """A page within one range is filtered by that range and its places in the scan; nothing but its rows is sorted."""
    plan = positions.page(numbered[0], 5, 500)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(_range," in plan and "GreaterThanOrEqual(_place," in plan and "Window" not in plan


def test_no_task_ranks_all_rows(spark):
    """The one window without groups runs over row counts of ranges."""
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = positions.positioned(df, [F.asc("v"), F.asc("id")])._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Window")
    assert "Sort" not in above and "Aggregate" in below and "Window" not in below


def test_empty(spark):
    empty = spark.createDataFrame([], "id long, v int")
    assert positions.positioned(empty, [F.asc("id")]).collect() == []
    assert positions.deep_page(spark, empty, [F.asc("id")], 5, 10).collect() == []
