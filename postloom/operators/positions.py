"""Positions in a global order, and pages anywhere in it, without a task that sees all rows before.

Rows are range partitioned by the order and sorted in their ranges; each knows its range and its
place there. Positions follow from the ranges' row counts by a running sum over as many numbers as
there are ranges. The numbered rows are a written table, so all pages of one search share one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postloom.session import shared_dir

RANGE, PLACE = "_range", "_place"
# monotonically_increasing_id counts the rows of a partition in its low 33 bits.
PLACE_BITS = (1 << 33) - 1


def write_ordered(df: DataFrame, order: Sequence[Column], path: str) -> DataFrame:
    """``df`` written in ranges of ``order``, with the number of its range and the place in it.

    The order must be total (end in a unique key): then ranges are even, and positions don't depend
    on the run.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS))
    numbered = ranged.withColumns({RANGE: F.spark_partition_id(), PLACE: place})
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def range_starts(numbered: DataFrame) -> DataFrame:
    """``(_range, _start, _rows)``: how many rows lie before each range, and in it."""
    counts = numbered.groupBy(RANGE).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    return counts.select(RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"), "_rows")


def with_positions(numbered: DataFrame, name: str = "position") -> DataFrame:
    """Rows of :func:`write_ordered` with their position from 1."""
    # One row per range: no larger than the number of partitions of one shuffle.
    starts = F.broadcast(range_starts(numbered).drop("_rows"))
    position = (F.col("_start") + F.col(PLACE) + 1).alias(name)
    columns = [c for c in numbered.columns if c not in (RANGE, PLACE)]
    return numbered.join(starts, RANGE).select(*columns, position)


def page(numbered: DataFrame, size: int, start: int) -> DataFrame:
    """``size`` rows from position ``start`` (from 0) on; reads the files of the ranges that hold them."""
    columns = [c for c in numbered.columns if c not in (RANGE, PLACE)]
    end = start + size
    held = range_starts(numbered).filter((F.col("_start") < end) & (F.col("_start") + F.col("_rows") > start)).collect()
    wanted = F.lit(False)
    for row in held:  # ranges of one page, each with a stretch of places
        wanted = wanted | ((F.col(RANGE) == row[RANGE]) & F.col(PLACE).between(start - row["_start"], end - 1 - row["_start"]))
    return numbered.filter(wanted).orderBy(RANGE, PLACE).select(columns)


def positioned(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's position in ``order``, from 1; written to a new shared folder on the way."""
    return with_positions(write_ordered(df, order, shared_dir(df.sparkSession, "ordered")), name)


def deep_page(spark: SparkSession, df: DataFrame, order: Sequence[Column], size: int, start: int) -> DataFrame:
    """One page however deep: no task sorts more than its own range."""
    return page(write_ordered(df, order, shared_dir(spark, "pages")), size, start)
