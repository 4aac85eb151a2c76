"""Ranked rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to the size that this setting names, Catalyst cuts a ranked group inside each map task.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
# Slices of a group that are cut on their own where Catalyst does not, step by step: no task ranks
# more than 64 times ``n`` rows of a group that an earlier step has cut.
SLICES = (4_096, 64)


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str], rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group in a total order, optionally with their rank from 1.

    A hot group is never one task: a list that the session's limit allows is cut to ``n`` rows per
    map task before the shuffle, a longer one is first cut per slice of the group, in ever fewer
    slices. ``spread`` names columns whose hash deals the rows of a group to slices.
    """
    column = rank or "_rank"

    def cut(rows: DataFrame, *by: str) -> DataFrame:
        ranked = rows.withColumn(column, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.filter(F.col(column) <= n)

    if n > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        for slices in SLICES:
            sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), F.lit(slices)))
            df = cut(sliced, *keys, "_slice").drop("_slice", column)
    top = cut(df, *keys)
    return top if rank else top.drop(column)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; a key that holds a third of all rows sends one
    row per map task."""
    return top_per_group(df, keys, newest_first, 1, keys)
