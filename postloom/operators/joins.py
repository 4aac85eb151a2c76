"""Joins against a table that an aggregate just produced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lookup_anti_join(rows: DataFrame, looked_up: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in ``looked_up (keys)``; here a null equals a null. Splits hot keys like :func:`lookup_join`."""
    other = looked_up.select([F.col(k).alias(f"_other_{k}") for k in keys])
    other = other.withColumn("_other_shard", F.xxhash64(*[f"_other_{k}" for k in keys]))
    same = F.col("_shard") == F.col("_other_shard")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_other_{k}"))
    return rows.withColumn("_shard", F.xxhash64(*keys)).join(other, same, "left_anti").drop("_shard")


def lookup_join(rows: DataFrame, looked_up: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``rows`` (keys may repeat without bound) to ``looked_up`` (one row per key).

    The output of an aggregate is already partitioned by its keys, and adaptive execution splits a
    hot key only where both join sides come straight out of an exchange made for that join. The
    second, derived key makes Spark exchange the narrow aggregated side once more, and so lets it
    split the rows of a hot key over many tasks. A small ``looked_up`` still becomes a broadcast
    at run time, by its measured size.
    """
    shard = F.xxhash64(*keys)
    joined = rows.withColumn("_shard", shard).join(
        looked_up.withColumn("_shard", shard), [*keys, "_shard"], how
    )
    return joined.drop("_shard")


# Rows of one part on average, which a task sorts in memory.
SLICE_ROWS = 20_000


def dealt_join(rows: DataFrame, looked_up: DataFrame, group: str, key: str) -> DataFrame:
    """Left join of ``rows`` to ``looked_up`` (one row per ``group`` and ``key``), dealt to files of their groups.

    Whole rows are shuffled once, for the join and for a write by ``group`` together: to one of a group's
    parts by their key. A group is a day or a bucket, of which there are few; a null is one like any other,
    but no row is found for a null key.
    """
    sizes = rows.groupBy(group).count().agg(F.count("*").alias("groups"), F.max("count").alias("most")).first()
    slices = max(1, -(-(sizes["most"] or 0) // SLICE_ROWS))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), sizes["groups"] * slices)
    found = looked_up.filter(F.col(key).isNotNull())
    found = found.select(group, key, F.struct(*[c for c in looked_up.columns if c not in (group, key)]).alias("_found"))
    both = rows.withColumn("_is_row", F.lit(True)).unionByName(found, allowMissingColumns=True)
    part = F.pmod(F.xxhash64(group, F.pmod(F.xxhash64(key), F.lit(slices))), F.lit(parts)).cast("int")
    both = both.withColumn("_part", part).repartitionById(parts, F.col("_part"))
    both = both.withColumn("_found", F.max("_found").over(Window.partitionBy("_part", group, key)))
    return both.filter("_is_row").select(*rows.columns, "_found.*")
