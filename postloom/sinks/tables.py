"""Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.session import STORED


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    only_given_partitions: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Write and read back. Never writes over a path that ``df`` is read from.

    Rows are rebalanced by the partition columns, so a day is a few files of target size, and
    adaptive execution splits a day that holds far more rows than the others. Sorting inside the
    files lets row-group statistics prune reads by the sort columns. ``only_given_partitions``
    replaces just the partitions that occur in ``df``. Rows that are ``dealt`` by the partition columns
    already are written as they lie.
    """
    spread = df if dealt else df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        spread = spread.sortWithinPartitions(*partition_by, *sort_by)
    overwrite = "dynamic" if only_given_partitions else "static"
    writer = spread.write.mode(mode).partitionBy(*partition_by).option("partitionOverwriteMode", overwrite)
    writer = writer.option("compression", STORED)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str]) -> DataFrame:
    """A catalog table under ``path`` whose rows lie in ``buckets`` by the hash of ``keys``, sorted by them.

    Tables with equal numbers of buckets join on exactly these keys without an exchange. Rows that
    are hash partitioned by ``keys`` already are written as they lie, one file a bucket where that
    partitioning counts ``buckets`` partitions too (adaptive execution may have merged some);
    all others should be repartitioned first.
    """
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(
    spark: SparkSession, name: str, path: str, comment: str, properties: Mapping[str, str] | None = None
) -> None:
    """Give a stored table a catalog name, a comment and properties such as ``quality``.

    ``name`` may have one to three parts. Partition folders are found on registering; call it again
    after new ones were written.
    """
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in {**(properties or {}), "comment": comment}.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {_quoted(path)}")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
    if spark.sql(f"DESCRIBE TABLE {name}").filter("col_name = '# Partition Information'").take(1):
        spark.sql(f"MSCK REPAIR TABLE {name}")
