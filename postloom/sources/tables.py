"""Reading a table another step wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Batch read: a path when it holds a slash, else a catalog name of one to three parts."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_table_stream(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream read of a table that grows by appended files."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)
