"""Reading the given tables, and written intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.session import shared_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and no executor's loss matters."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))
