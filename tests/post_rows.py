"""Rows of posts for tests."""


def make_bronze(spark, messages):
    """Bronze rows from JSON texts."""
    from postloom.schemas import BRONZE_SCHEMA

    rows = [("k", text, "t", 0, i, None, None) for i, text in enumerate(messages)]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def make_posts(spark, rows, **defaults):
    """Silver-like rows with only the columns that ``rows`` and ``defaults`` name."""
    from postloom.schemas import SILVER_SCHEMA
    from pyspark.sql import types as T

    full = T.StructType.fromDDL(SILVER_SCHEMA)
    merged = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(row.get(f.name) for f in full.fields) for row in merged], full)
