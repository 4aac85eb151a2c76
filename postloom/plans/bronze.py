"""Raw messages as text with their topic position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze(topic_rows: DataFrame) -> DataFrame:
    """Topic rows (batch or stream) with key and value as text and the time of ingestion."""
    return topic_rows.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )
