"""Reading a topic, live or from stored messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postloom.schemas import TOPIC_SCHEMA

# Default rows per micro-batch.
ROWS_PER_TRIGGER = 10_000


def topic_options(
    servers: str,
    topic: str,
    *,
    rows_per_trigger: int = ROWS_PER_TRIGGER,
    starting_offsets: str = "earliest",
    api_key: str | None = None,
    api_secret: str | None = None,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Options of the topic reader; with an api key the connection is SASL_SSL/PLAIN."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(rows_per_trigger),
        "failOnDataLoss": "false",
    }
    if api_key is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login_module} required username="{api_key}" password="{api_secret}";',
        }
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The live topic as a stream. Needs Spark's Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def read_stored_topic(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages stored as parquet with the topic's columns, as a stream."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)
