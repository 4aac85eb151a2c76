"""Posts as topic messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: message key of a post without a keyword.
DEFAULT_KEY = "default"


def message_key(keyword: Column) -> Column:
    return F.coalesce(keyword, F.lit(DEFAULT_KEY))


def message_value(fields: Sequence[str]) -> Column:
    """The fields as a JSON object, with nulls kept and text unescaped."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def topic_rows(posts: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """``key, value``: the keyword and the post as JSON."""
    return posts.select(
        message_key(F.col("keyword")).alias("key"), message_value(fields or posts.columns).alias("value")
    )


def write_topic(rows: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None) -> None:
    """Send ``key, value`` rows. Needs Spark's Kafka package on the class path."""
    (
        rows.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )
