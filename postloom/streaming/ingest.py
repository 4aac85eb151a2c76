"""Topic to bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators.quality import POST_DROP_RULES, POST_WARN_RULES
from postloom.plans.bronze import bronze
from postloom.plans.silver import silver
from postloom.session import STORED
from postloom.sinks.keyed_store import KeyedStore

# Name of the rule counts in a query's progress reports.
RULE_METRICS = "post_rules"


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def bronze_stream(topic: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append every topic row to the bronze table."""
    writer = bronze(topic).writeStream.format("parquet").option("compression", STORED).outputMode("append").option("path", path)
    return _start(writer, checkpoint, available_now)


def silver_stream(
    bronze_rows: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    files_per_day: int | None = None,
) -> StreamingQuery:
    """Append checked posts to the silver table, one folder per day. Violation counts of each
    micro-batch are in the query's progress under ``post_rules``.

    Without ``files_per_day`` there is no shuffle, and every task writes a file for every day it
    holds: right for live data of few days. A backfill of many days sets it; then a micro-batch
    adds at most that many files to a day, and a hot day is still spread over as many tasks.
    """
    posts = silver(bronze_rows, observe=RULE_METRICS)
    if files_per_day:
        posts = posts.repartition(F.col("created_date"), F.pmod(F.xxhash64("kafka_offset"), F.lit(files_per_day)))
    writer = (
        posts.writeStream.format("parquet").option("compression", STORED).outputMode("append").partitionBy("created_date").option("path", path)
    )
    return _start(writer, checkpoint, available_now)


def audited_silver_stream(
    bronze_rows: DataFrame, path: str, audit_path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Silver with one audit row per micro-batch: rows in and out, violations of each rule.

    The counts are gathered while the batch is written, not by a second pass. Both folders carry
    the batch number, so a batch that runs twice replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        posts = silver(batch, observe=counts)
        posts.write.mode("overwrite").option("compression", STORED).partitionBy("created_date").parquet(f"{path}/batch={batch_id}")
        rules = [*POST_DROP_RULES, *POST_WARN_RULES]
        names = ["rows_in", "rows_out", *rules]
        row = batch.sparkSession.createDataFrame(
            [tuple(counts.get[name] for name in names)], ", ".join(f"{name} bigint" for name in names)
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{audit_path}/batch={batch_id}")

    return _start(bronze_rows.writeStream.foreachBatch(write), checkpoint, available_now)


def keyed_store_stream(
    posts: DataFrame, store: KeyedStore, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Upsert a stream of posts into a keyed store; within a batch the last to arrive wins."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, batch_id, [F.desc("kafka_timestamp"), F.desc("kafka_offset"), F.desc("kafka_partition")])

    return _start(posts.writeStream.foreachBatch(write), checkpoint, available_now)
