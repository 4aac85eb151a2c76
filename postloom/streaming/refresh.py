"""Keeping the aggregated tables up to date while silver grows.

Exact distinct counts cannot run as streaming aggregates, so every micro-batch recomputes the
partitions it touches from stored silver and replaces just those. A batch that runs twice does the
same work twice and ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators.joins import dealt_join
from postloom.plans import gold
from postloom.plans.tables import BUCKET, keyword_bucket, laid_out, partitions_of
from postloom.sinks.tables import write_table
from postloom.sources.tables import read_table

BY_DAY = {
    "tweet_stats": gold.tweet_stats,
    "reply_stats": gold.reply_stats,
    "trending_hashtags": gold.trending_hashtags,
    "user_days": gold.user_days,
    "hour_days": gold.hour_days,
}
# Tables that span all days are put together from daily figures, never from all posts again.
BY_KEYWORD = {
    "top_users": (gold.top_users_of_days, "user_days"),
    "hourly_activity": (gold.hourly_activity_of_days, "hour_days"),
}
THREADS = "conversation_threads"


def touched(batch: DataFrame, column: str) -> Column:
    """Filter for the partitions a batch touches; a literal list prunes the folders read.

    Only for columns with few values by nature: days, of which a table has as many folders, and
    keyword buckets.
    """
    values = [row[0] for row in batch.select(column).distinct().collect()]
    listed = F.col(column).isin([v for v in values if v is not None])
    return listed | F.col(column).isNull() if None in values else listed


def _replace(name: str, table: DataFrame, base_dir: str, dealt: bool = False) -> None:
    write_table(laid_out(name, table), f"{base_dir}/{name}", partitions_of(name), only_given_partitions=True, dealt=dealt)


def refresh_gold(batch: DataFrame, silver_path: str, base_dir: str, threads: bool = True) -> None:
    """Recompute what the silver rows of ``batch`` (already stored) touch."""
    spark = batch.sparkSession
    posts = read_table(spark, silver_path)
    of_days = posts.filter(touched(batch, "created_date"))
    days = {name: function(of_days) for name, function in BY_DAY.items()}
    for name, table in days.items():
        _replace(name, table, base_dir)
    buckets = touched(batch.select(keyword_bucket().alias(BUCKET)), BUCKET)
    for name, (function, source) in BY_KEYWORD.items():
        schema = laid_out(source, days[source]).schema
        stored = spark.read.schema(schema).parquet(f"{base_dir}/{source}")
        _replace(name, function(stored.filter(buckets)), base_dir)
    if threads:
        _replace(THREADS, _touched_threads(batch, posts), base_dir, dealt=True)


def _touched_threads(batch: DataFrame, posts: DataFrame) -> DataFrame:
    """All threads of the days whose root posts the batch holds or answers.

    Replies of any day may belong to them, so the reply columns of all silver are read; but only
    replies to these days' posts go on to the shuffle.
    """
    root = F.when(F.col("type") == "tweet", F.col("tweet_id")).otherwise(F.col("root_tweet_id"))
    roots = batch.select(root.alias("tweet_id")).filter("tweet_id IS NOT NULL").distinct()
    tweets = posts.filter(F.col("type") == "tweet")
    days = tweets.select("tweet_id", "created_date").join(roots, "tweet_id", "left_semi")
    tweets = tweets.filter(touched(days, "created_date"))
    wanted = tweets.select(F.col("tweet_id").alias("root_tweet_id")).distinct()
    answers = posts.filter(F.col("type") == "reply").join(wanted, "root_tweet_id", "left_semi")
    return gold.threads_of(tweets, gold.replies_per_root(answers), _joined_by_day)


def _joined_by_day(tweets: DataFrame, replies: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Left join of root posts to one row per root, dealt by day: the figures of replies first learn the days of their roots."""
    (key,), day = keys, "created_date"
    known = tweets.select(F.col(key).alias("_key"), day).distinct()
    return dealt_join(tweets, replies.join(known, F.col(key) == F.col("_key")).drop("_key"), day, key)


def gold_refresh_stream(
    silver_rows: DataFrame,
    silver_path: str,
    base_dir: str,
    checkpoint: str,
    available_now: bool = False,
    threads: bool = True,
) -> StreamingQuery:
    """Refresh the tables after every micro-batch of the stored silver stream.

    Replies may answer a post of any day, so the threads read the reply columns of all silver.
    ``threads=False`` leaves them to :func:`threads_refresh_stream` with larger batches.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        refresh_gold(batch, silver_path, base_dir, threads)

    writer = silver_rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def threads_refresh_stream(
    silver_rows: DataFrame,
    silver_path: str,
    base_dir: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = "1 hour",
) -> StreamingQuery:
    """Refresh the touched threads alone, at its own pace."""

    def run(batch: DataFrame, batch_id: int) -> None:
        _replace(THREADS, _touched_threads(batch, read_table(batch.sparkSession, silver_path)), base_dir, dealt=True)

    writer = silver_rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()
