"""Threads from tables that lie in buckets of the root's id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.plans import gold
from postloom.sinks.tables import write_bucketed

BUCKETS = 64


def write_thread_tables(posts: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Root posts and repliers as tables ``<name>_roots`` and ``<name>_repliers``, bucketed by ``tweet_id``.

    Replies are summed up per root and replier before they are dealt to buckets, so a root that most
    posts answer fills its bucket with one row for each user, not for each post.
    """
    roots = posts.filter(F.col("type") == "tweet").repartition(buckets, "tweet_id")
    replies = posts.filter((F.col("type") == "reply") & F.col("root_tweet_id").isNotNull())
    repliers = replies.groupBy(F.col("root_tweet_id").alias("tweet_id"), "username").agg(
        F.count("*").alias("replies"), F.sum("total_engagement").alias("engagement")
    )
    return (
        write_bucketed(roots, f"{name}_roots", f"{path}/roots", buckets, ["tweet_id"]),
        write_bucketed(repliers.repartition(buckets, "tweet_id"), f"{name}_repliers", f"{path}/repliers", buckets, ["tweet_id"]),
    )


def bucketed_threads(roots: DataFrame, repliers: DataFrame) -> DataFrame:
    """Conversation threads; neither the sums per root nor the join moves a row between tasks."""
    replies = repliers.groupBy("tweet_id").agg(
        F.sum("replies").alias("direct_reply_count"),
        F.count("username").alias("unique_repliers"),
        F.sum("engagement").alias("replies_total_engagement"),
    )
    return gold.threads_of(roots, replies, lambda left, right, keys, how: left.join(right, keys, how))
