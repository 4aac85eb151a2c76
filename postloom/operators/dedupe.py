"""Repeated posts and reply work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.operators.joins import lookup_anti_join
from postloom.operators.ranking import latest_per_key
from postloom.session import STORED, shared_dir

# Fixed value: replies a post needs before its replies are fetched.
REPLY_THRESHOLD = 10
# What one bitmap of Spark's holds.
BITMAP_ROWS = 32_768


def dedupe_posts(posts: DataFrame, id_column: str = "tweet_id") -> DataFrame:
    """One row per keyword and id, the last to arrive; rows without an id are dropped."""
    with_id = posts.filter(F.col(id_column) != "")
    return latest_per_key(
        with_id, ["keyword", id_column], [F.desc("kafka_timestamp"), F.desc("kafka_offset"), F.desc("kafka_partition")]
    )


def dedupe_stored_posts(posts: DataFrame, id_column: str = "tweet_id") -> DataFrame:
    """:func:`dedupe_posts` for whole posts: only keys and places are sorted and shuffled, not the texts.

    The posts are written once. Which of their rows stay is kept as one bit for each row of a file, so
    that reading them again is a look-up, a broadcast where Spark finds the bits small enough.
    """
    # Whole texts make no dictionary.
    rows = stored_with_places(posts, "repeated-posts", **{"compression": STORED, "parquet.enable.dictionary": "false"})
    order = ["kafka_timestamp", "kafka_offset", "kafka_partition"]
    last = dedupe_posts(rows.select("keyword", id_column, *order, *PLACE), id_column)
    return at_places(rows, last, "kept-posts").select(posts.columns)


# What names a row of written files.
PLACE = ["_file", "_stretch", "_bit"]


def stored_with_places(rows: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``rows`` written once and read back, with the columns of ``PLACE``."""
    spark = rows.sparkSession
    path = shared_dir(spark, purpose)
    rows.write.options(**options).parquet(path)
    place = F.col("_metadata.row_index")
    return spark.read.schema(rows.schema).parquet(path).select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.floor(place / BITMAP_ROWS).alias("_stretch"),
        (place % BITMAP_ROWS).alias("_bit"),
    )


def at_places(rows: DataFrame, kept: DataFrame, purpose: str) -> DataFrame:
    """Rows of ``stored_with_places`` whose places are in ``kept``, without a shuffle of whole rows.

    Kept places are one bit for each row of a file, a broadcast where Spark finds the bits small enough.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, purpose)
    bits = kept.repartition("_file", "_stretch").groupBy("_file", "_stretch").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    bits.write.parquet(path)
    bits = spark.read.schema(bits.schema).parquet(path)
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_kept = F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(1) == 1
    return rows.join(bits, ["_file", "_stretch"]).filter(is_kept)


def dedupe_posts_stream(
    posts: DataFrame, id_column: str = "tweet_id", event_time: str = "kafka_timestamp", within: str = "1 hour"
) -> DataFrame:
    """Stream form: the first copy of a keyword and id passes, later ones within the delay are dropped."""
    with_id = posts.filter(F.col(id_column) != "")
    return with_id.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["keyword", id_column])


def not_yet_fetched(candidates: DataFrame, fetched: DataFrame, keys: Sequence[str] = ("tweet_id",)) -> DataFrame:
    """Candidates whose keys are not in ``fetched``; a null key is a key like any other."""
    return lookup_anti_join(candidates, fetched.select(*keys).distinct(), keys)


def reply_worklist(posts: DataFrame, fetched: DataFrame, threshold: int = REPLY_THRESHOLD) -> DataFrame:
    """Posts with at least ``threshold`` replies (null counts as 0) whose replies were not fetched for
    their keyword yet."""
    hot = posts.filter((F.col("type") == "tweet") & (F.coalesce("reply_count", F.lit(0)) >= threshold))
    return not_yet_fetched(hot, fetched, ["keyword", "tweet_id"])


def orphan_replies(posts: DataFrame) -> DataFrame:
    """Replies no thread counts: their root post is not among the posts, or they name none."""
    replies = posts.filter(F.col("type") == "reply")
    roots = posts.filter(F.col("type") == "tweet").select(F.col("tweet_id").alias("root_tweet_id"))
    return not_yet_fetched(replies, roots, ["root_tweet_id"])
