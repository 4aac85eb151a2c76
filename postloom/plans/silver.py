"""Parsed, enriched and checked posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postloom.functions import post
from postloom.operators.quality import POST_DROP_RULES, POST_WARN_RULES, apply_rules
from postloom.schemas import COUNTERS, POST_SCHEMA

TOPIC_COLUMNS = ["kafka_key", "kafka_timestamp", "kafka_partition", "kafka_offset", "ingestion_timestamp"]

# Table column and the message field it is read from.
RENAMED = {"tweet_id": "id", "tweet_url": "url", "language": "lang"}
CORE = ["type", "tweet_id", "tweet_url", "keyword", "text", "language", "created_at"]
USER = ["username", "user_id", "user_name"]
REPLY = ["is_reply", "in_reply_to_id", "in_reply_to_username", "root_tweet_id"]


def parsed_posts(bronze: DataFrame, named_day: bool = False) -> DataFrame:
    """Messages as columns. Text that is no JSON object gives a row of nulls, a field of the wrong
    type is null on its own.

    Each message is parsed once: filters on the parsed columns cannot move below a generator, as
    they would below a projection, where every one of them would parse the text again.
    """
    parsed = bronze.select(*TOPIC_COLUMNS, F.inline(F.array(F.from_json("raw_json", POST_SCHEMA))))
    fields = []
    for name in CORE + USER + REPLY + COUNTERS:
        field = F.col(RENAMED.get(name, name))
        if name == "created_at":
            field = post.parse_created_at(field, named_day)
        fields.append(field.alias(name))
    return parsed.select(*TOPIC_COLUMNS, *fields)


def enriched_posts(posts: DataFrame) -> DataFrame:
    """Parsed posts with date parts, text measures, engagement, tags and mentions."""
    at, text = F.col("created_at"), F.col("text")
    tagged = posts.withColumns({"hashtags": post.hashtags(text), "mentions": post.mentions(text)})
    return tagged.select(
        *posts.columns,
        F.to_date(at).alias("created_date"),
        F.hour(at).alias("created_hour"),
        F.dayofweek(at).alias("created_day_of_week"),
        F.length(text).alias("text_length"),
        post.word_count(text).alias("word_count"),
        post.has_url(text).alias("has_url"),
        (F.size("hashtags") > 0).alias("has_hashtag"),
        (F.size("mentions") > 0).alias("has_mention"),
        post.engagement("like_count", "retweet_count", "reply_count", "quote_count").alias("total_engagement"),
        "hashtags",
        "mentions",
        F.size("hashtags").alias("hashtag_count"),
        F.size("mentions").alias("mention_count"),
    )


def silver(bronze: DataFrame, observe: str | Observation | None = None, named_day: bool = False) -> DataFrame:
    """Checked posts from raw messages, batch or stream, without a shuffle."""
    parsed = parsed_posts(bronze, named_day)
    # The rules look at parsed columns only, so dropped rows are not enriched.
    return enriched_posts(apply_rules(parsed, POST_DROP_RULES, POST_WARN_RULES, observe))
