"""Posts with cleaned text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import cleaned_texts


def nlp_preprocessed(posts: DataFrame, stop_words: Iterable[str]) -> DataFrame:
    """Original, cleaned and stop-word-free text of every post. One stage; texts are cleaned in Arrow batches."""
    return posts.select(
        "tweet_id",
        "keyword",
        "type",
        "username",
        "created_at",
        "created_date",
        F.col("text").alias("original_text"),
        cleaned_texts(F.col("text"), stop_words).alias("_texts"),
        "total_engagement",
        "like_count",
        "retweet_count",
        "reply_count",
        "language",
    ).select(
        "tweet_id",
        "keyword",
        "type",
        "username",
        "created_at",
        "created_date",
        "original_text",
        "_texts.cleaned_text",
        "_texts.stopword_text",
        "total_engagement",
        "like_count",
        "retweet_count",
        "reply_count",
        "language",
    )
