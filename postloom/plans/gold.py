"""Aggregated tables over the checked posts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.joins import lookup_join
from postloom.operators.ranking import top_per_group

# List length and threshold of the reports.
TOP_USERS = 50
MIN_HASHTAG_USES = 3


def _of_type(posts: DataFrame, kind: str) -> DataFrame:
    return posts.filter(F.col("type") == kind)


def _type_count(kind: str) -> Column:
    return F.count_if(F.col("type") == kind)


def tweet_stats(posts: DataFrame) -> DataFrame:
    """Daily figures of root posts per keyword."""
    return (
        _of_type(posts, "tweet")
        .groupBy("created_date", "keyword")
        .agg(
            F.count("*").alias("total_tweets"),
            F.count_distinct("username").alias("unique_users"),
            F.count_distinct("tweet_id").alias("unique_tweet_ids"),
            F.sum("like_count").alias("total_likes"),
            F.sum("retweet_count").alias("total_retweets"),
            F.sum("reply_count").alias("total_replies"),
            F.sum("quote_count").alias("total_quotes"),
            F.sum("view_count").alias("total_views"),
            F.sum("bookmark_count").alias("total_bookmarks"),
            F.sum("total_engagement").alias("total_engagement"),
            F.avg("like_count").alias("avg_likes"),
            F.avg("retweet_count").alias("avg_retweets"),
            F.avg("reply_count").alias("avg_replies"),
            F.avg("total_engagement").alias("avg_engagement"),
            F.avg("text_length").alias("avg_text_length"),
            F.avg("word_count").alias("avg_word_count"),
            F.avg("hashtag_count").alias("avg_hashtags"),
            F.avg("mention_count").alias("avg_mentions"),
            F.count_if("has_url").alias("tweets_with_url"),
            F.count_if("has_hashtag").alias("tweets_with_hashtag"),
            F.count_if("has_mention").alias("tweets_with_mention"),
            F.count_if("is_reply").alias("reply_tweets"),
            F.count_if(F.col("language") == "en").alias("english_tweets"),
            F.count_if(F.col("language") == "id").alias("indonesian_tweets"),
            F.min("created_at").alias("first_tweet_time"),
            F.max("created_at").alias("last_tweet_time"),
        )
    )


def reply_stats(posts: DataFrame) -> DataFrame:
    """Daily figures of replies per keyword."""
    return (
        _of_type(posts, "reply")
        .groupBy("created_date", "keyword")
        .agg(
            F.count("*").alias("total_replies"),
            F.count_distinct("username").alias("unique_repliers"),
            F.count_distinct("root_tweet_id").alias("unique_root_tweets"),
            F.sum("like_count").alias("total_reply_likes"),
            F.sum("retweet_count").alias("total_reply_retweets"),
            F.avg("total_engagement").alias("avg_reply_engagement"),
            F.avg("text_length").alias("avg_reply_length"),
            F.avg("word_count").alias("avg_reply_words"),
        )
    )


USER = ["keyword", "username", "user_name", "user_id"]
USER_SUMS = ["total_likes", "total_retweets", "total_replies_received", "total_engagement"]
POST_COUNTS = ["post_count", "tweet_count", "reply_count"]


def _user_figures(posts: DataFrame, *keys: str) -> DataFrame:
    return posts.groupBy(*keys, *USER).agg(
        F.count("*").alias("post_count"),
        _type_count("tweet").alias("tweet_count"),
        _type_count("reply").alias("reply_posts"),
        F.sum("like_count").alias("total_likes"),
        F.sum("retweet_count").alias("total_retweets"),
        F.sum("reply_count").alias("total_replies_received"),
        F.sum("total_engagement").alias("total_engagement"),
        F.max("created_at").alias("last_post_time"),
    ).withColumnRenamed("reply_posts", "reply_count")


def _ranked_users(users: DataFrame, limit: int) -> DataFrame:
    """Ties are broken by the user's names, so ranks do not depend on the run."""
    average = (F.col("total_engagement") / F.col("post_count")).alias("avg_engagement_per_post")
    figures = users.select(*USER, *POST_COUNTS, *USER_SUMS, average, "last_post_time")
    order = [F.desc("total_engagement"), F.asc("username"), F.asc("user_id"), F.asc("user_name")]
    return top_per_group(figures, ["keyword"], order, limit, spread=USER, rank="user_rank")


def top_users(posts: DataFrame, limit: int = TOP_USERS) -> DataFrame:
    """The users with most engagement per keyword."""
    return _ranked_users(_user_figures(posts), limit)


def user_days(posts: DataFrame) -> DataFrame:
    """Daily figures of every user: what the ranking is refreshed from."""
    return _user_figures(posts, "created_date")


def top_users_of_days(days: DataFrame, limit: int = TOP_USERS) -> DataFrame:
    """:func:`top_users` from :func:`user_days`."""
    users = days.groupBy(*USER).agg(
        *[F.sum(c).alias(c) for c in [*POST_COUNTS, *USER_SUMS]], F.max("last_post_time").alias("last_post_time")
    )
    return _ranked_users(users, limit)


def replies_per_root(posts: DataFrame) -> DataFrame:
    """Reply figures of every root post: ``tweet_id`` is the root's id."""
    return (
        _of_type(posts, "reply")
        .filter(F.col("root_tweet_id").isNotNull())
        .groupBy(F.col("root_tweet_id").alias("tweet_id"))
        .agg(
            F.count("*").alias("direct_reply_count"),
            F.count_distinct("username").alias("unique_repliers"),
            F.sum("total_engagement").alias("replies_total_engagement"),
        )
    )


def conversation_threads(posts: DataFrame) -> DataFrame:
    """Root posts with the figures of their replies."""
    return threads_of(_of_type(posts, "tweet"), replies_per_root(posts))


def threads_of(tweets: DataFrame, replies: DataFrame, join: Callable[..., DataFrame] = lookup_join) -> DataFrame:
    """Root posts joined to reply figures by ``tweet_id``; posts without replies get zeros.

    ``join`` is another way to join where both sides are laid out for it already.
    """
    own = tweets.select(
        "keyword",
        "tweet_id",
        F.col("username").alias("original_poster"),
        F.col("text").alias("original_tweet_text"),
        "created_at",
        "created_date",
        F.col("like_count").alias("original_likes"),
        F.col("retweet_count").alias("original_retweets"),
        F.col("reply_count").alias("original_reply_count"),
        F.col("total_engagement").alias("original_engagement"),
    )
    zero = F.lit(0).cast("bigint")
    from_replies = F.coalesce("replies_total_engagement", zero)
    return join(own, replies, ["tweet_id"], "left").select(
        *own.columns,
        F.coalesce("direct_reply_count", zero).alias("actual_reply_count"),
        F.coalesce("unique_repliers", zero).alias("unique_repliers"),
        from_replies.alias("replies_engagement"),
        (F.col("original_engagement") + from_replies).alias("conversation_total_engagement"),
    )


def trending_hashtags(posts: DataFrame, min_uses: int = MIN_HASHTAG_USES) -> DataFrame:
    """Daily use of each hashtag per keyword, rare ones left out."""
    return (
        posts.select("created_date", "keyword", "type", F.explode("hashtags").alias("hashtag"))
        .groupBy("created_date", "keyword", "hashtag")
        .agg(
            F.count("*").alias("hashtag_usage_count"),
            _type_count("tweet").alias("in_tweets"),
            _type_count("reply").alias("in_replies"),
        )
        .filter(F.col("hashtag_usage_count") >= min_uses)
    )


HOUR = ["keyword", "created_hour", "created_day_of_week"]
HOUR_COUNTS = ["total_posts", "tweet_count", "reply_count"]


def _hour_figures(posts: DataFrame, *keys: str) -> DataFrame:
    return posts.groupBy(*keys, *HOUR).agg(
        F.count("*").alias("total_posts"),
        _type_count("tweet").alias("tweet_count"),
        _type_count("reply").alias("reply_count"),
        F.sum("total_engagement").alias("engagement"),
    )


def _with_average(hours: DataFrame) -> DataFrame:
    average = (F.col("engagement") / F.col("total_posts")).alias("avg_engagement")
    return hours.select(*HOUR, *HOUR_COUNTS, average)


def hourly_activity(posts: DataFrame) -> DataFrame:
    """Posts by weekday and hour per keyword."""
    return _with_average(_hour_figures(posts))


def hour_days(posts: DataFrame) -> DataFrame:
    """Hourly figures of every day: what the activity pattern is refreshed from."""
    return _hour_figures(posts, "created_date")


def hourly_activity_of_days(days: DataFrame) -> DataFrame:
    """:func:`hourly_activity` from :func:`hour_days`."""
    return _with_average(days.groupBy(*HOUR).agg(*[F.sum(c).alias(c) for c in [*HOUR_COUNTS, "engagement"]]))
