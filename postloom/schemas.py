"""Table contracts."""

from __future__ import annotations

# One message on the topic. Posts and replies share it; a post simply lacks root_tweet_id.
POST_SCHEMA = """
    type string, id string, url string, keyword string, text string, created_at string, lang string,
    username string, user_id string, user_name string,
    is_reply boolean, in_reply_to_id string, in_reply_to_username string, root_tweet_id string,
    reply_count int, retweet_count int, like_count int, quote_count int, view_count int, bookmark_count int
"""

# The object a search service returns for one post.
API_SCHEMA = """
    id string, url string, text string, createdAt string, lang string,
    isReply boolean, inReplyToId string, inReplyToUsername string,
    replyCount int, retweetCount int, likeCount int, quoteCount int, viewCount int, bookmarkCount int,
    author struct<id: string, userName: string, name: string>
"""

# What a topic reader yields.
TOPIC_SCHEMA = """
    key binary, value binary, topic string, partition int, offset bigint,
    timestamp timestamp, timestampType int
"""

BRONZE_SCHEMA = """
    kafka_key string, raw_json string, kafka_topic string, kafka_partition int, kafka_offset bigint,
    kafka_timestamp timestamp, ingestion_timestamp timestamp
"""

COUNTERS = ["reply_count", "retweet_count", "like_count", "quote_count", "view_count", "bookmark_count"]

SILVER_SCHEMA = """
    kafka_key string, kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint,
    ingestion_timestamp timestamp,
    type string, tweet_id string, tweet_url string, keyword string, text string, language string,
    created_at timestamp, username string, user_id string, user_name string,
    is_reply boolean, in_reply_to_id string, in_reply_to_username string, root_tweet_id string,
    reply_count int, retweet_count int, like_count int, quote_count int, view_count int, bookmark_count int,
    created_date date, created_hour int, created_day_of_week int,
    text_length int, word_count int, has_url boolean, has_hashtag boolean, has_mention boolean,
    total_engagement bigint, hashtags array<string>, mentions array<string>,
    hashtag_count int, mention_count int
"""
