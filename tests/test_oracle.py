"""Every registered query against its SQL twin."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest
from oracle_check import difference
from postloom.catalog.oracle import SQL
from postloom.catalog.queries import QUERIES

# One of the refreshed tables stands for all here: each runs the streams anew, and test_streaming compares all tables.
ONCE = {"refreshed_top_users", "refreshed_hourly", "refreshed_reply_stats", "refreshed_hashtags"}
# The same for merged tables (test_merging) and for orders beyond the first (test_positions).
ONCE |= {"merged_tweet_stats", "merged_reply_stats", "merged_threads"}
ONCE |= {"ordered_reply_stats", "ordered_top_users", "ordered_hashtags", "ordered_hourly", "ordered_sentiment", "ordered_sentiment_nonnull"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ONCE))
def test_equals_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, name) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["keyword", "tweet_id", "original_poster"]
