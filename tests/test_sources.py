from __future__ import annotations

import json
from datetime import date

from post_rows import make_posts
from postloom.sinks.routing import routed
from postloom.sinks.tables import register_table, write_table
from postloom.sinks.topic import topic_rows
from postloom.sources.api_objects import flatten_api_objects, objects_of_pages
from postloom.sources.selection import newest_per_keyword, recent_window
from postloom.sources.tables import read_table
from pyspark.sql import functions as F


def test_pages_and_missing_keys(spark):
    full = {"id": "1", "text": "é", "isReply": True, "likeCount": 5, "author": {"id": "u", "userName": "n", "name": "N"}}
    nulls = {"id": "2", "likeCount": None, "isReply": None, "author": None}
    pages = spark.createDataFrame(
        [
            (json.dumps({"tweets": [full, nulls, {"id": "3"}], "next_cursor": "c", "has_next_page": True}), "k", None),
            (json.dumps({"tweets": [{"id": "4"}]}), "k", "1"),
            (json.dumps({"tweets": []}), "k", None),
            (json.dumps({}), "k", None),
        ],
        "raw string, keyword string, root_tweet_id string",
    )
    rows = {r.id: r for r in flatten_api_objects(objects_of_pages(pages)).collect()}
    assert sorted(rows) == ["1", "2", "3", "4"]
    assert [(rows[i].like_count, rows[i].is_reply, rows[i].type) for i in "1234"] == [
        (5, True, "tweet"),
        (None, None, "tweet"),
        (0, False, "tweet"),
        (0, True, "reply"),
    ]
    assert (rows["1"].username, rows["1"].user_name, rows["1"].text) == ("n", "N", "é")
    assert (rows["2"].username, rows["4"].root_tweet_id) == (None, "1")


def test_topic_rows_keep_nulls_and_letters(spark):
    posts = spark.createDataFrame([("k", "é", None), (None, "x", 1)], "keyword string, text string, n int")
    rows = [tuple(r) for r in topic_rows(posts).collect()]
    assert rows == [
        ("k", '{"keyword":"k","text":"é","n":null}'),
        ("default", '{"keyword":null,"text":"x","n":1}'),
    ]


def test_selection(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    posts = make_posts(
        spark,
        [
            {"tweet_id": f"{k}{d}", "keyword": k, "created_date": date.fromisoformat(d), "kafka_offset": n}
            for n, d in enumerate(days)
            for k in ("a", "b")
        ],
    ).withColumn("created_at", F.col("created_date").cast("timestamp"))
    window = recent_window(posts, date(2024, 1, 8), 3, ["a"])
    assert sorted(r.tweet_id for r in window.collect()) == ["a2024-01-05", "a2024-01-06", "a2024-01-07"]
    assert recent_window(posts, date(2024, 1, 8), 3).count() == 6
    newest = sorted(r.tweet_id for r in newest_per_keyword(posts, 2).collect())
    assert newest == ["a2024-01-09", "a2024-01-10", "b2024-01-09", "b2024-01-10"]


def test_routing(spark):
    posts = spark.createDataFrame([(date(2024, 1, 31),), (None,)], "created_date date")
    assert [r._index for r in routed(posts).collect()] == ["social_posts-2024.01.31", "social_posts-current"]


def test_registered_table(spark, tmp_path):
    path = str(tmp_path / "stats")
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "keyword string, n int")
    write_table(df, path, ["keyword"], sort_by=["n"])
    name = "spark_catalog.default.stats_for_test"
    try:
        register_table(spark, name, path, "It's daily", {"quality": "gold"})
        stored = read_table(spark, name)
        assert sorted((r.n, r.keyword) for r in stored.collect()) == [(1, "a"), (2, "b"), (3, None)]
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        assert properties["quality"] == "gold"
        # Only the partitions at hand are replaced.
        change = spark.createDataFrame([("b", 9)], "keyword string, n int")
        write_table(change, path, ["keyword"], only_given_partitions=True)
        assert sorted(r.n for r in read_table(spark, path).collect()) == [1, 3, 9]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
