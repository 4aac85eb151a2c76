from __future__ import annotations

import json
from datetime import date

from post_rows import make_bronze, make_posts
from postloom.catalog import queries
from postloom.catalog.queries import silver_posts
from postloom.operators import joins
from postloom.operators.dedupe import dedupe_posts_stream
from postloom.plans import gold
from postloom.plans.tables import build_silver, build_tables, gold_tables, shown, text_tables
from postloom.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from postloom.session import move_files
from postloom.sinks.keyed_store import KeyedStore
from postloom.sources.samples import LEXICON, messages
from postloom.sources.tables import read_table, read_table_stream
from postloom.sources.topic import read_stored_topic, topic_options
from postloom.streaming import refresh
from postloom.streaming.ingest import (
    RULE_METRICS,
    audited_silver_stream,
    bronze_stream,
    keyed_store_stream,
    silver_stream,
)
from postloom.streaming.refresh import gold_refresh_stream, threads_refresh_stream
from pyspark.sql import functions as F


def same_rows(left, right):
    columns = sorted(set(left.columns) - {"ingestion_timestamp"})
    left, right = left.select(columns), right.select(columns)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def post(number, **changes):
    base = {"type": "tweet", "id": str(number), "text": f"#tag post {number}", "username": "u", "keyword": "k"}
    return json.dumps({**base, "created_at": "2024-01-01T00:00:00Z", "like_count": number, **changes})


def bronze_of(spark, texts, first_offset=0):
    return make_bronze(spark, texts).withColumns(
        {
            "kafka_offset": F.col("kafka_offset") + first_offset,
            "kafka_timestamp": F.timestamp_seconds(F.col("kafka_offset") + first_offset),
        }
    )


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_dir, tmp_path):
    messages(spark, sf_dir).repartition(6).write.parquet(str(tmp_path / "topic"))

    def ingest():
        topic = read_stored_topic(spark, str(tmp_path / "topic"), files_per_trigger=2)
        finish(bronze_stream(topic, str(tmp_path / "bronze"), str(tmp_path / "_b"), available_now=True))
        rows = read_table_stream(spark, str(tmp_path / "bronze"), BRONZE_SCHEMA)
        return finish(silver_stream(rows, str(tmp_path / "silver"), str(tmp_path / "_s"), available_now=True))

    query = ingest()
    metrics = [p.observedMetrics[RULE_METRICS] for p in query.recentProgress if RULE_METRICS in p.observedMetrics]
    stored = spark.read.schema(SILVER_SCHEMA).parquet(str(tmp_path / "silver"))
    batch = silver_posts(spark, sf_dir)
    same_rows(stored, batch)
    assert sum(m.rows_in for m in metrics) == 1000
    assert sum(m.rows_out for m in metrics) == stored.count()
    ingest()
    same_rows(spark.read.schema(SILVER_SCHEMA).parquet(str(tmp_path / "silver")), batch)


def test_gold_follows_silver(spark, tmp_path):
    """Two arrivals; the second touches one old day, one old thread and one keyword only."""
    first = [
        post(1),
        post(2, created_at="2024-01-02T00:00:00Z", keyword="other"),
        post(3, type="reply", root_tweet_id="1", created_at="2024-01-03T00:00:00Z"),
        post(4, created_at="never", keyword=None),
    ]
    second = [
        post(5),
        post(6, type="reply", root_tweet_id="2", created_at="2024-01-03T00:00:00Z", username="v"),
        post(7, type="reply", root_tweet_id="4", created_at="2024-01-04T00:00:00Z"),
    ]
    silver_path, base = str(tmp_path / "silver"), str(tmp_path / "gold")
    for n, texts in enumerate((first, second)):
        bronze_of(spark, texts, 100 * n).write.mode("append").parquet(str(tmp_path / "bronze"))
        rows = read_table_stream(spark, str(tmp_path / "bronze"), BRONZE_SCHEMA)
        finish(silver_stream(rows, silver_path, str(tmp_path / "_s"), available_now=True))
        stored = read_table_stream(spark, silver_path, SILVER_SCHEMA)
        finish(gold_refresh_stream(stored, silver_path, base, str(tmp_path / "_g"), available_now=True, threads=False))
        finish(threads_refresh_stream(stored, silver_path, base, str(tmp_path / "_t"), available_now=True))
        posts = spark.read.schema(SILVER_SCHEMA).parquet(silver_path)
        for name, (function, _) in gold_tables().items():
            expected = function(posts)
            same_rows(spark.read.schema(expected.schema).parquet(f"{base}/{name}").select(expected.columns), expected)
    threads = {r.tweet_id: r.actual_reply_count for r in gold.conversation_threads(posts).collect()}
    assert threads == {"1": 1, "2": 1, "4": 1, "5": 0}


def test_daily_figures_add_up(posts):
    same_rows(gold.top_users_of_days(gold.user_days(posts)), gold.top_users(posts))
    same_rows(gold.hourly_activity_of_days(gold.hour_days(posts)), gold.hourly_activity(posts))


def test_audited_stream(spark, tmp_path):
    texts = [post(1), post(2, type="x"), "not json", post(3, text="")]
    bronze_of(spark, texts).coalesce(1).write.parquet(str(tmp_path / "bronze"))
    rows = read_table_stream(spark, str(tmp_path / "bronze"), BRONZE_SCHEMA)
    silver_path, audit = str(tmp_path / "silver"), str(tmp_path / "audit")
    finish(audited_silver_stream(rows, silver_path, audit, str(tmp_path / "_a"), available_now=True))
    assert [r.tweet_id for r in spark.read.parquet(silver_path).collect()] == ["1"]
    row = spark.read.parquet(audit).first().asDict()
    assert row == {
        "batch": 0,
        "rows_in": 4,
        "rows_out": 1,
        "valid_id": 1,
        "valid_text": 2,
        "valid_username": 1,
        "valid_type": 2,
        "valid_date": 1,
    }


def test_stream_dedupe_keeps_the_first_copy(spark, tmp_path):
    from postloom.plans.silver import silver

    bronze_of(spark, [post(1), post(1, like_count=9), post(2), post(1, keyword="other")]).coalesce(1).write.parquet(
        str(tmp_path / "bronze")
    )
    rows = read_table_stream(spark, str(tmp_path / "bronze"), BRONZE_SCHEMA)
    query = (
        dedupe_posts_stream(silver(rows))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "_d"))
        .trigger(availableNow=True)
        .start()
    )
    finish(query)
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.keyword, r.tweet_id) for r in found.collect()) == [("k", "1"), ("k", "2"), ("other", "1")]


def test_keyed_store(spark, tmp_path):
    schema = "tweet_id string, like_count int, kafka_timestamp timestamp, kafka_offset bigint, kafka_partition int"
    store = KeyedStore(spark, str(tmp_path / "store"), schema, "tweet_id")
    assert store.read().count() == 0
    store.compact()

    def batch(rows):
        return spark.createDataFrame([(i, n, None, o, 0) for i, n, o in rows], schema)

    newest_first = [F.desc("kafka_offset")]
    store.upsert(batch([("a", 1, 0), ("a", 2, 1), ("b", 1, 2)]), 0, newest_first)
    store.upsert(batch([("b", 5, 3)]), 1, newest_first)
    store.upsert(batch([("b", 5, 3)]), 1, newest_first)  # the same batch once more
    expected = {"a": 2, "b": 5}
    assert {r.tweet_id: r.like_count for r in store.read().collect()} == expected
    assert store.read().columns == [c.split()[0] for c in schema.split(", ")]
    store.compact()
    assert {r.tweet_id: r.like_count for r in store.read().collect()} == expected
    store.upsert(batch([("a", 7, 4), ("c", 1, 5)]), 2, newest_first)
    assert {r.tweet_id: r.like_count for r in store.read().collect()} == {"a": 7, "b": 5, "c": 1}


def test_keyed_store_stream(spark, tmp_path):
    from postloom.plans.silver import silver

    bronze_of(spark, [post(1), post(1, like_count=9), post(2)]).coalesce(1).write.parquet(str(tmp_path / "bronze"))
    rows = read_table_stream(spark, str(tmp_path / "bronze"), BRONZE_SCHEMA)
    store = KeyedStore(spark, str(tmp_path / "store"), SILVER_SCHEMA, "tweet_id")
    finish(keyed_store_stream(silver(rows), store, str(tmp_path / "_k"), available_now=True))
    assert {r.tweet_id: r.like_count for r in store.read().collect()} == {"1": 9, "2": 2}


def test_batch_build(spark, tmp_path):
    base = str(tmp_path / "base")
    kinds = ("tweet", "reply")
    texts = [post(n, keyword=f"k{n % 2}", type=kinds[n % 2], root_tweet_id="0") for n in range(20)]
    bronze_of(spark, texts).write.parquet(f"{base}/bronze")
    silver_table = build_silver(spark, f"{base}/bronze", base)
    assert silver_table.count() == 20
    from postloom.operators.scoring import lexicon_batch_scorer, lexicon_row_scorer

    tables = gold_tables() | text_tables(
        ["the"], lexicon_row_scorer(LEXICON), lexicon_batch_scorer(LEXICON), LEXICON
    )
    built = build_tables(spark, base, tables)
    assert set(built) == set(tables)
    for name in tables:
        assert built[name].count() > 0, name
        if not name.startswith(("nlp", "predictions")):
            assert shown(name, built[name]).count() == built[name].count()
    assert read_table(spark, f"{base}/trending_hashtags").first().hashtag_usage_count == 10
    # A second run replaces the tables; a part of them can be built alone.
    again = build_tables(spark, base, tables, only=["tweet_stats"])
    assert again["tweet_stats"].agg(F.sum("total_tweets")).first()[0] == 10


def test_topic_options():
    plain = topic_options("host:9092", "posts")
    assert plain["maxOffsetsPerTrigger"] == "10000"
    assert plain["startingOffsets"] == "earliest"
    assert plain["failOnDataLoss"] == "false"
    assert "kafka.security.protocol" not in plain
    secured = topic_options("host:9092", "posts", rows_per_trigger=50_000, api_key="u", api_secret="p")
    assert secured["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="u" password="p"' in secured["kafka.sasl.jaas.config"]
    assert secured["maxOffsetsPerTrigger"] == "50000"


def test_audit_leaves_no_copies_of_the_posts(spark, sf_dir, tmp_path, monkeypatch):
    """Messages are made once for all batches, and their files go when silver holds the rows."""
    made = []
    sent = queries.messages
    counted = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    def noted(*args):
        made.append(sent(*args))
        return made[-1].mapInArrow(counting, made[-1].schema)

    monkeypatch.setattr(queries, "messages", noted)
    monkeypatch.setattr(queries, "shared_dir", lambda *_: f"{tmp_path}/audit-1")
    found = queries.QUERIES["ingest_audit"](spark, sf_dir).collect()
    assert len(found) == queries.AUDIT_BATCHES and sum(r.rows_in for r in found) == counted.value == made[0].count()
    assert sorted(p.name for p in (tmp_path / "audit-1").iterdir() if not p.name.startswith("_")) == ["audit", "sent"]


def test_files_of_several_folders_keep_apart(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part-0").write_text(folder)
        assert move_files(spark, str(tmp_path / folder), str(tmp_path / "all"), f"{folder}-") == 1
    assert move_files(spark, str(tmp_path / "none"), str(tmp_path / "all"), "") == 0
    assert {p.name: p.read_text() for p in (tmp_path / "all").iterdir() if p.suffix != ".crc"} == {"a-part-0": "a", "b-part-0": "b"}


def test_threads_of_days_shuffle_whole_posts_once(spark, tmp_path, monkeypatch):
    """The join leaves posts dealt by day; ids that repeat, ids on two days, and missing ids and days included."""
    monkeypatch.setattr(joins, "SLICE_ROWS", 4)
    days = [date(2024, 1, 1), date(2024, 1, 2), None]
    tweets = make_posts(
        spark,
        [{"type": "tweet", "tweet_id": str(i % 25) if i != 7 else None, "text": f"t{i}", "created_date": days[i % 3], "total_engagement": i} for i in range(40)],
    )
    answers = [
        {"type": "reply", "tweet_id": f"r{i}", "root_tweet_id": str(i % 33) if i % 9 else None, "username": ["a", "b", None][i % 3], "total_engagement": i}
        for i in range(200)
    ]
    replies = gold.replies_per_root(make_posts(spark, answers))
    found = gold.threads_of(tweets, replies, refresh._joined_by_day)
    assert sorted(map(str, found.collect())) == sorted(map(str, gold.threads_of(tweets, replies).collect()))
    refresh._replace("conversation_threads", found, str(tmp_path), dealt=True)
    folders = [*(tmp_path / "conversation_threads").glob("created_date=*")]
    assert len(folders) == 3 and max(len([*f.glob("*.parquet")]) for f in folders) <= 4
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("shufflepartitionidpassthrough") == 1 and "SortMergeJoin" not in plan.split("shufflepartitionidpassthrough")[0]
    none = gold.threads_of(tweets.filter("false"), replies, refresh._joined_by_day)
    assert none.count() == 0
