"""Work that must not grow faster than the input."""

from __future__ import annotations

from datetime import date, datetime

from post_rows import make_posts
from postloom.catalog import queries
from postloom.operators.dedupe import dedupe_posts, dedupe_stored_posts
from postloom.operators.scoring import score_lexicon
from postloom.schemas import SILVER_SCHEMA
from postloom.sinks.keyed_store import KeyedStore
from postloom.sources import samples
from postloom.sources.tables import read_table_stream
from postloom.streaming.latest import KEY, latest_posts_to_store
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_a_filter_on_labels_scores_no_text_twice(spark):
    texts = spark.createDataFrame([("on by",), ("th",), ("",), (None,), ("x",)], "text string")
    labelled = score_lexicon(texts, {"on": 1, "th": -1}, "text", "label")
    assert [r.label for r in labelled.collect()] == ["positive", "negative", None, None, "neutral"]
    kept = labelled.filter(F.col("label").isNotNull())
    assert sorted(r.label for r in kept.collect()) == ["negative", "neutral", "positive"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(split(") == 1


def test_messages_are_dealt_by_their_number(spark, monkeypatch):
    """A join of small tables with large results is dealt to as many tasks as the results need."""
    rows = sorted(map(str, samples.messages(spark, SF).select("offset", "value").collect()))
    monkeypatch.setattr(samples, "TASK_MESSAGES", 100)
    many = samples.messages(spark, SF)
    assert many.rdd.getNumPartitions() == -(-spark.read.parquet(f"{SF}/events.parquet").count() // 100)
    assert sorted(map(str, many.select("offset", "value").collect())) == rows


def test_silver_files_come_in_a_fixed_number_of_batches(spark, tmp_path):
    for number in range(90):
        post = {"tweet_id": str(number), "created_date": date(2024, 1, 1 + number % 30)}
        if number % 30 == 0:
            posts = []
        posts.append(post)
        if number % 30 == 29:
            make_posts(spark, posts).repartition(30).write.mode("append").parquet(str(tmp_path / "silver"))
    sizes = []
    rows = queries._silver_batches(spark, str(tmp_path))
    writer = rows.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
    writer.option("checkpointLocation", str(tmp_path / "_c")).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == queries.REFRESH_BATCHES and sum(sizes) == 90


def test_audit_of_many_files(spark, monkeypatch):
    """A batch is one part of the messages, in however many files it lies."""
    rows = sorted(map(tuple, queries.ingest_audit(spark, SF).collect()))
    monkeypatch.setattr(samples, "TASK_MESSAGES", 100)
    assert sorted(map(tuple, queries.ingest_audit(spark, SF).collect())) == rows and len(rows) == queries.AUDIT_BATCHES


def test_state_of_last_copies_comes_with_the_rows(spark, tmp_path):
    """A key's state is no round trip for each step, and an older copy after a newer one changes nothing."""
    path = str(tmp_path / "posts")
    for number, minute in enumerate((5, 9, 7)):
        post = {"tweet_id": "1", "text": str(minute), "kafka_timestamp": datetime(2024, 1, 1, 0, minute), "kafka_offset": number, "kafka_partition": 0}
        make_posts(spark, [post]).coalesce(1).write.mode("append").parquet(path)
    store = KeyedStore(spark, str(tmp_path / "store"), f"{SILVER_SCHEMA}, {KEY} string", KEY)
    rows = read_table_stream(spark, path, SILVER_SCHEMA, files_per_trigger=1)
    query = latest_posts_to_store(spark, rows, store, str(tmp_path / "_c"), available_now=True)
    query.awaitTermination()
    assert [r.text for r in store.read().collect()] == ["9"]
    assert query.lastProgress.stateOperators[0].operatorName == "applyInPandasWithState"


def test_refreshed_tables_leave_no_copies_of_the_posts(spark, tmp_path, monkeypatch):
    """Topic, bronze and silver hold every text once more each; they go when the next table is there."""
    monkeypatch.setattr(queries, "shared_dir", lambda _, purpose: f"{tmp_path}/{purpose}-1")
    found = queries.QUERIES["merged_hashtags"](spark, SF)
    (base,) = tmp_path.glob("ingest-*")
    assert sorted(p.name for p in base.iterdir() if not p.name.startswith("_")) == ["gold"]
    assert found.count() == queries.QUERIES["trending_hashtags"](spark, SF).count() > 0


def test_ingest_tasks_hold_a_bounded_number_of_messages(spark, monkeypatch):
    """However well the messages are packed; the session's own setting comes back."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(queries, "INGEST_TASK_MESSAGES", 100)
    monkeypatch.setattr(samples, "TASK_MESSAGES", 100)
    tasks = []
    started = queries.silver_stream

    def noted(rows, *args, **kwargs):
        tasks.append(len(rows.sparkSession.read.parquet(args[0].replace("silver", "bronze")).inputFiles()))
        return started(rows, *args, **kwargs)

    monkeypatch.setattr(queries, "silver_stream", noted)
    queries._run_ingest(spark, SF)
    assert tasks[0] >= spark.read.parquet(f"{SF}/events.parquet").count() // 200
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_repeated_posts_are_deduped_without_a_shuffle_of_texts(spark, tmp_path):
    at = [datetime(2024, 1, 1, 0, minute) for minute in range(3)]
    rows = [
        {"keyword": word, "tweet_id": key, "text": f"{n} {i}", "kafka_timestamp": at[(n + i) % 3], "kafka_offset": i, "kafka_partition": 0}
        for i, (word, key) in enumerate([("a", "1"), (None, "1"), ("b", "2"), ("b", "2"), ("b", ""), (None, None), ("c", "3")] * 40)
        for n in range(2)
    ]
    posts = make_posts(spark, rows).repartition(7)
    found = dedupe_stored_posts(posts)
    assert sorted(map(str, found.collect())) == sorted(map(str, dedupe_posts(posts).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan
    plan = queries.QUERIES["dedupe_latest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan


def test_objects_of_a_page_are_made_in_one_partition(spark):
    """Only events and one copy of a document for each part are shuffled, never whole objects."""
    plan = samples.api_pages(spark, SF)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if " Exchange " in line]
    assert "shufflepartitionidpassthrough" in shuffles[0] and "ObjectHashAggregate" in plan.split(" Exchange ")[0]


def test_grouped_rows_are_those_of_the_join(spark, tmp_path):
    """Documents and events that repeat or have no key included."""
    docs = [(0, "x", "en"), (0, "y", None), (2, None, "de"), (None, "z", "fr"), (3, "w", "en"), (3, "w", "en"), (9, "v", "en")]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    events = [(n, datetime(2024, 1, 1), n % 5, "click" if n % 3 else None, float(n)) for n in [*range(60), 7, 7]]
    events.append((None, datetime(2024, 1, 1), 1, "view", 1.0))
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet")
    )
    plain = samples.post_fields(spark, str(tmp_path))
    grouped = samples.post_fields(spark, str(tmp_path), F.floor(F.col("event_id") / 20))
    assert grouped.select("event_id", "_part").distinct().groupBy("event_id").count().filter("count > 1").count() == 0
    assert sorted(map(str, grouped.drop("_part").collect())) == sorted(map(str, plain.collect())) and plain.count() == 49
