"""Clustered and bucketed tables, result pages as variants, the letter model."""

from __future__ import annotations

import json
from datetime import date, timedelta

import pyarrow.parquet as pq
from post_rows import make_posts
from postloom.operators.letters import fit_letter_model, with_letter_counts
from postloom.operators.scoring import score_model
from postloom.plans import gold
from postloom.plans.bucketed import bucketed_threads, write_thread_tables
from postloom.sinks.keyed_store import KeyedStore
from postloom.sinks.routing import routed, write_routed
from postloom.sinks import zorder
from postloom.sinks.zorder import interleaved, write_zordered
from postloom.sources.api_objects import flatten_variant_objects, variant_objects
from pyspark.sql import functions as F


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in rows.select("a", "b", interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect():
        bits = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}", strict=True))
        assert r.z == int(bits, 2)


def groups_read(path, wanted):
    """Row groups whose statistics admit ``wanted``, of all."""
    read = total = 0
    for file in path.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            total += 1
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in wanted}
            read += all(s.min <= v <= s.max for (c, v), s in zip(wanted.items(), stats.values(), strict=True))
    return read, total


def test_zorder_skips_by_each_column(spark, tmp_path):
    rows = [(date(2024, 1, 1) + timedelta(days=d), f"k{k:02}", d * k) for d in range(32) for k in range(32) for _ in range(3)]
    rows += [(None, "k01", -1), (date(2024, 1, 1), None, -2)]
    df = spark.createDataFrame(rows, "day date, keyword string, n int")
    written = write_zordered(df, str(tmp_path / "z"), ["day", "keyword"], files=64)
    assert sorted(map(tuple, written.collect()), key=str) == sorted(rows, key=str)
    both, total = groups_read(tmp_path / "z", {"day": date(2024, 1, 20), "keyword": "k20"})
    day, _ = groups_read(tmp_path / "z", {"day": date(2024, 1, 20)})
    keyword, _ = groups_read(tmp_path / "z", {"keyword": "k20"})
    assert total == 64 and both <= 4 and day <= 20 and keyword <= 20
    df.repartitionByRange(64, "day").sortWithinPartitions("day", "keyword").write.parquet(str(tmp_path / "linear"))
    assert groups_read(tmp_path / "linear", {"keyword": "k20"})[0] > keyword


def test_bucketed_threads_need_no_exchange(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    posts = [{"type": "tweet", "tweet_id": str(i), "keyword": "k", "total_engagement": 1} for i in range(50)]
    posts += [{"type": "reply", "root_tweet_id": str(i % 7 * i % 60), "username": f"u{i % 5}", "total_engagement": i} for i in range(300)]
    posts += [{"type": "reply", "root_tweet_id": None, "username": "u"}, {"type": "reply", "root_tweet_id": "3", "username": None, "total_engagement": 1}]
    silver = make_posts(spark, posts)
    threads = bucketed_threads(*write_thread_tables(silver, "threads_test", str(tmp_path), 4))
    assert "Exchange" not in threads._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, threads.collect())) == sorted(map(str, gold.conversation_threads(silver).collect()))
    for name in ("roots", "repliers"):
        spark.sql(f"DROP TABLE threads_test_{name}")


def test_variant_objects_tell_absent_from_null(spark):
    objects = [{"id": "1", "likeCount": None, "author": None}, {"id": "2", "isReply": None, "viewCount": "many"}, {"id": 3, "likeCount": 5, "author": {"userName": "u"}}]
    pages = [("k", None, json.dumps({"tweets": objects})), ("k", "9", json.dumps({"tweets": [{}]}))]
    pages += [("k", None, raw) for raw in ("", "{", "[]", "{}", '{"tweets": []}', '{"tweets": null}', None)]
    found = variant_objects(spark.createDataFrame(pages, "keyword string, root_tweet_id string, raw string"))
    got = {r.id: r for r in flatten_variant_objects(found).collect()}
    assert sorted(map(str, got)) == ["1", "2", "3", "None"]
    assert (got["1"].like_count, got["1"].view_count, got["1"].is_reply, got["1"].username) == (None, 0, False, None)
    assert (got["2"].like_count, got["2"].view_count, got["2"].is_reply) == (0, None, None)
    assert (got["3"].like_count, got["3"].username, got["3"].type) == (5, "u", "tweet")
    assert (got[None].is_reply, got[None].type, got[None].root_tweet_id) == (True, "reply", "9")


def test_letter_model(spark):
    rows = [(1, "aaab", 1), (2, "bbba", 0), (3, "aa", 1), (4, "bb", 0), (5, "", 1), (6, None, 0), (7, "zzz", None)]
    docs = spark.createDataFrame(rows, "id int, text string, label int")
    model = fit_letter_model(docs, "text", "label")
    scored = score_model(with_letter_counts(docs.drop("label"), "text"), model, {0.0: "b", 1.0: "a"}, "text", "found")
    got = {r.id: r.found for r in scored.collect()}
    assert [got[i] for i in range(1, 7)] == ["a", "b", "a", "b", None, None] and got[7] in ("a", "b")


def test_keyed_store_reads_and_folds_given_buckets(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path), "id bigint, v string", "id", buckets=4)
    batch = lambda rows: spark.createDataFrame(rows, "id long, v string")
    first = [F.asc("v")]
    assert store.read().collect() == [] and store.compact() is None
    store.upsert(batch([(i, "a") for i in range(40)] + [(None, "n"), (3, "b")]), 0, first)
    bucket = {r.id: r.b for r in batch([(i, "") for i in range(40)]).select("id", store._bucket().alias("b")).collect()}
    store.compact([bucket[3]])
    folders = {p.name for p in (tmp_path / "snapshot").rglob("_bucket=*")}
    assert folders == {f"_bucket={bucket[3]}"}
    store.upsert(batch([(3, "c"), (4, "c"), (99, "new")]), 1, first)
    store.upsert(batch([(3, "c"), (4, "c"), (99, "new")]), 1, first)
    expected = {i: "a" for i in range(40)} | {None: "n", 3: "c", 4: "c", 99: "new"}
    assert {r.id: r.v for r in store.read().collect()} == expected
    store.compact([bucket[3]])
    store.compact()
    store.compact()
    assert {r.id: r.v for r in store.read().collect()} == expected
    found = store.lookup(batch([(3, ""), (3, ""), (1000, "")]))
    assert [tuple(r) for r in found.collect()] == [(3, "c")]
    plan = store.read([1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "(_bucket" in plan.partition("PartitionFilters")[2]


def test_posts_are_routed_without_a_shuffle(spark, tmp_path):
    """Each task writes its own posts; dealing an index to a number of files is the caller's choice."""
    days = [date(2024, 1, 1), date(2024, 1, 2), None]
    posts = make_posts(spark, [{"tweet_id": str(i), "text": f"text {i}", "created_date": days[i % 3]} for i in range(90)])
    posts = posts.repartition(5).withColumn("keyword", F.spark_partition_id().cast("string"))
    posts.write.parquet(str(tmp_path / "posts"))
    posts = spark.read.schema(posts.schema).parquet(str(tmp_path / "posts")).repartition(5, "keyword")
    want = sorted(map(str, routed(posts).collect()))
    for name, files in (("plain", None), ("dealt", 2)):
        write_routed(posts, str(tmp_path / name), files_per_index=files)
        read = spark.read.schema(routed(posts).schema).parquet(str(tmp_path / name))
        assert sorted(map(str, read.collect())) == want
        tasks = read.groupBy(F.input_file_name()).agg(F.count_distinct(F.pmod(F.hash("keyword"), F.lit(5))).alias("n")).collect()
        if files:
            assert max(len(list(d.glob("*.parquet"))) for d in (tmp_path / name).glob("_index=*")) <= files
        else:
            assert {r.n for r in tasks} == {1}


def test_zorder_reads_twice_and_bounds_its_files(spark, tmp_path, monkeypatch):
    """Rows are made once to count them and once to write them; equal values, nulls and repeated rows fill no file beyond the bound."""
    monkeypatch.setattr(zorder, "FILE_ROWS", 100)
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(i % 3 and "hot", date(2024, 1, 1 + i % 28) if i % 7 else None, f"text {i // 2}", ["x", None]) for i in range(1_200)]
    df = spark.createDataFrame([(str(a) if a else None, *r) for a, *r in rows], "keyword string, day date, text string, tags array<string>")
    written = write_zordered(df.mapInArrow(counted, df.schema), str(tmp_path / "z"), ["day", "keyword"], files=2)
    assert made.value == 2 * 1_200
    assert sorted(map(str, written.collect())) == sorted(map(str, df.collect()))
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 200
    empty = write_zordered(df.filter("false"), str(tmp_path / "none"), ["day", "keyword"], files=2)
    assert empty.count() == 0
