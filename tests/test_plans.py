"""Plans that must hold at scale: early cuts, split hot keys, no Python where none is needed."""

from __future__ import annotations

from post_rows import make_posts
from postloom.catalog import queries
from postloom.functions.text import clean_text, remove_stop_words
from postloom.operators import dedupe
from postloom.plans import gold
from postloom.sources.selection import newest_per_keyword
from pyspark.sql import functions as F


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The adaptive plan after a run of exactly this query."""
    df._jdf.queryExecution().executedPlan().execute().count()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_text_stays_in_the_jvm(posts):
    cleaned = posts.select(remove_stop_words(clean_text(F.col("text")), ["the"]))
    assert "Python" not in executed(cleaned)


def test_ranked_groups_are_cut_before_the_shuffle(posts):
    for df in (gold.top_users(posts), dedupe.dedupe_posts(posts), newest_per_keyword(posts, 100)):
        plan = executed(df)
        assert plan.count("WindowGroupLimit") == 2, plan
        assert "Partial" in plan


def test_long_lists_are_cut_per_slice_first(posts):
    newest = newest_per_keyword(posts, 1_001)
    assert "_slice" in executed(newest)
    assert newest.count() == posts.count()
    short = gold.top_users(posts, 1_000)
    assert short.exceptAll(gold.top_users(posts, 1_001)).count() == 0


def test_lists_longer_than_the_sessions_limit_are_cut_per_slice(posts, conf):
    full = newest_per_keyword(posts, 100)
    conf(spark__sql__optimizer__windowGroupLimitThreshold="50")
    cut = newest_per_keyword(posts, 100)
    assert executed(cut).count("_slice") > 1
    assert cut.exceptAll(full).count() == 0 and cut.count() == full.count()


def test_gold_reads_only_its_columns_and_pushes_the_type_filter(posts):
    plan = executed(gold.reply_stats(posts))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(type,reply)" in scan
    assert "hashtags" not in scan.split("ReadSchema")[1] and " text:" not in scan.split("ReadSchema")[1]


def hot_posts(spark, copies=60_000):
    """One root post crawled again and again, and one root with most of the replies."""
    few = make_posts(
        spark,
        [
            *[{"type": "tweet", "tweet_id": f"t{i}"} for i in range(200)],
            *[{"type": "reply", "tweet_id": f"r{i}", "root_tweet_id": f"t{i % 50}"} for i in range(200)],
        ],
        username="u",
        keyword="k",
        text="x",
        total_engagement=1,
    )
    reply = F.col("id") % 2 == 1
    values = {
        "type": F.when(reply, "reply").otherwise("tweet"),
        "tweet_id": F.lit("t0"),
        "root_tweet_id": F.when(reply, "t0"),
        "keyword": F.lit("k"),
        "username": F.concat(F.lit("u"), (F.col("id") % 1000).cast("string")),
        "text": F.repeat(F.sha2(F.col("id").cast("string"), 256), 4),
        "total_engagement": F.lit(1).cast("bigint"),
        "kafka_offset": F.col("id"),
    }
    many = spark.range(copies).select(
        *[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in few.schema.fields]
    )
    return few.unionByName(many)


def test_hot_thread_is_split(spark, conf, tmp_path):
    hot_posts(spark).repartition(8).write.parquet(str(tmp_path / "hot"))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    hot = spark.read.parquet(str(tmp_path / "hot"))
    threads = gold.conversation_threads(hot)
    assert "skew=true" in final_plan(threads)
    top = threads.filter("tweet_id = 't0'").agg(
        F.count("*"), F.min("actual_reply_count"), F.max("actual_reply_count"), F.max("unique_repliers")
    )
    assert tuple(top.first()) == (30_001, 30_004, 30_004, 501)


def test_hot_id_dedupes_to_one_row(spark):
    rows = dedupe.dedupe_posts(hot_posts(spark, 2_000).filter("type = 'tweet'"))
    assert rows.filter("tweet_id = 't0'").count() == 1
    assert rows.count() == 200


def test_small_change_sets_leave_the_base_unshuffled(spark, sf_dir):
    plan = final_plan(queries.delete_by_id(spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_query_builds_pairs(spark, sf_dir):
    for name, query in queries.QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = executed(query(spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
