"""Posts derived from the general test tables, so that the whole path from message to report runs.

Every event becomes one message about one document's whole text. Faults that the quality rules and
parsers must meet (missing ids, broken JSON, bad times, empty texts, ...) are mixed in by fixed
remainders of the event id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postloom.sinks.topic import message_key, message_value
from postloom.sources.api_objects import COUNTER_FIELDS, PLAIN_FIELDS

# Word lists of the text queries.
STOP_WORDS = ["the", "of", "and", "to", "is", "de", "der", "la", "le"]
LEXICON = {
    **dict.fromkeys(["on", "by", "er", "for", "at"], 1),
    **dict.fromkeys(["th", "in", "en", "an", "un"], -1),
}
# Messages of one task on average: whole texts, so that sorting them for a write fits its memory.
TASK_MESSAGES = 20_000
# The same where each task gets its documents once more: more messages, fewer copies.
GROUPED_TASK_MESSAGES = 50_000
WORDLESS = "!!! 2024 ???"
NOT_JSON = "not json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(divisor: int, remainder: int = 0) -> Column:
    return F.col("event_id") % divisor == remainder


def _unless(fault: Column, value: Column) -> Column:
    return F.when(~fault, value)


def _texts_in_parts(events: DataFrame, documents: DataFrame, parts: int, group: Column) -> DataFrame:
    """Events joined to their documents, rows of one ``group`` in one partition, which ``_part`` names.

    A document goes once to each part with events about it, not once for each event; then parts need no
    further shuffle. Documents may repeat: an event comes out once for each row of its document.
    """
    events = events.withColumn("_part", F.pmod(F.xxhash64(group), F.lit(parts)).cast("int"))
    # Neither side is bounded, so the join is never a broadcast.
    wanted = events.select("_part", "doc_id").distinct()
    copies = wanted.join(documents.repartition(parts, "doc_id").hint("merge"), "doc_id")
    copies = copies.select("_part", "doc_id", F.struct("text", "lang").alias("_document"))
    rows = events.withColumn("_is_event", F.lit(True)).unionByName(copies, allowMissingColumns=True)
    found = F.collect_list("_document").over(Window.partitionBy("_part", "doc_id"))
    joined = rows.repartitionById(parts, F.col("_part")).withColumn("_documents", found).filter("_is_event")
    return joined.select(*events.columns, F.inline("_documents"))


def post_fields(spark: SparkSession, sf_dir: str, group: Column | None = None) -> DataFrame:
    """The message fields of every event as columns, with ``event_id`` and ``ts``.

    The join's partitions follow from the number of messages that come out of it, not from the size
    of what goes in: a document's text goes out once for each of its events. With ``group``, an expression
    over events, each group's rows lie in one partition, named by a column ``_part``.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # A parquet count reads file footers only.
    n_documents = documents.count()
    events = table(spark, sf_dir, "events")
    n_events = events.count()
    events = events.withColumn("doc_id", F.col("event_id") % F.lit(n_documents))
    if group is None:
        parts = max(1, -(-n_events // TASK_MESSAGES))
        # Neither side is bounded, so the join is never a broadcast.
        joined = events.repartition(parts, "doc_id").join(documents.repartition(parts, "doc_id").hint("merge"), "doc_id")
    else:
        parts = max(spark.sparkContext.defaultParallelism, -(-n_events // GROUPED_TASK_MESSAGES))
        joined = _texts_in_parts(events, documents, parts, group)
    e = F.col("event_id")
    is_root = _every(4)
    text = F.concat(
        "text",
        F.lit(" #"),
        "event_type",
        F.lit(" #tag_"),
        (F.col("user_id") % 9).cast("string"),
        F.lit(" @user"),
        (F.col("user_id") % 7).cast("string"),
        F.when(_every(5), " https://ex.org/p1").otherwise(""),
    )
    time_format = (
        F.when(_every(3), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(_every(3, 1), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    )
    user = F.col("user_id").cast("string")
    return joined.select(
        *([] if group is None else ["_part"]),
        "event_id",
        "ts",
        F.when(_every(97, 1), "retweet").when(is_root, "tweet").otherwise("reply").alias("type"),
        _unless(_every(89, 5), e.cast("string")).alias("id"),
        F.concat(F.lit("https://ex.org/"), e.cast("string")).alias("url"),
        _unless(_every(107), F.col("event_type")).alias("keyword"),
        F.when(_every(101), "").when(_every(29), WORDLESS).otherwise(text).alias("text"),
        F.when(_every(31, 7), "not a date").otherwise(time_format).alias("created_at"),
        "lang",
        _unless(_every(103), F.concat(F.lit("user"), user)).alias("username"),
        user.alias("user_id"),
        F.concat(F.lit("User "), user).alias("user_name"),
        (~is_root).alias("is_reply"),
        _unless(is_root, (e - 1).cast("string")).alias("in_reply_to_id"),
        F.lit(None).cast("string").alias("in_reply_to_username"),
        _unless(is_root | _every(109), (e - e % 4).cast("string")).alias("root_tweet_id"),
        (e % 5).cast("int").alias("reply_count"),
        (e % 17).cast("int").alias("retweet_count"),
        _unless(_every(13), F.floor("value").cast("int")).alias("like_count"),
        (e % 3).cast("int").alias("quote_count"),
        (e % 1000).cast("int").alias("view_count"),
        (e % 7).cast("int").alias("bookmark_count"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic rows: the fields of :func:`post_fields` as JSON, some of them broken."""
    fields = post_fields(spark, sf_dir)
    message = [c for c in fields.columns if c not in ("event_id", "ts")]
    return fields.select(
        F.encode(message_key(F.col("keyword")), "UTF-8").alias("key"),
        F.encode(F.when(_every(211), NOT_JSON).otherwise(message_value(message)), "UTF-8").alias("value"),
        F.lit("posts").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def api_objects(spark: SparkSession, sf_dir: str, group: Column | None = None) -> DataFrame:
    """The same posts as a search service returns them: ``raw`` JSON, ``keyword``, ``root_tweet_id``.

    Some objects lack the counters and the reply flag, some hold null for a counter, some have no
    author. ``group`` as in :func:`post_fields`.
    """
    fields = post_fields(spark, sf_dir, group)
    author = _unless(
        _every(103),
        F.struct(F.col("user_id").alias("id"), F.col("username").alias("userName"), F.col("user_name").alias("name")),
    )
    always = [
        *[F.col(name).alias(key) for name, key in PLAIN_FIELDS.items()],
        author.alias("author"),
    ]
    sometimes = [
        F.col("is_reply").alias("isReply"),
        *[F.col(name).alias(key) for name, key in COUNTER_FIELDS.items()],
    ]
    nulls_kept = {"ignoreNullFields": "false"}
    raw = F.when(_every(11), F.to_json(F.struct(*always), nulls_kept)).otherwise(
        F.to_json(F.struct(*always, *sometimes), nulls_kept)
    )
    return fields.select(raw.alias("raw"), "keyword", "root_tweet_id", *([] if group is None else ["_part"]))


PAGE_OBJECTS = 20


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of at most ``PAGE_OBJECTS`` objects, and for every fifth a broken copy beside it.

    Whole objects are never shuffled: those of a page are made in one partition.
    """
    number = F.regexp_extract("raw", "ex[.]org/([0-9]+)", 1).cast("bigint")
    pages = (
        api_objects(spark, sf_dir, F.floor(F.col("event_id") / PAGE_OBJECTS))
        .withColumn("page", F.floor(number / PAGE_OBJECTS))
        .groupBy("_part", "keyword", "root_tweet_id", "page")
        .agg(F.concat(F.lit('{"tweets": ['), F.array_join(F.collect_list("raw"), ", "), F.lit('], "has_next_page": true}')).alias("raw"))
    )
    copies = F.when(F.col("page") % 5 == 0, F.array("raw", F.concat(F.lit("{"), "raw"), F.lit('{"tweets": []}'))).otherwise(F.array("raw"))
    return pages.select("keyword", "root_tweet_id", F.explode(copies).alias("raw"))
