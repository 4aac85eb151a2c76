"""Every operator as a query over whole tables of a test data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import clean_text, remove_stop_words
from postloom.operators import bulk, dedupe, keyed, scoring
from postloom.operators.letters import fit_letter_model, with_letter_counts
from postloom.operators.positions import deep_page, positioned
from postloom.operators.quality import POST_DROP_RULES, POST_WARN_RULES, violations
from postloom.plans import gold, sentiment
from postloom.plans.bronze import bronze
from postloom.plans.bucketed import bucketed_threads, write_thread_tables
from postloom.plans.nlp import nlp_preprocessed
from postloom.plans.silver import parsed_posts, silver
from postloom.plans.tables import build_tables, gold_tables, laid_out, shown, shown_order
from postloom.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from postloom.session import STORED, move_files, prepare, remove_dir, shared_dir, splits_of_at_most, stored_bytes
from postloom.sinks.keyed_store import KeyedStore
from postloom.sinks.routing import routed, write_routed
from postloom.sinks.topic import topic_rows
from postloom.sinks.zorder import write_zordered
from postloom.sources.api_objects import flatten_api_objects, flatten_variant_objects, variant_objects
from postloom.sources.samples import LEXICON, STOP_WORDS, api_objects, api_pages, messages, table
from postloom.sources.selection import newest_per_keyword, recent_window
from postloom.sources.tables import read_table_stream
from postloom.sources.topic import read_stored_topic
from postloom.streaming.audit import AuditListener, read_audit
from postloom.streaming.ingest import bronze_stream, silver_stream
from postloom.streaming.latest import KEY, latest_posts_to_store
from postloom.streaming.merging import THREAD_BUCKET, THREAD_BUCKETS, merging_stream
from postloom.streaming.refresh import gold_refresh_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL twins.
WORKLIST_THRESHOLD = 3
CRAWL_DAY = date(2024, 1, 15)
CRAWL_DAYS_BACK = 7
CRAWL_KEYWORDS = ["click", "purchase", "view"]
NEWEST = 100
NEWEST_MANY = 1_500  # above what Catalyst cuts inside map tasks
PAGE_SIZE, PAGE_START = 25, 50
ONE_CUSTOMER = 42
DEEP_PAGE, DEEP_SIZE = 10_000, 5


def comparable(df: DataFrame) -> DataFrame:
    """Columns in types that every engine prints alike; columns of the moment of the run left out."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.name in ("ingestion_timestamp", "prediction_timestamp"):
            continue
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, " ")
        columns.append(column.alias(field.name))
    return df.select(columns)


def in_order(name: str, query: Query) -> Query:
    """A query's rows with their positions in the order that the table ``name`` is shown in."""
    return lambda spark, sf_dir: positioned(query(spark, sf_dir), shown_order(name))


def silver_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze(messages(spark, sf_dir)))


def nlp_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nlp_preprocessed(silver_posts(spark, sf_dir), STOP_WORDS)


# --- posts ------------------------------------------------------------------------------------


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations(parsed_posts(bronze(messages(spark, sf_dir))), POST_DROP_RULES, POST_WARN_RULES)


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.conversation_threads(silver_posts(spark, sf_dir))


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations table as threads: turn 0 is the root, later turns answer it."""
    turns = table(spark, sf_dir, "conversations")
    is_root = F.col("turn") == 0
    conv = F.col("conv_id").cast("string")
    size = F.length("text")
    posts = turns.select(
        F.when(is_root, "tweet").otherwise("reply").alias("type"),
        F.concat(conv, F.when(is_root, "").otherwise(F.concat(F.lit("-"), F.col("turn").cast("string")))).alias("tweet_id"),
        F.when(~is_root, conv).alias("root_tweet_id"),
        F.col("role").alias("keyword"),
        F.col("role").alias("username"),
        "text",
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("date").alias("created_date"),
        size.alias("like_count"),
        F.lit(0).alias("retweet_count"),
        F.lit(0).alias("reply_count"),
        size.cast("bigint").alias("total_engagement"),
    )
    return gold.conversation_threads(posts).drop("created_at", "created_date")


def gold_query(name: str, function: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: shown(name, function(silver_posts(spark, sf_dir)))


def repeated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a second crawl that met every post again with one like more."""
    crawls = F.explode(F.array(F.lit(0), F.lit(1))).alias("_crawl")
    return (
        silver_posts(spark, sf_dir)
        .select("*", crawls)
        .withColumns(
            {
                "kafka_timestamp": F.col("kafka_timestamp") + F.col("_crawl") * F.expr("INTERVAL 40 DAYS"),
                "like_count": F.col("like_count") + F.col("_crawl"),
            }
        )
    )


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["keyword", "tweet_id", "type", "text", "like_count", "kafka_timestamp", "kafka_offset"]
    posts = repeated_posts(spark, sf_dir).select(*columns, "kafka_partition")
    return dedupe.dedupe_stored_posts(posts).select(columns)


def hot_posts_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with replies to fetch; a post is fetched once one of its replies is known under its keyword."""
    posts = silver_posts(spark, sf_dir)
    fetched = posts.filter("type = 'reply' AND root_tweet_id IS NOT NULL").select(
        "keyword", F.col("root_tweet_id").alias("tweet_id")
    )
    return dedupe.reply_worklist(posts, fetched, WORKLIST_THRESHOLD).select("keyword", "tweet_id", "reply_count")


def orphan_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = silver_posts(spark, sf_dir)
    return dedupe.orphan_replies(posts).select("keyword", "tweet_id", "root_tweet_id", "username")


def recent_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = recent_window(silver_posts(spark, sf_dir), CRAWL_DAY, CRAWL_DAYS_BACK, CRAWL_KEYWORDS)
    return posts.select("keyword", "tweet_id", "type", "text", "created_at", "created_date")


def newest_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = newest_per_keyword(silver_posts(spark, sf_dir), NEWEST)
    return posts.select("keyword", "tweet_id", "type", "created_at", "text")


def normalise_api_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_api_objects(api_objects(spark, sf_dir))


def page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same objects from result pages, as variants."""
    return flatten_variant_objects(variant_objects(api_pages(spark, sf_dir)))


# All fields of a message; times travel as text.
TOPIC_FIELDS = [
    "type", "tweet_id", "tweet_url", "keyword", "text", "created_at", "language", "username", "user_id", "user_name", "is_reply",
    "in_reply_to_id", "in_reply_to_username", "root_tweet_id", "reply_count", "retweet_count", "like_count", "quote_count",
    "view_count", "bookmark_count",
]


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = silver_posts(spark, sf_dir)
    return topic_rows(posts.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")), TOPIC_FIELDS)


# Messages of one task that writes indexes, on average: it sorts whole posts by index, in memory.
ROUTED_TASK_MESSAGES = 60_000


def index_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole posts written to a folder for each index, and read again."""
    path = shared_dir(spark, "indexes")
    posts = silver_posts(spark, sf_dir).select("tweet_id", "keyword", "text", "kafka_offset", "created_date")
    tasks = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "events").count() // ROUTED_TASK_MESSAGES))
    write_routed(posts.coalesce(tasks), path)
    return spark.read.schema(routed(posts).schema).parquet(path)


# --- text and sentiment -----------------------------------------------------------------------


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned_text"))


def stopword_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_documents(spark, sf_dir)
    return cleaned.select("doc_id", remove_stop_words(F.col("cleaned_text"), STOP_WORDS).alias("stopword_text"))


def predictions_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.predictions_by_lexicon(nlp_posts(spark, sf_dir), LEXICON)


def predictions_row_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.predictions_by_row(nlp_posts(spark, sf_dir), scoring.lexicon_row_scorer(LEXICON))


def predictions_batch_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.predictions_by_batch(nlp_posts(spark, sf_dir), scoring.lexicon_batch_scorer(LEXICON))


def predictions_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by a model fitted here to all labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = fit_letter_model(docs.join(labels, "doc_id"), "text", "quality")
    scored = scoring.score_model(with_letter_counts(docs, "text"), model, {0.0: "poor", 1.0: "good"}, "text", "label")
    return scored.select("doc_id", "label")


def sentiment_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown("sentiment_analytics", sentiment.sentiment_analytics(predictions_lexicon(spark, sf_dir)))


def sentiment_analytics_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = sentiment.sentiment_analytics(predictions_lexicon(spark, sf_dir), drop_null=True)
    return shown("sentiment_analytics", trend)


# --- keyed tables -----------------------------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )


def orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes to customers: many per customer, some without a name."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.when(status != "P", F.col("o_orderpriority")).alias("name"),
        F.when(status != "F", F.col("o_totalprice")).alias("balance"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderpriority").startswith("1"), "create")
        .when(F.col("o_orderpriority").startswith("2"), "index")
        .when(F.col("o_orderpriority").startswith("5"), "delete")
        .otherwise("update")
        .alias("op"),
    )


def spread_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as customers under every second key: some known, some new."""
    return products(spark, sf_dir).select(
        (F.col("id") * 2).alias("id"), "name", F.col("price").alias("balance"), F.col("id").alias("seq")
    )


def faulty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with some keys missing."""
    return spread_products(spark, sf_dir).withColumn("id", F.when(F.col("seq") % 50 != 7, F.col("id")))


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with missing keys, applied twice."""
    once = keyed.insert_if_absent(customers(spark, sf_dir), faulty_products(spark, sf_dir), "id", [F.asc("seq")])
    return keyed.insert_if_absent(once, faulty_products(spark, sf_dir), "id", [F.asc("seq")])


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with missing keys, applied twice."""
    once = keyed.upsert(customers(spark, sf_dir), faulty_products(spark, sf_dir), "id", [F.desc("seq")])
    return keyed.upsert(once, faulty_products(spark, sf_dir), "id", [F.desc("seq")])


def faulty_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes, some without a key, without a sequence number, or with the one before them."""
    number = F.col("seq")
    return orders_by_customer(spark, sf_dir).select(
        F.when(number % 103 != 9, F.col("id")).alias("id"),
        "name",
        "balance",
        F.when(number % 97 == 5, F.lit(None)).when(number % 101 == 7, number - 1).otherwise(number).alias("seq"),
        "op",
    )


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with many rows per key: the newest order of each customer becomes its row."""
    suppliers = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 3).alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return keyed.upsert(suppliers, orders_by_customer(spark, sf_dir), "id", [F.desc("seq")])


def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = faulty_changes(spark, sf_dir).withColumn("id", F.col("id") * 2)
    return keyed.partial_update(customers(spark, sf_dir), changes, "id", ["name", "balance"], "seq")


def partial_update_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = faulty_changes(spark, sf_dir).withColumn("id", F.col("id") * 2)
    return keyed.partial_update_rejects(customers(spark, sf_dir), changes, "id", "seq")


def supplier_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 20).alias("id"))


def delete_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.delete_by_id(customers(spark, sf_dir), supplier_ids(spark, sf_dir), "id")


def bulk_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = faulty_changes(spark, sf_dir)
    return bulk.apply_bulk(customers(spark, sf_dir), actions, "id", ["name", "balance"])


def bulk_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk.bulk_rejects(customers(spark, sf_dir), faulty_changes(spark, sf_dir), "id")


def bulk_log_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written log of JSON lines for two tables: orders change customers, parts change products."""
    bodies = [("name", "string"), ("balance", "double"), ("price", "double")]
    on_customers = orders_by_customer(spark, sf_dir).select(
        (F.col("seq") * 4).alias("line"), "op", F.lit("customers").alias("_index"), "id", "name", "balance", F.lit(None).cast("double").alias("price")
    )
    on_products = spread_products(spark, sf_dir).select(
        (F.col("seq") * 4 + 2).alias("line"),
        F.when(F.col("seq") % 3 == 0, "delete").when(F.col("seq") % 3 == 1, "update").otherwise("index").alias("op"),
        F.lit("products").alias("_index"),
        "id",
        "name",
        F.lit(None).cast("double").alias("balance"),
        F.col("balance").alias("price"),
    )
    actions = on_customers.unionByName(on_products)
    head = F.to_json(F.create_map(F.col("op"), F.struct("_index", F.col("id").cast("string").alias("_id"))))
    fields = F.struct(*[name for name, _ in bodies])
    body = F.when(F.col("op") == "update", F.to_json(F.struct(fields.alias("doc")))).otherwise(F.to_json(fields))
    lines = actions.select(F.explode(F.array(F.struct("line", head.alias("value")), F.struct((F.col("line") + 1).alias("line"), body.alias("value")))).alias("l"))
    lines = lines.select("l.line", "l.value").filter("value IS NOT NULL")
    parsed = bulk.parse_bulk_log(lines, ", ".join(f"{name} {kind}" for name, kind in bodies)).withColumn("id", F.col("id").cast("bigint"))
    tables = {"customers": customers(spark, sf_dir), "products": products(spark, sf_dir)}
    after = bulk.apply_bulk_log(tables, parsed, {"customers": ["name", "balance"], "products": ["name", "price"]})
    found = [t.withColumn("_index", F.lit(name)) for name, t in after.items()]
    return found[0].unionByName(found[1], allowMissingColumns=True).select("_index", "id", "name", "balance", "price")


def get_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.get(customers(spark, sf_dir), "id", ONE_CUSTOMER)


def get_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.get(customers(spark, sf_dir), "id", ONE_CUSTOMER, source_only=True)


def exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"))
    answered = keyed.exists(customers(spark, sf_dir), asked, "id")
    return answered.groupBy("id", "exists").agg(F.count("*").alias("asked"))


def multi_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"))
    return keyed.multi_get(customers(spark, sf_dir), asked, "id")


def multi_get_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    wanted = lines.select(F.lit("products").alias("_index"), F.col("l_suppkey").alias("id")).unionByName(
        lines.select(F.lit("customers").alias("_index"), F.col("l_partkey").alias("id"))
    )
    tables = {"customers": customers(spark, sf_dir), "products": products(spark, sf_dir)}
    return keyed.multi_get_tables(tables, wanted)


def match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir)


def paged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.paged_search(products(spark, sf_dir), "id", PAGE_SIZE, PAGE_START, [F.asc("name")])


def page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind the cheapest product."""
    found = products(spark, sf_dir)
    first = found.orderBy("price", "id").head()
    return keyed.page_after(found, "id", PAGE_SIZE, ["price"], [first["price"], first["id"]])


def newest_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = newest_per_keyword(silver_posts(spark, sf_dir), NEWEST_MANY)
    return posts.select("keyword", "tweet_id", "type", "created_at", "kafka_offset")


def deep_paged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far behind the start of all order lines, dearest first."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return deep_page(spark, lines, order, DEEP_SIZE, DEEP_PAGE * DEEP_SIZE)


def sorted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.sorted_search(products(spark, sf_dir), "id", [F.desc("price")])


def explode_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as documents whose items are parcels of at most ten units."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").cast("string").alias("product"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("int").alias("units"),
    )
    parcels = F.transform(
        F.sequence(F.lit(0), F.ceil(F.col("units") / 10).cast("int") - 1),
        lambda i: F.struct(
            F.col("product").alias("product_id"),
            F.col("price").alias("price"),
            F.least(F.lit(10), F.col("units") - i * 10).cast("string").alias("quantity"),
        ),
    )
    return keyed.explode_items(lines.select("id", parcels.alias("items")))


# --- streams ----------------------------------------------------------------------------------


# Messages of one task of the ingest streams on average: silver sorts a task's posts by day, in memory.
INGEST_TASK_MESSAGES = 100_000


def _run_ingest(spark: SparkSession, sf_dir: str) -> str:
    """Messages through the bronze and silver streams; returns the folder of the tables.

    The topic and bronze are removed once the next table holds their rows.
    """
    base = shared_dir(spark, "ingest")
    messages(spark, sf_dir).write.option("compression", STORED).parquet(f"{base}/topic")
    sent = spark.read.parquet(f"{base}/topic").count()
    with splits_of_at_most(spark, stored_bytes(spark, f"{base}/topic") * INGEST_TASK_MESSAGES // max(1, sent)):
        topic = read_stored_topic(spark, f"{base}/topic")
        bronze_stream(topic, f"{base}/bronze", f"{base}/_bronze", available_now=True).awaitTermination()
        remove_dir(spark, f"{base}/topic")
        rows = read_table_stream(spark, f"{base}/bronze", BRONZE_SCHEMA)
        silver_stream(rows, f"{base}/silver", f"{base}/_silver", available_now=True).awaitTermination()
    remove_dir(spark, f"{base}/bronze")
    return base


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_ingest(spark, sf_dir)
    stored = spark.read.schema(SILVER_SCHEMA).parquet(f"{base}/silver")
    return stored.select(silver_posts(spark, sf_dir).columns)


REFRESH_BATCHES = 2  # every batch touches all days, so their number must not grow with the posts


def _silver_batches(spark: SparkSession, base: str) -> DataFrame:
    """The stored silver rows as a stream of :data:`REFRESH_BATCHES` micro-batches of equally many files."""
    files = len(spark.read.schema(SILVER_SCHEMA).parquet(f"{base}/silver").inputFiles())
    step = max(1, -(-files // REFRESH_BATCHES))
    return read_table_stream(spark, f"{base}/silver", SILVER_SCHEMA, files_per_trigger=step)


def refreshed(name: str, function: Callable[[DataFrame], DataFrame]) -> Query:
    """A stored table after several micro-batches, each of which refreshes what it touches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _run_ingest(spark, sf_dir)
        rows = _silver_batches(spark, base)
        gold_refresh_stream(
            rows,
            f"{base}/silver",
            f"{base}/gold",
            f"{base}/_gold",
            available_now=True,
            threads=name == "conversation_threads",
        ).awaitTermination()
        remove_dir(spark, f"{base}/silver")
        declared = function(spark.createDataFrame([], SILVER_SCHEMA))
        stored = spark.read.schema(laid_out(name, declared).schema).parquet(f"{base}/gold/{name}")
        return stored.select(declared.columns)

    return query


def merged(name: str, function: Callable[[DataFrame], DataFrame]) -> Query:
    """A stored table that several micro-batches were merged into, without reading a post twice."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = _run_ingest(spark, sf_dir)
        rows = _silver_batches(spark, base)
        merging_stream(rows, f"{base}/gold", f"{base}/_merging", [name], available_now=True).awaitTermination()
        remove_dir(spark, f"{base}/silver")
        declared = function(spark.createDataFrame([], SILVER_SCHEMA))
        layout = declared.withColumn(THREAD_BUCKET, F.lit(0)) if name == "threads" else declared
        return spark.read.schema(layout.schema).parquet(f"{base}/gold/{name}").select(declared.columns)

    return query


AUDIT_BATCHES = 4


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of a silver stream in four batches, dealt by message number.

    Messages are made and written once; a batch's files go into bronze when it is their turn, and
    leave it when silver holds their rows.
    """
    base = shared_dir(spark, "audit")
    sent = bronze(messages(spark, sf_dir)).withColumn("turn", F.col("kafka_offset") % AUDIT_BATCHES).filter("turn >= 0")
    sent.write.option("compression", STORED).partitionBy("turn").parquet(f"{base}/sent")
    split = stored_bytes(spark, f"{base}/sent") * INGEST_TASK_MESSAGES // max(1, spark.read.parquet(f"{base}/sent").count())
    listener = AuditListener(spark, f"{base}/audit")
    spark.streams.addListener(listener)
    try:
        for number in range(AUDIT_BATCHES):  # the stream goes on with what came since it ended, as one batch
            if not move_files(spark, f"{base}/sent/turn={number}", f"{base}/bronze", f"part-{number}-"):
                spark.createDataFrame([], BRONZE_SCHEMA).write.mode("append").parquet(f"{base}/bronze")  # a batch of no rows
            rows = read_table_stream(spark, f"{base}/bronze", BRONZE_SCHEMA)
            with splits_of_at_most(spark, split):
                query = silver_stream(rows, f"{base}/silver", f"{base}/_silver", available_now=True)
                query.awaitTermination()
            if not listener.wait_for(query):
                raise TimeoutError("the stream's audit rows are not complete")
            remove_dir(spark, f"{base}/bronze")
    finally:
        spark.streams.removeListener(listener)
    remove_dir(spark, f"{base}/silver")
    return read_audit(spark, f"{base}/audit").drop("query", "started")


DEDUPE_FILES = 6
DEDUPE_MINUTES = 200 * 24 * 60  # longer than the crawls lie apart, in whatever order files come


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last copy of every post, kept by a stream in several batches."""
    base = shared_dir(spark, "dedupe")
    repeated_posts(spark, sf_dir).drop("_crawl").repartition(DEDUPE_FILES).write.parquet(f"{base}/posts")
    rows = read_table_stream(spark, f"{base}/posts", SILVER_SCHEMA, files_per_trigger=2)
    store = KeyedStore(spark, f"{base}/store", f"{SILVER_SCHEMA}, {KEY} string", KEY)
    latest_posts_to_store(spark, rows, store, f"{base}/_dedupe", DEDUPE_MINUTES, available_now=True).awaitTermination()
    return store.read().select("keyword", "tweet_id", "type", "text", "like_count", "kafka_timestamp", "kafka_offset")


ZORDER_FILES = 16


def zordered_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week of two keywords out of posts written along a z-curve over day and keyword."""
    posts = silver_posts(spark, sf_dir).select("keyword", "tweet_id", "type", "text", "created_at", "created_date")
    base = shared_dir(spark, "zorder")
    written = write_zordered(posts, f"{base}/posts", ["created_date", "keyword"], ZORDER_FILES)
    return recent_window(written, CRAWL_DAY, CRAWL_DAYS_BACK, CRAWL_KEYWORDS)


def threads_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads from tables bucketed by root, joined where they lie."""
    base = shared_dir(spark, "bucketed")
    return bucketed_threads(*write_thread_tables(silver_posts(spark, sf_dir), f"threads_{uuid.uuid4().hex}", base, THREAD_BUCKETS))


KEYED_BATCHES = 3


def keyed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of orders upserted by customer, the second one twice and then compacted."""
    changes = orders_by_customer(spark, sf_dir).select("id", "name", "balance", "seq")
    store = KeyedStore(spark, f"{shared_dir(spark, 'keyed')}/store", "id bigint, name string, balance double, seq bigint", "id")
    for number in range(KEYED_BATCHES):
        batch = changes.filter(F.col("seq") % KEYED_BATCHES == number)
        store.upsert(batch, number, [F.desc("seq")])
        if number == 1:
            store.upsert(batch, number, [F.desc("seq")])
            store.compact()
    return store.read().select("id", "name", "balance", "seq")


def stored_top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings written and read again, for keywords that are no folder names: empty, digits, and none."""
    odd = F.when(F.col("kafka_offset") % 7 == 1, "").when(F.col("kafka_offset") % 7 == 2, "01").when(F.col("kafka_offset") % 7 == 3, "1")
    posts = silver_posts(spark, sf_dir).withColumn("keyword", F.coalesce(odd, "keyword"))
    base = shared_dir(spark, "stored")
    posts.write.parquet(f"{base}/silver")
    return build_tables(spark, base, {"top_users": gold_tables()["top_users"]})["top_users"]


QUERIES: dict[str, Query] = {
    "threads": threads,
    "silver": silver_posts,
    "dq_violations": dq_violations,
    "tweet_stats": gold_query("tweet_stats", gold.tweet_stats),
    "reply_stats": gold_query("reply_stats", gold.reply_stats),
    "top_users": gold_query("top_users", gold.top_users),
    "threads_ranked": gold_query("conversation_threads", gold.conversation_threads),
    "conversation_turns": conversation_turns,
    "trending_hashtags": gold_query("trending_hashtags", gold.trending_hashtags),
    "hourly_activity": gold_query("hourly_activity", gold.hourly_activity),
    "nlp_preprocessed": nlp_posts,
    "clean_documents": clean_documents,
    "stopword_documents": stopword_documents,
    "predictions_lexicon": predictions_lexicon,
    "predictions_row_udf": predictions_row_udf,
    "predictions_batch_udf": predictions_batch_udf,
    "sentiment_analytics": sentiment_analytics,
    "sentiment_analytics_nonnull": sentiment_analytics_nonnull,
    "dedupe_latest": dedupe_latest,
    "hot_posts_worklist": hot_posts_worklist,
    "orphan_replies": orphan_replies,
    "recent_window": recent_posts,
    "newest_per_keyword": newest_posts,
    "newest_many_per_keyword": newest_many,
    "normalise_api_json": normalise_api_json,
    "topic_rows": topic_messages,
    "index_routing": index_routing,
    "insert_if_absent": insert_if_absent,
    "upsert": upsert,
    "upsert_latest": upsert_latest,
    "partial_update": partial_update,
    "partial_update_rejects": partial_update_rejects,
    "delete_by_id": delete_by_id,
    "bulk_actions": bulk_actions,
    "bulk_rejects": bulk_rejects,
    "bulk_log_tables": bulk_log_tables,
    "get_by_id": get_by_id,
    "get_source": get_source,
    "exists": exists,
    "multi_get": multi_get,
    "multi_get_tables": multi_get_tables,
    "match_all": match_all,
    "paged_search": paged_search,
    "page_after": page_after,
    "deep_paged_search": deep_paged_search,
    "sorted_search": sorted_search,
    "explode_items": explode_items,
    "stream_silver": stream_silver,
    "stream_gold_refresh": refreshed("tweet_stats", gold.tweet_stats),
    "refreshed_threads": refreshed("conversation_threads", gold.conversation_threads),
    "refreshed_top_users": refreshed("top_users", gold.top_users),
    "refreshed_hourly": refreshed("hourly_activity", gold.hourly_activity),
    "refreshed_reply_stats": refreshed("reply_stats", gold.reply_stats),
    "refreshed_hashtags": refreshed("trending_hashtags", gold.trending_hashtags),
    "stored_top_users": stored_top_users,
    "zordered_posts": zordered_posts,
    "threads_bucketed": threads_bucketed,
    "page_objects": page_objects,
    "predictions_model": predictions_model,
    "keyed_store": keyed_store,
    "ingest_audit": ingest_audit,
    "stream_dedupe": stream_dedupe,
    "merged_tweet_stats": merged("tweet_stats", gold.tweet_stats),
    "merged_reply_stats": merged("reply_stats", gold.reply_stats),
    "merged_hashtags": merged("trending_hashtags", gold.trending_hashtags),
    "merged_threads": merged("threads", gold.conversation_threads),
    "ordered_tweet_stats": in_order("tweet_stats", lambda spark, sf_dir: gold.tweet_stats(silver_posts(spark, sf_dir))),
    "ordered_reply_stats": in_order("reply_stats", lambda spark, sf_dir: gold.reply_stats(silver_posts(spark, sf_dir))),
    "ordered_top_users": in_order("top_users", lambda spark, sf_dir: gold.top_users(silver_posts(spark, sf_dir))),
    "ordered_threads": in_order("conversation_threads", threads),
    "ordered_hashtags": in_order("trending_hashtags", lambda spark, sf_dir: gold.trending_hashtags(silver_posts(spark, sf_dir))),
    "ordered_hourly": in_order("hourly_activity", lambda spark, sf_dir: gold.hourly_activity(silver_posts(spark, sf_dir))),
    "ordered_sentiment": in_order("sentiment_analytics", sentiment_analytics),
    "ordered_sentiment_nonnull": in_order("sentiment_analytics_batch", sentiment_analytics_nonnull),
}


def registered() -> dict[str, Query]:
    """The queries with the session prepared and the result columns comparable."""

    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(prepare(spark), sf_dir))

    return {name: wrap(query) for name, query in QUERIES.items()}
