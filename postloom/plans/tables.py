"""Which table follows from which, and the batch run that writes them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.scoring import BatchScorer, RowScorer
from postloom.plans import gold, nlp, sentiment
from postloom.plans.silver import silver
from postloom.sinks.tables import write_table

TableFunction = Callable[..., DataFrame]


def gold_tables() -> dict[str, tuple[TableFunction, list[str]]]:
    """Tables over silver, in the order they can be built."""
    return {
        "tweet_stats": (gold.tweet_stats, ["silver"]),
        "reply_stats": (gold.reply_stats, ["silver"]),
        "top_users": (gold.top_users, ["silver"]),
        "conversation_threads": (gold.conversation_threads, ["silver"]),
        "trending_hashtags": (gold.trending_hashtags, ["silver"]),
        "hourly_activity": (gold.hourly_activity, ["silver"]),
    }


def text_tables(
    stop_words: Iterable[str],
    row_scorer: RowScorer | None = None,
    make_batch_scorer: Callable[[], BatchScorer] | None = None,
    lexicon: Mapping[str, int] | None = None,
) -> dict[str, tuple[TableFunction, list[str]]]:
    """Cleaned text, and predictions with their trend for every scorer given."""
    words = list(stop_words)
    out: dict[str, tuple[TableFunction, list[str]]] = {
        "nlp_preprocessed": (lambda posts: nlp.nlp_preprocessed(posts, words), ["silver"])
    }
    if row_scorer is not None:
        out["predictions"] = (lambda t: sentiment.predictions_by_row(t, row_scorer), ["nlp_preprocessed"])
        out["sentiment_analytics"] = (sentiment.sentiment_analytics, ["predictions"])
    if make_batch_scorer is not None:
        out["predictions_batch"] = (
            lambda t: sentiment.predictions_by_batch(t, make_batch_scorer),
            ["nlp_preprocessed"],
        )
        out["sentiment_analytics_batch"] = (
            lambda p: sentiment.sentiment_analytics(p, drop_null=True),
            ["predictions_batch"],
        )
    if lexicon is not None:
        out["predictions_lexicon"] = (
            lambda t: sentiment.predictions_by_lexicon(t, lexicon),
            ["nlp_preprocessed"],
        )
        out["sentiment_analytics_lexicon"] = (sentiment.sentiment_analytics, ["predictions_lexicon"])
    return out


# Order in which a table is shown. Stored tables promise none.
def shown_order(table: str) -> list[Column]:
    by_date = [F.desc("created_date")]
    orders = {
        "tweet_stats": [*by_date, F.desc("total_tweets"), F.asc("keyword")],
        "reply_stats": [*by_date, F.desc("total_replies"), F.asc("keyword")],
        "top_users": [F.asc("keyword"), F.asc("user_rank")],
        "conversation_threads": [F.desc("conversation_total_engagement"), F.asc("tweet_id")],
        "trending_hashtags": [*by_date, F.asc("keyword"), F.desc("hashtag_usage_count"), F.asc("hashtag")],
        "hourly_activity": [F.asc("keyword"), F.asc("created_day_of_week"), F.asc("created_hour")],
        "sentiment_analytics": [*by_date, F.asc("keyword"), F.asc("sentiment")],
    }
    return orders[table.removesuffix("_batch").removesuffix("_lexicon")]


def shown(table: str, df: DataFrame) -> DataFrame:
    return df.orderBy(*shown_order(table))


# Layout of the stored tables: folders by day, or by a bucket of the keyword. A keyword itself names no
# folder: it is free text, of which '', '01' and null would not come back as they were.
BUCKET = "keyword_bucket"
BUCKETS = 64
PARTITIONS = {
    "top_users": [BUCKET],
    "hourly_activity": [BUCKET],
    "user_days": ["created_date", BUCKET],
    "hour_days": ["created_date", BUCKET],
}
SORTED_WITHIN = {"silver": ["keyword", "type"]}


def partitions_of(table: str) -> list[str]:
    return PARTITIONS.get(table, ["created_date"])


def keyword_bucket() -> Column:
    return F.pmod(F.xxhash64("keyword"), F.lit(BUCKETS)).cast("int")


def laid_out(table: str, df: DataFrame) -> DataFrame:
    """``df`` with the columns that its stored layout needs."""
    return df.withColumn(BUCKET, keyword_bucket()) if BUCKET in partitions_of(table) else df


def build_silver(spark: SparkSession, bronze_path: str, base_dir: str) -> DataFrame:
    """Silver from stored bronze in one batch; the stream twin is ``streaming.ingest.silver_stream``."""
    return write_table(
        silver(spark.read.parquet(bronze_path)),
        f"{base_dir}/silver",
        partitions_of("silver"),
        sort_by=SORTED_WITHIN["silver"],
    )


def build_tables(
    spark: SparkSession,
    base_dir: str,
    tables: Mapping[str, tuple[TableFunction, list[str]]],
    only: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Write each table from its stored inputs under ``base_dir``; every input is read back, so a
    lost executor costs a table's own tasks, not the chain before it."""
    chosen = set(only) if only is not None else set(tables)
    built = {}
    for name, (function, inputs) in tables.items():
        if name not in chosen:
            continue
        sources = [spark.read.parquet(f"{base_dir}/{source}") for source in inputs]
        table = function(*sources)
        stored = write_table(laid_out(name, table), f"{base_dir}/{name}", partitions_of(name))
        built[name] = stored.select(table.columns)
    return built
