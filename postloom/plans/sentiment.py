"""Sentiment of posts and its trend."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.functions.sentiment import label_score, strip_quotes
from postloom.operators.scoring import BatchScorer, RowScorer, score_batches, score_lexicon, score_rows

PREDICTION_COLUMNS = [
    "tweet_id",
    "keyword",
    "username",
    "created_at",
    "created_date",
    "original_text",
    "cleaned_text",
    "stopword_text",
    "sentiment",
    "prediction_timestamp",
    "total_engagement",
    "like_count",
]


def _predictions(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction_timestamp", F.current_timestamp()).select(PREDICTION_COLUMNS)


def predictions_by_row(nlp: DataFrame, scorer: RowScorer) -> DataFrame:
    """Predictions by one call per post; quotes around labels are removed."""
    scored = score_rows(nlp, scorer, "stopword_text", "sentiment")
    return _predictions(scored.withColumn("sentiment", strip_quotes(F.col("sentiment"))))


def predictions_by_batch(nlp: DataFrame, make_scorer: Callable[[], BatchScorer]) -> DataFrame:
    """Predictions by one call per batch of posts, labels as returned."""
    return _predictions(score_batches(nlp, make_scorer, "stopword_text", "sentiment"))


def predictions_by_lexicon(nlp: DataFrame, lexicon: Mapping[str, int]) -> DataFrame:
    """Predictions by word weights, without a Python worker."""
    return _predictions(score_lexicon(nlp, lexicon, "stopword_text", "sentiment"))


def sentiment_analytics(predictions: DataFrame, drop_null: bool = False) -> DataFrame:
    """Daily posts, engagement and likes per keyword and label. ``drop_null`` leaves out posts
    without a label, else they form their own group with score 0."""
    if drop_null:
        predictions = predictions.filter(F.col("sentiment").isNotNull())
    return (
        predictions.groupBy("created_date", "keyword", "sentiment")
        .agg(
            F.count("*").alias("post_count"),
            F.avg("total_engagement").alias("avg_engagement"),
            F.sum("like_count").alias("total_likes"),
        )
        .withColumn("sentiment_score", label_score(F.col("sentiment")))
    )
