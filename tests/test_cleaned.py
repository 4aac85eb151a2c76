"""Cleaning in Arrow batches says the same as the native expressions."""

from __future__ import annotations

import random

from post_rows import make_posts
from postloom.functions.text import clean_text, cleaned_texts, remove_stop_words
from postloom.plans.nlp import nlp_preprocessed
from pyspark.sql import functions as F

PIECES = [
    "a", "b", "the", "The", "of", "word", "x1y", "A", "Q", " ", "  ", "\t", "\n", "\x0b", "\x1c", "\x1f", "\x01", "\x7f", "\x00", "\x85", "\xa0",
    "\\t", "\\n", "\\u", "\\T", "\\", "#", "@", "#tag", "@me", "_", "__", "://", "http://", "https://", "HTTPS://", "ftp://", "a.b/", "é", "İ", "\u212a",
    "😀", "Σ", "ß", "1", "9", "!", "'", "-", "%", "\u2028", "ſ", "е",
]
STOP = ["the", "of", "word"]


def test_same_as_the_expressions(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(6_000)]
    df = spark.createDataFrame([(t,) for t in [None, "", " ", "A", "\x01a\x01", "#abc_d://x end", *texts]], "text string")
    for stop in (STOP, [], ["", "a"]):
        own = df.select("text", cleaned_texts(F.col("text"), stop).alias("t")).select("text", "t.*")
        both = own.select("*", clean_text(F.col("text")).alias("c")).select("*", remove_stop_words(F.col("c"), stop).alias("s"))
        assert both.filter(~F.col("cleaned_text").eqNullSafe(F.col("c")) | ~F.col("stopword_text").eqNullSafe(F.col("s"))).take(3) == []


def test_posts_are_cleaned_once_without_patterns(spark):
    nlp = nlp_preprocessed(make_posts(spark, [{"text": "the Hill #x"}, {"text": None}]), ["the"])
    assert [(r.cleaned_text, r.stopword_text) for r in nlp.orderBy(F.desc("original_text")).collect()] == [("the hill", "hill"), ("", "")]
    plan = nlp._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("ArrowEvalPython") == 1


def test_texts_cleaned_together_are_as_if_alone(spark):
    """Texts without control characters go many at a time, and borders between them show nowhere."""
    rng = random.Random(5)
    shown = [p for p in PIECES if p == "\t" or p == "\n" or all(c >= " " and c != "\x7f" for c in p)] + ["wordwordword", "on", "http://x.y/z ", "@a_://b"]
    texts = ["".join(rng.choices(shown, k=rng.randrange(14))) for _ in range(6_000)]
    df = spark.createDataFrame([(t,) for t in [None, "", " ", "http://", "#", "_http://", *texts]], "text string").coalesce(1)
    for stop in (STOP, [], ["", "a", "on"], ["wordwordword", "x" * 9]):
        own = df.select("text", cleaned_texts(F.col("text"), stop).alias("t")).select("text", "t.*")
        both = own.select("*", clean_text(F.col("text")).alias("c")).select("*", remove_stop_words(F.col("c"), stop).alias("s"))
        assert both.filter(~F.col("cleaned_text").eqNullSafe(F.col("c")) | ~F.col("stopword_text").eqNullSafe(F.col("s"))).take(3) == []
