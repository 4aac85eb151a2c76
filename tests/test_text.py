from __future__ import annotations

import time

import pytest
from postloom.functions.post import hashtags, has_url, mentions, parse_created_at, word_count
from postloom.functions.text import clean_text, remove_stop_words
from pyspark.sql import functions as F


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "text string").select(expression(F.col("text"))).first()[0]


@pytest.mark.parametrize(
    ("text", "cleaned"),
    [
        ("Halo @Bob_x lihat https://t.co/ab1 #Promo2024!!", "halo  lihat"),
        ("Saya a b c 100% café 😀 x", "saya    caf "),
        (r"line1\nline2\tC:\users", "line line csers"),
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("A", ""),
        ("don't stop", "dont stop"),
        ("see http:// now", "see now"),
        ("#abc_d://x end", "end"),
        ("éab://x y2z", "yz"),
        ("xhttps:// go", " go"),
        ("tab\tand\nnewline\x1cgroup", "tab and newline group"),
        ("mail me@home.example ok", "mail me example ok"),
        ("http://a.b/#c d@e ff", " ff"),
    ],
)
def test_clean_text(spark, text, cleaned):
    assert one(spark, text, clean_text) == cleaned


def test_long_unbroken_words_take_linear_time(spark):
    text = "a" * 400_000 + " http://x y"
    start = time.time()
    assert one(spark, text, clean_text) == "a" * 400_000 + " "
    assert time.time() - start < 20


def test_stop_words_keep_other_blanks(spark):
    assert one(spark, "the cat  of the hill", lambda c: remove_stop_words(c, ["the", "of"])) == "cat  hill"
    assert one(spark, None, lambda c: remove_stop_words(c, ["the"])) == ""
    assert one(spark, "", lambda c: remove_stop_words(c, ["the"])) == ""
    assert one(spark, "a b", lambda c: remove_stop_words(c, [])) == "a b"
    many = [f"w{i}" for i in range(500)]
    assert one(spark, "w7 x w499 y w500", lambda c: remove_stop_words(c, many)) == "x y w500"


def test_tags_mentions_words(spark):
    text = "Halo #Promo_1 #a @Bob_x  http://t.co/1 #"
    assert one(spark, text, hashtags) == ["Promo_1", "a"]
    assert one(spark, text, mentions) == ["Bob_x"]
    assert one(spark, text, word_count) == 6
    assert one(spark, text, has_url) is True
    assert one(spark, "café #café @é", hashtags) == ["caf"]
    assert one(spark, "café #café @é", mentions) == []
    assert one(spark, "  lead", word_count) == 2


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-11-30T12:00:00Z", "2025-11-30 12:00:00"),
        ("2025-11-30 12:00:00", "2025-11-30 12:00:00"),
        ("2025-11-30T12:00:00+07:00", "2025-11-30 05:00:00"),
        ("2025-11-30", "2025-11-30 00:00:00"),
        ("2025-02-30T00:00:00Z", None),
        ("not a date", None),
        ("", None),
        (None, None),
        ("Tue Dec 10 07:00:30 +0000 2024", None),
    ],
)
def test_created_at(spark, text, expected):
    assert one(spark, text, lambda c: parse_created_at(c).cast("string")) == expected
    # The single cast stands for trying the patterns one after the other.
    by_pattern = one(
        spark,
        text,
        lambda c: F.coalesce(
            F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")),
            F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
            F.try_to_timestamp(c),
        ).cast("string"),
    )
    assert by_pattern == expected


def test_created_at_with_day_name(spark):
    def parse(text):
        return one(spark, text, lambda c: parse_created_at(c, named_day=True).cast("string"))

    assert parse("Tue Dec 10 07:00:30 +0000 2024") == "2024-12-10 07:00:30"
    assert parse("Tue Dec 10 07:00:30 +0700 2024") == "2024-12-10 00:00:30"
    assert parse("2025-11-30T12:00:00Z") == "2025-11-30 12:00:00"
    assert parse("no") is None


def test_a_link_ends_at_every_blank(spark):
    df = spark.createDataFrame([("see http://ab\x1ccd end",)], "t string")
    assert df.select(clean_text(F.col("t")).alias("c")).head().c == "see cd end"
