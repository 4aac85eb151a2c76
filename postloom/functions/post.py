"""Columns derived from one post."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a tag, a mention and a word break.
HASHTAG = r"#(\w+)"
MENTION = r"@(\w+)"
BLANKS = r"\s+"

# `Tue Dec 10 07:00:30 +0000 2024`: the day name is dropped, Spark has no parser for it.
NAMED_DAY = r"^[A-Z][a-z]{2} ([A-Z][a-z]{2} \d{2} \d{2}:\d{2}:\d{2} [+-]\d{4} \d{4})$"
NAMED_DAY_REST = "MMM dd HH:mm:ss Z yyyy"


def parse_created_at(text: Column, named_day: bool = False) -> Column:
    """Post time from text; null when the text is no time.

    Accepts ``yyyy-MM-ddTHH:mm:ssZ``, ``yyyy-MM-dd HH:mm:ss`` and everything else a cast reads
    (offsets, fractions, bare dates). With the session zone at UTC one ``try_cast`` covers all of
    them; trying patterns one by one would throw and catch an exception per failing row.
    ``named_day`` adds the ``Tue Dec 10 07:00:30 +0000 2024`` form.
    """
    parsed = text.try_cast("timestamp")
    if named_day:
        rest = F.regexp_extract(text, NAMED_DAY, 1)
        parsed = F.coalesce(parsed, F.when(rest != "", F.try_to_timestamp(rest, F.lit(NAMED_DAY_REST))))
    return parsed


def word_count(text: Column) -> Column:
    """Pieces between blanks; a leading or trailing blank adds an empty piece."""
    return F.size(F.split(text, BLANKS))


def has_url(text: Column) -> Column:
    return F.contains(text, F.lit("http://")) | F.contains(text, F.lit("https://"))


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HASHTAG), F.lit(1))


def mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(1))


def engagement(*counters: str) -> Column:
    """Sum of counters with null as 0, as bigint so that four large ints cannot overflow."""
    total = F.lit(0).cast("bigint")
    for name in counters:
        total = total + F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))
    return total
