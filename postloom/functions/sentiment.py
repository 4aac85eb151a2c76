"""Sentiment labels as expressions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label names and their score.
POSITIVE, NEUTRAL, NEGATIVE = "positive", "neutral", "negative"


def strip_quotes(raw: Column) -> Column:
    """A label as some scorers return it, without its double quotes."""
    return F.replace(raw, F.lit('"'), F.lit(""))


def label_score(label: Column) -> Column:
    """positive 1, negative -1, everything else (also null) 0."""
    return F.when(label == POSITIVE, 1).when(label == NEGATIVE, -1).otherwise(0)


def lexicon_sum(text: Column, lexicon: Mapping[str, int]) -> Column:
    """Sum of the word weights of blank-separated text, in one pass over its words.

    Words of one weight share one membership test, so the cost per word of text is one hash
    look-up per distinct weight, not per lexicon entry.
    """
    by_weight: dict[int, list[str]] = defaultdict(list)
    for word, weight in lexicon.items():
        by_weight[weight].append(word)

    def weight_of(word: Column) -> Column:
        found = F.lit(0)
        for weight, members in sorted(by_weight.items()):
            found = F.when(word.isin(members), F.lit(weight)).otherwise(found)
        return found

    return F.aggregate(F.split(text, " "), F.lit(0), lambda total, word: total + weight_of(word))


def lexicon_label(text: Column, lexicon: Mapping[str, int]) -> Column:
    """Label by the sign of the word sum; null for null or empty text."""
    # Bound to a variable, the sum is computed once for both comparisons.
    label = F.transform(
        F.array(lexicon_sum(text, lexicon)),
        lambda total: F.when(total > 0, POSITIVE).when(total < 0, NEGATIVE).otherwise(NEUTRAL),
    )
    return F.when(text != "", F.get(label, F.lit(0)))
