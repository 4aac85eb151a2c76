"""Label texts with a scorer the user supplies.

A scorer is user code: a remote client, a fitted model or a lexicon. It runs inside tasks, where
Spark put the rows; nothing is gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import sentiment

RowScorer = Callable[[str], str | None]
BatchScorer = Callable[[Sequence[str]], Sequence[str | None]]


def score_rows(
    df: DataFrame, scorer: RowScorer | Callable[[], RowScorer], text: str, label: str, error: str | None = None, factory: bool = False
) -> DataFrame:
    """One call per row. Empty text gives null, and so does a call that fails.

    With ``factory``, ``scorer`` makes the scorer, once per task. ``error`` names a column for what a
    failed call said (null where none failed), so that failures can be counted.
    """

    def scored(batches: Iterator[pd.Series]) -> Iterator[tuple[list[str | None], list[str | None]]]:
        score = scorer() if factory else scorer
        for texts in batches:
            labels: list[str | None] = [None] * len(texts)
            errors: list[str | None] = [None] * len(texts)
            for place, value in enumerate(texts):
                try:
                    labels[place] = score(value) if value else None
                except Exception as failure:
                    errors[place] = repr(failure)
            yield labels, errors

    if error is None:

        @F.pandas_udf("string")
        def label_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for labels, _ in scored(batches):
                yield pd.Series(labels, dtype=object)

        return df.withColumn(label, label_of(text))

    @F.pandas_udf("label string, error string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for labels, errors in scored(batches):
            yield pd.DataFrame({"label": labels, "error": errors}, dtype=object)

    return _labelled(df, call(text), label, error)


def score_batches(
    df: DataFrame, make_scorer: Callable[[], BatchScorer], text: str, label: str, error: str | None = None
) -> DataFrame:
    """One call per Arrow batch, with a scorer built once per task.

    Null and blank texts are not sent and give null; a batch whose call fails is null as a whole. A
    call that returns more or fewer labels than it was sent texts has failed: labels can't be told
    apart then. ``error`` names a column for what a failed call said.
    """

    @F.pandas_udf("label string, error string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for texts in batches:
            out = pd.DataFrame({"label": None, "error": None}, index=texts.index, dtype=object)
            sent = texts[texts.notna() & (texts.str.strip() != "")]
            if len(sent):
                try:
                    found = list(scorer(sent.tolist()))
                    if len(found) != len(sent):
                        raise ValueError(f"{len(found)} labels for {len(sent)} texts")
                    out.loc[sent.index, "label"] = found
                except Exception as failure:
                    out.loc[sent.index, "error"] = repr(failure)
            yield out

    return _labelled(df, call(text), label, error)


def _labelled(df: DataFrame, scored: Column, label: str, error: str | None) -> DataFrame:
    out = df.withColumn("_scored", scored).withColumn(label, F.col("_scored.label"))
    if error:
        out = out.withColumn(error, F.col("_scored.error"))
    return out.drop("_scored")


def score_lexicon(df: DataFrame, lexicon: Mapping[str, int], text: str, label: str) -> DataFrame:
    """Sign of the summed word weights, as a native expression.

    Each text is cleaned and scored once: a filter on the label cannot move below a generator, as it
    would below a projection, where it would clean and score the text again.
    """
    keep = [c for c in df.columns if c != label]
    scored = F.struct(sentiment.lexicon_label(F.col(text), lexicon).alias(label))
    return df.select(*keep, F.inline(F.array(scored)))


def score_model(
    df: DataFrame, model: PipelineModel, labels: Mapping[float, str], text: str, label: str
) -> DataFrame:
    """Prediction of a fitted Spark ML model, its numbers named by ``labels``; empty text gives null."""
    keep = df.columns
    named = F.lit(None).cast("string")
    for number, name in labels.items():
        named = F.when(F.col("prediction") == number, name).otherwise(named)
    scored = model.transform(df).withColumn(label, F.when(F.col(text) != "", named))
    return scored.select(*keep, label)


def lexicon_row_scorer(lexicon: Mapping[str, int]) -> RowScorer:
    """The lexicon as a row scorer. It quotes its labels, as JSON services do."""
    weights = dict(lexicon)
    # Local names only: executors run this without a copy of the package.
    positive, neutral, negative = sentiment.POSITIVE, sentiment.NEUTRAL, sentiment.NEGATIVE

    def score(text: str) -> str:
        total = sum(weights.get(word, 0) for word in text.split(" "))
        name = positive if total > 0 else negative if total < 0 else neutral
        return f'"{name}"'

    return score


def lexicon_batch_scorer(lexicon: Mapping[str, int]) -> Callable[[], BatchScorer]:
    """The lexicon as a factory of batch scorers."""
    score = lexicon_row_scorer(lexicon)

    def make() -> BatchScorer:
        return lambda texts: [score(text).strip('"') for text in texts]

    return make
