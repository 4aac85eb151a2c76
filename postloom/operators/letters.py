"""A fitted text classifier over letter counts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
FEATURES = [f"_n_{letter}" for letter in LETTERS]


def with_letter_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each small letter occurs in a text, null counting as empty; native expressions only."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counts = {name: F.length(whole) - F.length(F.replace(whole, F.lit(letter))) for name, letter in zip(FEATURES, LETTERS, strict=True)}
    return df.withColumns(counts)


def fit_letter_model(texts: DataFrame, text: str, label: str) -> PipelineModel:
    """Multinomial naive Bayes, add-one smoothing; rows without a label don't teach.

    Training is one aggregation of per-label sums, so the driver sees a number per label and letter.
    """
    known = with_letter_counts(texts.filter(F.col(label).isNotNull()), text).withColumn(label, F.col(label).cast("double"))
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="_features"), NaiveBayes(featuresCol="_features", labelCol=label)]
    return Pipeline(stages=stages).fit(known)
