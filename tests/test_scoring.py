from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from postloom.operators import scoring
from postloom.plans.nlp import nlp_preprocessed
from postloom.plans.sentiment import predictions_by_row, sentiment_analytics
from postloom.sources.samples import LEXICON
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import functions as F


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "n int, t string")


def labels(df):
    return [r.label for r in df.orderBy("n").collect()]


def test_row_scorer_errors_and_empty_texts_are_null(spark):
    def scorer(text):
        if text == "fail":
            raise RuntimeError("remote call failed")
        return text.upper()

    df = texts(spark, ["a", "", None, "fail", " "])
    assert labels(scoring.score_rows(df, scorer, "t", "label")) == ["A", None, None, None, " "]


def test_batch_scorer_skips_blank_texts(spark):
    def make():
        def score(batch):
            assert all(text.strip() for text in batch)
            return [text.upper() for text in batch]

        return score

    df = texts(spark, ["a", "", None, "  ", "b"])
    assert labels(scoring.score_batches(df, make, "t", "label")) == ["A", None, None, None, "B"]


def test_failing_batch_is_null_and_so_is_one_with_labels_missing_or_left_over(spark):
    def make_failing():
        def score(batch):
            raise RuntimeError("remote call failed")

        return score

    df = texts(spark, ["a", "b", ""]).coalesce(1)
    assert labels(scoring.score_batches(df, make_failing, "t", "label")) == [None, None, None]
    for found in (["one"], ["surplus", "x", "y"]):
        out = scoring.score_batches(df, lambda found=found: lambda batch: found, "t", "label", error="error").orderBy("n").collect()
        assert [r.label for r in out] == [None, None, None]
        assert [bool(r.error) for r in out] == [True, True, False] and f"{len(found)} labels for 2 texts" in out[0].error


def test_row_scorer_is_made_once_per_task_and_reports_failures(spark):
    def make():
        made = []

        def score(text):
            made.append(text)
            if text == "fail":
                raise RuntimeError("remote call failed")
            return str(len(made))

        return score

    df = texts(spark, ["a", "fail", "", "b"]).coalesce(1)
    out = scoring.score_rows(df, make, "t", "label", error="error", factory=True).orderBy("n").collect()
    assert [r.label for r in out] == ["1", None, None, "3"]
    assert [r.error for r in out] == [None, "RuntimeError('remote call failed')", None, None]


def test_lexicon_scorers_agree(spark):
    df = texts(spark, ["on by th", "th in on", "on th", "nothing", "", None, " on  on "])
    native = labels(scoring.score_lexicon(df, LEXICON, "t", "label"))
    assert native == ["positive", "negative", "neutral", "neutral", None, None, "positive"]
    by_row = scoring.score_rows(df, scoring.lexicon_row_scorer(LEXICON), "t", "label")
    assert [x and x.strip('"') for x in labels(by_row)] == native
    assert labels(scoring.score_batches(df, scoring.lexicon_batch_scorer(LEXICON), "t", "label")) == native


def test_fitted_model(spark):
    train = spark.createDataFrame([("good fine", 1.0), ("bad awful", 0.0)] * 5, "t string, label double")
    stages = [Tokenizer(inputCol="t", outputCol="w"), HashingTF(inputCol="w", outputCol="features"), NaiveBayes()]
    model = Pipeline(stages=stages).fit(train)
    df = texts(spark, ["good", "awful", ""])
    scored = scoring.score_model(df, model, {1.0: "positive", 0.0: "negative"}, "t", "label")
    assert scored.columns == ["n", "t", "label"]
    assert labels(scored) == ["positive", "negative", None]


SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
for name in ("predictions_row_udf", "predictions_batch_udf"):
    print(name, entry.queries()[name](spark, sys.argv[2]).filter("sentiment IS NOT NULL").count() > 0)
"""


def test_executors_need_no_copy_of_the_package(sf_dir, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(Path(__file__).resolve().parents[1]), sf_dir],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False,
    )
    assert "predictions_row_udf True" in run.stdout, run.stderr[-2000:]
    assert "predictions_batch_udf True" in run.stdout, run.stderr[-2000:]


def test_null_labels_are_a_group_or_left_out(spark, posts):
    nlp = nlp_preprocessed(posts, ["the"])
    predicted = predictions_by_row(nlp, scoring.lexicon_row_scorer(LEXICON))
    with_null = sentiment_analytics(predicted)
    assert with_null.filter("sentiment IS NULL AND sentiment_score = 0").count() > 0
    without = sentiment_analytics(predicted, drop_null=True)
    assert without.count() == with_null.filter("sentiment IS NOT NULL").count()
    assert with_null.agg(F.sum("post_count")).first()[0] == posts.count()
