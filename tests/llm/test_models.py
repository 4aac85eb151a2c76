from __future__ import annotations

import zlib

import numpy as np
from postloom.llm import language, quality
from postloom.llm.grams import distinct_sample
from postloom.llm.queries import QUERIES
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.01"


def remainder(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_quality_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = QUERIES["op1_quality"](spark, DIR).collect()
    assert len(rows) == spark.read.parquet(f"{DIR}/documents.parquet").count()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in held]) > 0.95


def test_quality_edge_cases(spark):
    train = spark.createDataFrame([(k, "good clean words here " * 30 if k % 2 else "bad!!! BAD!!! " * 40) for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(99, 1), (None, 0), (3, None)], "doc_id long, quality int")
    w = quality.fit(train, labels)
    docs = spark.createDataFrame(
        [(1, None, 5.0), (2, "", 5.0), (3, "good clean words here", 5.0), (3, "good clean words here", 5.0), (4, "BAD!!! bad!!! " * 60_000, 5.0), (None, "x", 5.0)],
        "doc_id long, text string, score double",
    )
    got = quality.score(docs, w).collect()
    by_id = {r.id: r for r in got}
    assert len(got) == 6 and by_id[1].score == by_id[2].score and by_id[3].score > 0.5 > by_id[4].score
    assert by_id[4].passages > 1000
    assert quality.score(docs.limit(0), w).collect() == []
    assert quality.score(docs, quality.fit(train.limit(0), labels.limit(0))).count() == 6


def test_quality_gradients():
    rng = np.random.default_rng(1)
    parts = [b"some words", b"OTHER!! things", b"a b c d e", b"12345 678"]
    x, bag = quality.features(parts).astype(float), np.array([0, 0, 1, 1])
    w = {"encode": rng.normal(size=(x.shape[1], 4)), "rise": rng.normal(size=(4, 3)), "gate": rng.normal(size=(4, 3))}
    w |= {"attend": rng.normal(size=3), "decide": rng.normal(size=4), "bias": rng.normal(size=1)}
    goal, weight = np.array([1.0, 0.0]), np.array([0.5, 0.5])

    def loss():
        s = quality.forward(w, x, bag)["score"]
        return -(weight * (goal * np.log(s) + (1 - goal) * np.log(1 - s))).sum()

    g = quality.gradients(w, x, bag, goal, weight)
    for name, at in (("encode", (-1, 2)), ("encode", (-5, 0)), ("rise", (1, 2)), ("gate", (3, 1)), ("attend", (2,)), ("decide", (0,)), ("bias", (0,))):
        keep, h = w[name][at], 1e-5
        w[name][at] = keep + h
        up = loss()
        w[name][at] = keep - h
        down = loss()
        w[name][at] = keep
        assert abs((up - down) / (2 * h) - g[name][at]) < 1e-6


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = QUERIES["op9_language"](spark, DIR).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.98


def test_language_edge_cases(spark):
    rows = [(k, text, lang) for k in range(30) for text, lang in (("the house of the man", "en"), ("das Haus des Mannes", "de"), ("слово и дело", "ru"))]
    rows += [(90, None, "en"), (91, "??", "de"), (92, "unlabelled", None)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(train)
    assert model.languages == ["de", "en", "ru"]
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "123 !?", 1), (4, "the man of the house", 1), (4, "the man of the house", 1), (5, "дело " * 100_000, 1), (6, "z", 1)],
        "doc_id long, text string, language int",
    )
    got = language.predict(docs, model).collect()
    said = {r.id: r.language for r in got}
    assert len(got) == 7 and [said[k] for k in range(1, 6)] == ["und", "und", "und", "en", "ru"] and said[6] in model.languages
    assert language.predict(docs.limit(0), model).collect() == []
    assert {r.language for r in language.predict(docs, language.fit(train.limit(0))).collect()} == {"und"}


def test_language_keeps_rare_languages_beside_copies(spark):
    """One English text 6000 times takes one place; both languages are learnt, and every row order gives the same sample."""
    english = [f"the house number {i} stands near the old river and the town" for i in range(300)]
    german = [f"das Haus Nummer {i} steht nahe bei dem alten Fluss und der Stadt" for i in range(300)]
    rows = [(english[0], "en")] * 6000 + [(t, "en") for t in english] + [(t, "de") for t in german] + [("123", "fr"), ("", "de")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    sample = [tuple(r) for r in distinct_sample(docs.select("text", F.col("lang").alias("label")), "label", "text", 50).select("label", "text").collect()]
    assert len(sample) == len(set(sample)) == 101 and sum(k == "en" for k, _ in sample) == 50
    again = distinct_sample(docs.repartition(2).select("text", F.col("lang").alias("label")), "label", "text", 50).select("label", "text")
    assert sorted(map(tuple, again.collect())) == sorted(sample)
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    told, _ = language.decide(model, [language.plain("der Fluss steht bei dem Haus"), language.plain("the river stands near the house")])
    assert told == ["de", "en"]


def test_codewords_are_far_apart():
    for n in (1, 2, 3, 4, 5, 9, 30):
        codes = language.codewords(n)
        assert len(codes) == n and len({tuple(c) for c in codes}) == n
        apart = [(a != b).sum() for k, a in enumerate(codes) for b in codes[:k]]
        assert not apart or min(apart) >= (1 if n < 3 else 2 if n == 3 else 3)
