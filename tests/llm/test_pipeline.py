from __future__ import annotations

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from brute import smallest_reachable
from postloom.llm import bpe, quality, simhash
from postloom.llm.queries import quality_weights
from test_leaks import plain_fold
from test_simhash import similar_pairs

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_plain_versions(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    w = quality_weights(spark, DIR)

    def good(text):
        parts = quality.passages(text)
        return quality.forward(w, quality.features(parts), np.zeros(len(parts), dtype=int))["score"][0] >= 0.3

    kept = {k for k, r in docs.items() if good(r.text)}
    assert 0 < len(kept) < len(docs)
    accepted = [(k, docs[k].text) for k in sorted(kept)]
    links = [(a, b) for a, b, _ in similar_pairs(accepted, simhash.SIMILARITY)]
    first = smallest_reachable(sorted(kept), links)
    kept = {k for k in kept if first[k] == k}
    items = [plain_fold(r.text).rstrip(" ") for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    kept = {k for k in kept if not any(i in plain_fold(docs[k].text) for i in items)}
    frame = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, frame = frame, stage(spark, frame, DIR).cache()
        assert frame.columns == COLUMNS, name
        assert frame.count() <= before.count(), name
    clean = {r.doc_id: r for r in frame.collect()}
    # Fingerprints estimate the similarity: what they link below it must come close to it, and nothing at it stays.
    gone = kept - set(clean)
    close = {k for a, b, s in similar_pairs(accepted, 0.7) for k in (a, b)}
    assert set(clean) <= kept and gone <= close and len(gone) <= 2
    kept -= gone
    assert all(r.n_chars == len(r.text) for r in clean.values())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    rows = corpus_pipeline.run(spark, DIR).collect()
    assert {r.doc_id for r in rows} == kept
    for r in rows:
        text = clean[r.doc_id].text
        assert list(r.ids) == library.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("stage", range(5))
def test_stages_with_nulls_repeats_and_clashing_columns(spark, stage):
    rows = [(None, None, None, None, None, "x"), (None, "some words here", "en", None, None, "x"), (1, "", "en", "s", 0, "x")]
    rows += [(2, "mail a.b@example.org now", None, "s", 9, None)] * 3 + [(3, "word " * 30_000, "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string")
    docs = docs.withColumns({"fp": docs.n_chars, "score": docs.text, "component": docs.doc_id})
    name, function = corpus_pipeline.STAGES[stage]
    out = function(spark, docs, DIR)
    got = out.collect()
    if name != "tokens":
        assert out.columns == docs.columns
    if name in ("decontamination", "personal_data", "tokens"):
        assert len(got) == len(rows)
    if name == "near_duplicates":
        assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "None", "None"]
    assert function(spark, docs.limit(0), DIR).collect() == []


def test_registered(spark):
    import __spark_entry__

    queries = __spark_entry__.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert all(sum(q.startswith(f"op{n}_") for q in queries) == 1 for n in range(1, 11))
