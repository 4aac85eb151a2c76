from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from postloom.llm import repeats
from postloom.llm.queries import QUERIES


def brute(texts, length, keep_first=False):
    """Per text: bytes, removed, spans and what is left."""
    data = [(t or "").encode() for t in texts]
    places = defaultdict(list)
    for k, d in enumerate(data):
        for i in range(len(d) - length + 1):
            places[d[i : i + length]].append((k, i))
    gone = [np.zeros(len(d) + 1, dtype=bool) for d in data]
    for found in places.values():
        for k, i in found[1 if keep_first else 0 :] if len(found) > 1 else []:
            gone[k][i : i + length] = True
    out = []
    for d, g in zip(data, gone, strict=True):
        kept = bytes(b for b, x in zip(d, g[:-1], strict=True) if not x)
        out.append((len(d), len(d) - len(kept), int((np.diff(np.append(False, g).astype(int)) == 1).sum()), kept))
    return out


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = {(k, *x[:3], hashlib.sha256(x[3]).hexdigest()) for (k, _), x in zip(rows, brute([t for _, t in rows], 200), strict=True)}
    assert {tuple(r) for r in QUERIES["op10_repeats"](spark, sf_dir).collect()} == expected
    assert sum(x[2] for x in expected) > 0


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_random_texts(spark, monkeypatch, keep_first, hot):
    """Small pieces and stretches; shared passages, repeats within a text, equal rows, empty and null ones."""
    monkeypatch.setattr(repeats, "PIECE", 500)
    monkeypatch.setattr(repeats, "SORTED_BYTES", 300)
    if hot:
        monkeypatch.setattr(repeats, "HOT_CLASSES", 3)
    rng = random.Random(5)
    passages = ["".join(rng.choice("ab cé") for _ in range(rng.randrange(10, 90))) for _ in range(6)]
    texts = [None, "", "x", "a" * 900]
    for _ in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("abcdef") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(12))]
        texts.append("".join(parts))
    texts += texts[10:14]
    rows = [(k, t, 1, b"x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, packed binary").coalesce(1)
    got = repeats.remove_repeats(docs, min_bytes=24, gram=8, keep_first=keep_first)
    found = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()}
    assert [found[k] for k in range(len(texts))] == brute(texts, 24, keep_first)
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_previous_factors():
    rng = np.random.default_rng(6)
    values = rng.permutation(300)
    begin = np.repeat(np.arange(0, 300, 10), 10)
    before = repeats.previous_smaller(values, begin)
    for i in range(300):
        smaller = [j for j in range(begin[i], i) if values[j] < values[i]]
        assert before[i] == (smaller[-1] if smaller else -1)
    first = repeats.has_previous_factor(values, begin)
    assert [bool(x) for x in first] == [values[i] > values[begin[i] : begin[i] + 10].min() for i in range(300)]
