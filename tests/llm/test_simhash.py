from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from brute import smallest_reachable
from postloom.llm import simhash
from postloom.llm.components import connected_components, local_components
from postloom.llm.queries import QUERIES


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(fps) for b, y in fps[:k] if (x ^ y).bit_count() <= 3]
    component = smallest_reachable([i for i, _ in fps], links)
    return {(i, f"{x:016x}", component[i]) for i, x in fps}


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in QUERIES["op2_simhash"](spark, sf_dir).collect()} == brute(rows)


def test_edge_cases(spark):
    texts = [None, "", " \t\n", "one", "ONE", "one two", "Ä ä x", "a b c d", "a b c", "a b c d", "x " * 50_000]
    rows = list(enumerate(texts)) + [(3, "one")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, component string, fp int")
    got = {(r.id, f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute(rows)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("small", [False, True])
def test_trie_links_equal_brute_force(small, monkeypatch):
    if small:
        monkeypatch.setattr(simhash, "FRONTIER", 50)
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = np.concatenate([centres] + [centres ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) for _ in range(25)])
    for _ in range(3):
        values = np.append(values, values[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)))
    values = np.unique(values)
    label = simhash.trie_links(values, np.zeros(1, dtype=int), 0)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    assert label.tolist() == list(smallest_reachable(range(len(values)), near.tolist()).values())


def test_links_across_tries_and_blocks(spark, monkeypatch):
    """Small blocks and chunks: hot tries are cut, and every turn contributes."""
    monkeypatch.setattr(simhash, "TRIE_ROWS", 16)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 40)
    rng = np.random.default_rng(2)
    base = rng.integers(-(1 << 62), 1 << 62, 20)
    values = {int(v) for v in base}
    for _ in range(400):
        v = int(base[rng.integers(0, 20)])
        for bit in rng.integers(0, 63, rng.integers(0, 5)):
            v ^= 1 << int(bit)
        values.add(v)
    values = sorted(values)
    reps = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "fp long, rep long")
    found = {r.node: r.component for r in connected_components(simhash.fingerprint_links(reps)).collect()}
    links = [(a, b) for a in range(len(values)) for b in range(a) if ((values[a] ^ values[b]) & (1 << 64) - 1).bit_count() <= 3]
    expected = smallest_reachable(range(len(values)), links)
    assert {i: found.get(i, i) for i in expected} == expected


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3), (300, 259)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ends = {x for a, b in edges if a and a != b for x in (a, b)}
    assert got == smallest_reachable(ends, [(a, b) for a, b in edges if a and a != b])
    assert local_components(4, np.array([3, 1]), np.array([1, 2])).tolist() == [0, 1, 1, 1]


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1 if words else 0)))


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def similar_pairs(rows, least):
    """Brute force over all pairs ``(a, b, similarity)`` of at least ``least``."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    return [(a, b, s) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if (s := similarity(x, y)) >= least]


def test_near_copies_against_brute_force(spark):
    """Steps at the similarity are found; nothing far below it is linked."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = {r.id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = similar_pairs(rows, 0.5)
    wanted = [got[a] == got[b] for a, b, s in pairs if s >= 0.8]
    assert len(wanted) > 90 and sum(wanted) >= 0.95 * len(wanted)
    assert all(got[a] == got[b] for a, b, s in pairs if s == 1)
    loose = smallest_reachable(sorted(got), [(a, b) for a, b, s in pairs])
    assert all(loose[k] == loose[c] for k, c in got.items())


def test_near_copies_of_one_text(spark, monkeypatch):
    """A group of edited copies over several blocks of its tries, beside texts of their own."""
    monkeypatch.setattr(simhash, "TRIE_ROWS", 64)
    rng = np.random.default_rng(7)
    base = [f"w{x}" for x in rng.integers(0, 5000, 400)]

    def edited(k):
        words = list(base)
        for at in rng.integers(0, 400, 3):
            words[at] = f"new{k}"
        return " ".join(words)

    rows = [(k, edited(k)) for k in range(600)]
    rows += [(k, " ".join(f"w{x}" for x in rng.integers(0, 5000, 300))) for k in range(600, 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component for r in simhash.near_copies(docs).collect()}
    assert sum(got[k] == 0 for k in range(600)) >= 594
    assert all(got[k] == k for k in range(600, 900))


def test_near_copies_edge_cases(spark):
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d", "a b c d", "x " * 50_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "one", "", 2), (None, "one", "", 2), (None, "alone", "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, w0 int")
    got = {(r.id, r.component) for r in simhash.near_copies(docs).collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (5, 5), (6, 6), (7, 6), (8, 8), (None, 3), (None, None)}
    assert simhash.near_copies(docs.limit(0)).collect() == []


def test_texts_are_not_shuffled_to_drop_copies(spark, conf):
    """What is looked up beside the texts is a bit for a row, not its id, so that it stays small where ids don't."""
    rng = random.Random(8)
    ids = rng.sample(range(1 << 60), 2000)
    words = [str(rng.random()) for _ in ids]
    rows = [(i, w + f" of {i} " + w[::-1] + " and more words") for i, w in zip(ids, words, strict=True)]
    rows += [(i + (1 << 61), text) for i, text in rows[:1000]]
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="15000")
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {tuple(r) for r in kept.collect()} == set(rows[:2000])
