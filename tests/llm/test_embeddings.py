from __future__ import annotations

import numpy as np
import pytest
from brute import smallest_reachable
from postloom.llm import embeddings
from postloom.llm.queries import QUERIES


def brute(rows, threshold=0.95):
    sound = {}
    for k, (_, v) in enumerate(rows):
        if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v):
            sound[k] = np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64))
    links = [(a, b) for a in sound for b in sound if a != b and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= threshold - 1e-12]
    count = {k: 0 for k in range(len(rows))}
    for a, _ in links:
        count[a] += 1
    ids = [i for i, _ in rows]
    reach = smallest_reachable(set(ids), [(ids[a], ids[b]) for a, b in links])
    return sorted((i, count[k], reach[i], reach[i] == i) for k, i in enumerate(ids))


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = brute(rows)
    assert sorted(map(tuple, QUERIES["op5_embeddings"](spark, sf_dir).collect())) == expected


@pytest.mark.parametrize("small", [False, True])
def test_edge_cases(spark, monkeypatch, small):
    """Small blocks: cells are cut, blocks are paired, and the strip and recompute sizes matter."""
    if small:
        monkeypatch.setattr(embeddings, "STRIP", 16)
        monkeypatch.setattr(embeddings, "BLOCK_NUMBERS", 16 * 12)
        monkeypatch.setattr(embeddings, "RECOMPUTED", 7)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=12)
    rows = [(k, (centre + rng.normal(size=12) * 0.25).astype(np.float32).tolist()) for k in range(60)]
    rows += [(100 + k, rng.normal(size=12).astype(np.float32).tolist()) for k in range(60)]
    rows += [(200 + k, [float(x) for x in np.float32(c * np.array(rows[k][1]))]) for k, c in enumerate((1, 1, 3))]
    rows += [(300, None), (301, []), (302, [0.0] * 12), (303, [1.0, None] * 6), (304, [float("nan")] * 12), (305, [float("inf")] * 12)]
    rows += [(310, [1.0, 2.0]), (311, [2.0, 4.0]), (312, [-1.0, -2.0]), (313, [0.0, 0.0]), (314, [-0.0, 1.0]), (315, [0.0, 1.0]), (4, rows[4][1])]
    frame = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, digest string")
    assert sorted(map(tuple, embeddings.near_duplicates(frame).collect())) == brute(rows)
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(9)
    x = embeddings.units(rng.normal(size=(300, 40)))
    codes, scale, error = embeddings.quantise(x)
    approx = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale
    length = np.linalg.norm(codes.astype(float), axis=1) * scale
    assert (np.abs(x @ x.T - approx) <= error[:, None] * length + error + 1e-9).all()
