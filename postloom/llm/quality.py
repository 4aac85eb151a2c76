"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, of which only the bag has a label. Each passage is encoded from
hashed byte trigrams and some measures of its shape; gated attention weighs the passages; the label
is predicted from the weighted mean of their codes. All weights are learnt together from document
labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.grams import bounded_sample, gram_counts

DIMS = 1024
PASSAGE = 480  # bytes
WIDTH, GATE = 24, 12
PER_LABEL = 900  # training documents a label
TRAIN_PASSAGES = 24  # of a training document, evenly spaced; scoring reads all
EPOCHS = 30
ACCEPT = 0.3
KINDS = np.zeros(256, dtype=np.int64)  # of bytes: 1 upper case, 2 lower case, 3 digit, 4 space, 5 beyond ASCII, 0 other
KINDS[65:91], KINDS[97:123], KINDS[48:58], KINDS[128:] = 1, 2, 3, 5
KINDS[[9, 10, 11, 12, 13, 32]] = 4
SHAPE = 10


def passages(text: str | None) -> list[bytes]:
    """A text in passages of about equal length; an empty text is one empty passage."""
    data = (text or "").encode("utf-8", "surrogatepass")
    count = max(1, -(-len(data) // PASSAGE))
    size = -(-len(data) // count) or 1
    return [data[i : i + size] for i in range(0, max(len(data), 1), size)]


def features(parts: list[bytes]) -> np.ndarray:
    """Per passage: root frequencies of trigrams without case, and its shape."""
    counts = gram_counts([p.lower() for p in parts], DIMS)
    total = counts.sum(axis=1, keepdims=True)
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    kinds = np.bincount(np.repeat(np.arange(len(parts)) * 6, lengths) + KINDS[data], minlength=len(parts) * 6)
    kinds = kinds.reshape(-1, 6) / np.maximum(lengths, 1)[:, None]
    shape = np.column_stack(
        [
            kinds,
            (counts > 0).sum(axis=1) / np.maximum(total[:, 0], 1),  # variety: repetition lowers it
            counts.max(axis=1) / np.maximum(total[:, 0], 1),
            np.minimum(lengths / PASSAGE, 1),
            np.ones(len(parts)),
        ]
    )
    return np.hstack([np.sqrt(counts / np.maximum(total, 1)), 3 * shape]).astype(np.float32)


Weights = dict[str, np.ndarray]


def forward(w: Weights, x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of bags; ``bag`` gives each row of ``x`` its bag, ascending from 0."""
    starts = np.flatnonzero(np.append(True, bag[1:] != bag[:-1]))
    code = np.tanh(x @ w["encode"])
    rise, gate = np.tanh(code @ w["rise"]), 1 / (1 + np.exp(-(code @ w["gate"])))
    energy = (rise * gate) @ w["attend"]
    energy = np.exp(energy - np.maximum.reduceat(energy, starts)[bag])
    attention = energy / np.add.reduceat(energy, starts)[bag]
    whole = np.add.reduceat(attention[:, None] * code, starts, axis=0)
    odds = whole @ w["decide"] + w["bias"]
    score = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {"code": code, "rise": rise, "gate": gate, "attention": attention, "whole": whole, "score": score}


def gradients(w: Weights, x: np.ndarray, bag: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> Weights:
    f = forward(w, x, bag)
    slip = (f["score"] - goal) * weight
    to_whole = (slip[:, None] * w["decide"])[bag]
    to_attention = (to_whole * f["code"]).sum(axis=1)
    mean = np.bincount(bag, weights=f["attention"] * to_attention)[bag]
    to_energy = f["attention"] * (to_attention - mean)
    to_rise = to_energy[:, None] * w["attend"] * f["gate"] * (1 - f["rise"] ** 2)
    to_gate = to_energy[:, None] * w["attend"] * f["rise"] * f["gate"] * (1 - f["gate"])
    to_code = f["attention"][:, None] * to_whole + to_rise @ w["rise"].T + to_gate @ w["gate"].T
    return {
        "encode": x.T @ (to_code * (1 - f["code"] ** 2)),
        "rise": f["code"].T @ to_rise,
        "gate": f["code"].T @ to_gate,
        "attend": (f["rise"] * f["gate"]).T @ to_energy,
        "decide": f["whole"].T @ slip,
        "bias": slip.sum(keepdims=True),
    }


def train(texts: list[str | None], labels: list[int], epochs: int = EPOCHS, seed: int = 11) -> Weights:
    """Adam over batches of whole bags. Without any label, weights that score 0.5."""
    rng = np.random.default_rng(seed)
    w = {
        "encode": rng.normal(0, 0.3, (DIMS + SHAPE, WIDTH)),
        "rise": rng.normal(0, 0.3, (WIDTH, GATE)),
        "gate": rng.normal(0, 0.3, (WIDTH, GATE)),
        "attend": rng.normal(0, 0.3, GATE),
        "decide": np.zeros(WIDTH),
        "bias": np.zeros(1),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    # Beside each text a short fragment of it, for the sake of short documents.
    goal = np.repeat(np.array(labels, dtype=np.float32), 2)
    bags = []
    for text in texts:
        parts = passages(text)
        bags.append(features(parts[:: max(1, -(-len(parts) // TRAIN_PASSAGES))]))
        words = (text or "").split(" ")
        first = rng.integers(0, len(words))
        bags.append(features(passages(" ".join(words[first : first + rng.integers(1, 25)]))))
    m, v, t = {k: 0 * x for k, x in w.items()}, {k: 0 * x for k, x in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), 64):
            own = order[lo : lo + 64]
            bag = np.repeat(np.arange(len(own)), [len(bags[k]) for k in own])
            g = gradients(w, np.concatenate([bags[k] for k in own]), bag, goal[own], np.full(len(own), 1 / len(own), dtype=np.float32))
            t += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for k in w:
                step = g[k] + 1e-4 * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * step, 0.999 * v[k] + 0.001 * step * step
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Weights:
    """Weights from ``docs (doc_id, text)`` and ``labels (doc_id, quality)``: a sample of at most twice ``per_label`` a label.

    Rows without a label teach nothing. The sample is drawn from the labels alone, and only then are
    its texts looked up; the sample's order does not depend on Spark's.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = bounded_sample(known, "quality", "doc_id", per_label)
    # At most a few thousand numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").collect()
    rows = sorted((r.doc_id, r.text or "", int(r.quality)) for r in rows)
    return train([t for _, t, _ in rows], [q for _, _, q in rows])


def bag_scores(texts: pa.ChunkedArray | pa.Array, w: Weights) -> tuple[np.ndarray, list[int]]:
    """Score and number of passages of each text, a bounded number of passages at a time where texts allow."""
    whole = w | {"encode": np.eye(WIDTH, dtype=np.float32)}

    def of(bags: list[list[bytes]]) -> np.ndarray:
        parts = [p for b in bags for p in b]
        bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        # Of a long text only the codes of all passages are held together.
        x = np.concatenate([features(parts[lo : lo + 1024]) @ w["encode"] for lo in range(0, len(parts), 1024)])
        return forward(whole, x, bag)["score"]

    scores, counts, held, size = [], [], [], 0
    for text in texts:
        held.append(passages(text.as_py()))
        counts.append(len(held[-1]))
        size += counts[-1]
        if size >= 1024:
            scores.append(of(held))
            held, size = [], 0
    if held:
        scores.append(of(held))
    return (np.concatenate(scores).astype(np.float64) if scores else np.zeros(0)), counts


def score(docs: DataFrame, w: Weights, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, score, passages)`` for every row, from all passages of its text.

    A null text counts as empty, and an empty text is scored like any other, as one empty passage.
    Repeated rows give repeated rows, an empty table an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = bag_scores(batch.column(1), w)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array(counts, pa.int64())], ["id", "score", "passages"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double, passages bigint")


def accepted(docs: DataFrame, w: Weights, least: float = ACCEPT, text_column: str = "text") -> DataFrame:
    """The rows, with all columns, whose text scores ``least`` or more; texts are scored as by ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, _ = bag_scores(batch.column(text_column), w)
            yield batch.filter(pa.array(found >= least))

    return docs.mapInArrow(run, docs.schema)
