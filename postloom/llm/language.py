"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over hashed byte trigrams tells apart
the languages whose codewords have it from those whose don't; decoding takes the codeword with the
least weighted loss, so a few wrong bits do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.grams import distinct_sample, gram_counts

DIMS = 2048
PER_LANGUAGE = 250  # training texts a language
FRAGMENT = 240  # bytes of the fragments of a training text that are learnt beside the whole
FRAGMENTS = 4
ROUNDS = 60
AMBIGUOUS = 0.8  # a decision with less of the probability is flagged
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 and -1
    weights: np.ndarray  # (DIMS + 1) x bits
    trust: np.ndarray  # weight of each bit in the decision
    scale: float  # how sharply losses become probabilities


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``n`` codewords of +1 and -1 that are far apart: all splits for few languages, else the best random ones."""
    if n <= 5:
        splits = [[1] + [1 if s >> k & 1 else -1 for k in range(n - 1)] for s in range(2 ** max(n - 1, 0) - 1)]
        return np.array(splits or [[1]] * 1, dtype=np.int8).reshape(-1, n).T
    rng = np.random.default_rng(seed)
    bits, best, far = 10 + 5 * int(np.ceil(np.log2(n))), None, -1
    for _ in range(200):
        codes = rng.choice(np.array([-1, 1], dtype=np.int8), (n, bits))
        apart = ((codes[:, None] != codes[None]).sum(axis=2) + bits * np.eye(n, dtype=int)).min()
        if apart > far and (np.abs(codes.sum(axis=0)) < n).all():
            best, far = codes, apart
    return best


def features(parts: list[bytes]) -> np.ndarray:
    counts = gram_counts(parts, DIMS)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.hstack([np.sqrt(counts / total), np.ones((len(parts), 1), dtype=np.float32)])


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def train(texts: list[str], labels: list[str]) -> Model | None:
    """Fit the bits by logistic regression with equal weight for each language; None without texts."""
    languages = sorted(set(labels))
    if not languages:
        return None
    parts, own = [], []
    for text, label in zip(texts, labels, strict=True):
        whole = plain(text)
        step = max(1, len(whole) // FRAGMENTS)
        for part in [whole] + [whole[i : i + FRAGMENT] for i in range(0, len(whole), step)][:FRAGMENTS]:
            parts.append(part)
            own.append(languages.index(label))
    own = np.array(own)
    codes = codewords(len(languages)).astype(np.float32)
    x = features(parts)
    goal = (codes[own] + 1) / 2
    weight = (1 / np.bincount(own, minlength=len(languages)))[own][:, None].astype(np.float32) / len(languages)
    w = np.zeros((x.shape[1], codes.shape[1]), dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, ROUNDS + 1):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = x.T @ (weight * (p - goal)) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    right = ((x @ w > 0) == (goal > 0.5)).mean(axis=0)
    trust = np.maximum(right - 0.5, 0.01)
    return Model(languages, codes, w, (trust / trust.sum()).astype(np.float32), 8.0)


def decide(model: Model, parts: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and probability of each part, by the loss over all bits."""
    bits = features(parts) @ model.weights
    loss = np.einsum("nlb,b->nl", np.log1p(np.exp(-np.clip(bits[:, None, :] * model.codes[None], -30, 30))), model.trust)
    odds = np.exp(-model.scale * (loss - loss.min(axis=1, keepdims=True)))
    odds /= odds.sum(axis=1, keepdims=True)
    best = odds.argmax(axis=1)
    return [model.languages[k] for k in best], odds[np.arange(len(best)), best].astype(np.float64)


def fit(rows: DataFrame, text_column: str = "text", label_column: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from labelled rows: ``per_language`` different texts of each language, by smallest hash (all, if fewer).

    Rows with a null label, or a text that is null or has no letter, teach nothing. A text teaches
    once, however often it is repeated, so no language loses its place to another's copies.
    """
    letter = regex.compile(r"\p{L}").search
    known = rows.filter(F.col(label_column).isNotNull() & F.col(text_column).rlike(r"\p{L}"))
    known = known.select(F.col(text_column).alias("text"), F.col(label_column).alias("label"))
    sample = sorted(map(tuple, distinct_sample(known, "label", "text", per_language).select("text", "label").collect()))
    sample = [(t, k) for t, k in sample if letter(t)]
    return train([t for t, _ in sample], [k for _, k in sample])


def predict(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, language, score, ambiguous)`` for every row, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, as is everything where there is no
    model. Repeated rows give repeated rows, an empty table an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = regex.compile(r"\p{L}").search
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                ids, texts = (c.slice(lo, 256) for c in batch.columns)
                texts = texts.to_pylist()
                said, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                known = [k for k, t in enumerate(texts) if model is not None and t and letter(t)]
                if known:
                    languages, odds = decide(model, [plain(texts[k]) for k in known])
                    score[known] = odds
                    for k, language in zip(known, languages, strict=True):
                        said[k] = language
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(said), pa.array(score), pa.array(score < AMBIGUOUS)], ["id", "language", "score", "ambiguous"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, language string, score double, ambiguous boolean")
