from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from postloom.llm import periods
from postloom.llm.queries import QUERIES


def plain_runs(words, min_exponent=4, min_words=6):
    """Every period by direct comparison, smallest first; ``(start, length, period)``."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([numbers[w] for w in words], dtype=np.int64)
    found, spans = [], set()
    for q in range(1, len(x) // 3 + 1):
        equal = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist(), strict=True):
            # A run with a smaller period is a stretch of that period too.
            if end - start >= max(min_words, min_exponent * q) and (start, end) not in spans:
                spans.add((start, end))
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def solved(texts, **options):
    found, collapsed = periods._solve([[w.encode() for w in t] for t in texts], options.get("min_exponent", 4), options.get("min_words", 6))
    return [([(r["start"], r["length"], r["period"]) for r in runs], c.decode()) for runs, c in zip(found, collapsed, strict=True)]


def some_words(rng):
    kind = rng.randrange(5)
    letters = "ab" if kind < 3 else "abcdefgh"
    base = rng.choices(letters, k=rng.randrange(60))
    if kind == 1:
        base = rng.choices(letters, k=rng.randrange(1, 40)) * rng.randrange(1, 12)
    elif kind == 2:  # periods within periods
        inner = rng.choices(letters, k=rng.randrange(1, 4)) * rng.randrange(3, 9) + rng.choices(letters, k=rng.randrange(3))
        base = (inner * rng.randrange(2, 8) + rng.choices(letters, k=2)) * rng.randrange(1, 6)
    elif kind == 3:
        base = ["a"] * rng.randrange(30) + ["b"] + ["a"] * rng.randrange(30)
        base = base * rng.randrange(1, 9) + base[: rng.randrange(len(base))]
    if kind == 4 and base:
        lo = rng.randrange(len(base))
        base = base[:lo] + base[lo:] * rng.randrange(1, 9) + base[:5]
    return base


def test_random_words_equal_plain_version():
    rng = random.Random(3)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randrange(1, 20))]
        for exponent, least in ((4, 6), (3, 1), (5, 12)):
            expected = []
            for words in texts:
                runs = plain_runs(words, exponent, least)
                expected.append((runs, plain_collapsed(words, runs)))
            assert solved(texts, min_exponent=exponent, min_words=least) == expected


def test_long_words_equal_plain_version():
    rng = random.Random(4)
    fib, last = "a b".split(), ["a"]
    while len(fib) < 3000:
        fib, last = fib + last, fib
    thue = ["a"]
    while len(thue) < 2048:
        thue += ["b" if x == "a" else "a" for x in thue]
    block = rng.choices("abcdefghijk", k=500)
    texts = [fib, thue, thue * 4, ["a"] * 5000, block * 7 + block[:77], (["a"] * 200 + ["b"]) * 12, (fib[:400] * 5 + block) * 2, (["a", "b"] * 40 + ["c"]) * 30]
    for words, (runs, collapsed) in zip(texts, solved(texts), strict=True):
        assert runs == plain_runs(words)
        assert collapsed == plain_collapsed(words, runs)


def test_collisions_are_mended(monkeypatch):
    """With hashes of a few values proposals go too far; what is accepted is right all the same."""
    monkeypatch.setattr(periods, "MODULI", ((3, 2), (5, 2)))
    rng = random.Random(5)
    for _ in range(60):
        words = some_words(rng)
        got = solved([words])[0][0]
        assert set(got) <= set(plain_runs(words))


def test_synchronising_set_is_consistent_and_dense():
    rng = np.random.default_rng(6)
    words = np.concatenate([rng.integers(0, 2, 3000), np.tile(rng.integers(0, 2, 37), 20), rng.integers(0, 50, 1000)])
    n = len(words)
    for t in (2, 4, 8, 16, 32):
        windows = np.lib.stride_tricks.sliding_window_view(words, t)
        periodic = np.zeros(n, dtype=bool)
        for p in range(1, t // 3 + 1):
            periodic[: len(windows)] |= (windows[:, p:] == windows[:, : t - p]).all(axis=1)
        chosen = periods.synchronising_set(periods.WindowHashes(words), n, t, periodic)
        is_in = np.zeros(n - 2 * t + 1, dtype=bool)
        is_in[chosen] = True
        seen = {}
        for i in range(n - 2 * t + 1):
            assert seen.setdefault(words[i : i + 2 * t].tobytes(), is_in[i]) == is_in[i]
        for i in range(n - 3 * t + 2):
            wide = words[i : i + 3 * t - 1]
            dense = any((wide[p:] == wide[:-p]).all() for p in range(1, t // 3 + 1))
            assert is_in[i : i + t].any() != dense


def expected_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = s, length, q, 1000 * length // q
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(plain_collapsed(words, runs)))


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op11_periods"](spark, sf_dir).collect()}
    assert got == {expected_row(r.doc_id, r.text) for r in rows}
    assert sum(r[1] > 0 for r in got) > 5


@pytest.mark.parametrize("chunk", [1 << 19, 50])
def test_edge_cases(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(periods, "CHUNK_WORDS", chunk)
    rng = random.Random(7)
    made = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, "\t ".join(some_words(rng))) for i in [*made, *range(40)]]
    rows += [(None, "a " * 9), (made[0], ""), (made[1], None), (made[2], " \n\x0b"), (made[3], "x"), (1, None), (2, ""), (3, "ä ä\x0cä\r\nä ä ä"), (3, "Ä  " * 7), (4, "w v " * 30_000)]
    docs = spark.createDataFrame([(i, t, [1], "clash") for i, t in rows], "doc_id long, text string, runs array<int>, collapsed string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op11_periods"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected_row(*r) for r in rows), key=str)
    assert periods.periodic_runs(docs.limit(0)).collect() == []


def test_a_run_is_compared_once(monkeypatch):
    """Not once for each of its periods: that would take memory in the square of its length."""
    compared = []
    holds = periods._holds

    def noted(words, start, end, period):
        compared.append(int((end - start).sum()))
        return holds(words, start, end, period)

    monkeypatch.setattr(periods, "_holds", noted)
    words = list("abcdefg") * 300 + ["x"] + list("abcdefghij") * 20
    ((runs, _),) = solved([words])
    assert runs == plain_runs(words)
    assert sum(compared) < 4 * len(words)
