from __future__ import annotations

import random
import re

import numpy as np
import pytest
from postloom.llm import leaks
from postloom.llm.queries import QUERIES


def plain_fold(text):
    return re.sub(" +", " ", "".join(c.lower()[0] if c.isalnum() else " " for c in text)).lstrip(" ")


def least_edits(piece, text):
    """Edits of ``piece`` against the best stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(piece, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def pieces_of(text):
    text = plain_fold(text).rstrip(" ")
    last = max(len(text) - leaks.PIECE, 0)
    return [text[at : at + leaks.PIECE] for at in [*range(0, last, leaks.STRIDE), last]]


def budget(piece):
    return min(int(leaks.EDIT_RATE * len(piece)), (len(piece) - leaks.Q) // leaks.Q)


def brute(docs, items):
    found = {}
    for k, text in docs:
        own = plain_fold(text or "")
        for item, passage in items:
            edits = [least_edits(p, own) - budget(p) for p in pieces_of(passage) if len(p) >= leaks.Q] if passage and own else []
            if any(e <= 0 for e in edits):
                found[k, item] = sum(e <= 0 for e in edits)
    return found


def test_exact_passages_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, plain_fold(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, plain_fold(r.text).rstrip(" ")) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    expected = {(k, i) for k, t in docs for i, p in items if p in t}
    rows = QUERIES["op8_leaks"](spark, folder).collect()
    assert expected and {(r.doc_id, r.item_id) for r in rows} == expected
    assert all(r.edits == 0 and r.pieces == r.all_pieces for r in rows)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        rng.choice((lambda: chars.insert(at, rng.choice("xyz")), lambda: chars.pop(at), lambda: chars.__setitem__(at, rng.choice("xyz"))))()
    return "".join(chars)


def test_edited_passages_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BATCH_CHARS", 700)
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 600)
    rng = random.Random(10)

    def prose(n):
        return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 9))) for _ in range(n))

    items = [(k, prose(n)) for k, n in enumerate((8, 25, 40, 60, 14))] + [(7, None), (8, "short"), (9, ""), (None, "x" * 50)]
    docs = [(0, None), (1, ""), (2, "   "), (3, prose(50)), (4, items[0][1]), (5, "Ä " + items[1][1].upper().replace(" ", ",\n "))]
    for k in range(10, 40):
        item = rng.choice(items[:5])[1]
        docs.append((k, prose(rng.randrange(20)) + " " + edited(rng, item, rng.randrange(0, 2 + len(item) // 14)) + " " + prose(rng.randrange(20))))
    docs.append((50, prose(40) + " " + items[3][1][: len(items[3][1]) // 2] + " " + prose(10)))
    docs.append(docs[10])
    frame = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, item_id int").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, [(i, t) for i, t in items if i is not None])
    got = leaks.find_leaks(frame, bench).collect()
    assert {(r.id, r.item_id): r.pieces for r in got} == expected
    assert len(got) == len(expected) + sum(1 for k, _ in expected if k == docs[10][0])
    for r in got:
        assert 0 <= r.start < r.stop <= len(dict(docs)[r.id])
    assert leaks.find_leaks(frame.limit(0), bench).collect() == [] and leaks.find_leaks(frame, bench.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_alignment(seed):
    rng = random.Random(seed)
    for _ in range(40):
        piece = "".join(rng.choice("abc") for _ in range(rng.randrange(20, 60)))
        text = "zz" + edited(rng, piece, rng.randrange(4)) + "zz"
        true = least_edits(piece, text)
        as_codes = [np.array([ord(c) for c in x], dtype=np.uint32) for x in (piece, text)]
        hit = leaks.align(*as_codes, -3, 6, 5)
        assert (hit[0] if hit else 9) == (true if true <= 5 else 9)
        if hit:
            stretch = text[max(hit[1], 0) : hit[2]]
            row = list(range(len(stretch) + 1))
            for i, c in enumerate(piece, 1):
                new = [i]
                for j, d in enumerate(stretch, 1):
                    new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
                row = new
            assert row[-1] == true


def test_runs_inside_an_item_and_edits_of_short_items(spark):
    rng = random.Random(4)

    def prose(n):
        return " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    item, short = prose(60), {n: (prose(20)[: n - 1] + "q") for n in (20, 31, 40, 47, 60, 63)}
    docs = [(at, f"{prose(9)} x{item[at : at + 69]}x {prose(9)}") for at in range(0, 100, 7)] + [(500, prose(9) + item[15:160] + prose(9))]
    # An edit in each part, as many as 5 % are.
    for n, text in short.items():
        chars = list(text)
        for k in range(n // 20):
            chars[(k + 1) * n // (n // 20 + 1)] = "w"
        docs.append((1000 + n, prose(9) + " " + "".join(chars) + " " + prose(9)))
    bench = spark.createDataFrame([(1, item), *short.items()], "item_id long, text string")
    found = {(r.id, r.item_id) for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert found == {(k, 1 if k < 1000 else k - 1000) for k, _ in docs}
