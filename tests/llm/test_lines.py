from __future__ import annotations

import random

import pytest
from oracle_check import difference
from postloom.llm import lines
from postloom.llm.tables import stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows):
    """``rows`` of ``(id, text)``; an id of None comes last."""
    order = lambda i: (i is None, i or 0)
    keys = [[line.translate(UPPER).strip(BLANKS) for line in (text or "").split("\n")] for _, text in rows]
    holders = {}
    for (i, _), found in zip(rows, keys, strict=True):
        for key in found:
            holders.setdefault(key, set()).add(i)
    result = []
    for (i, text), found in zip(rows, keys, strict=True):
        split = (text or "").split("\n")
        gone = [len(k) >= 10 and len(holders[k]) > 1 and min(holders[k], key=order) != i for k in found]
        result.append((i, len(split), sum(gone), "\n".join(x for x, g in zip(split, gone, strict=True) if not g)))
    return sorted(result, key=str)


def test_whole_table(spark, sf_dir):
    assert difference(spark, sf_dir, "op12_lines") is None


@pytest.mark.parametrize("batches", [1, 3])
def test_equals_plain_version(spark, batches):
    rng = random.Random(batches)
    pool = ["a common long line", "A COMMON long Line  ", "\t\x0ba common long line\r", "short", "", "  ", "ÄÖ over ten points", "äÖ over ten points", "exactly10!", "exactly 9"]
    pool += [f"line number {i} of many" for i in range(30)]
    rows = [(rng.randrange(60), "\n".join(rng.choices(pool, k=rng.randrange(9)))) for _ in range(150)]
    rows += [(None, "a common long line\nonly without id here"), (None, "only without id here"), (7, None), (8, "\n"), (9, "x\n" * 3000 + "last long line of it")]
    rows += [(70, "last long line of it\nthis stays where it is")] * 2 + [(71, "this stays where it is")]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, h int, keep string")
    got = sorted((tuple(r) for r in lines.dedupe_lines(docs, batches=batches).collect()), key=str)
    assert got == plain(rows)


def test_empty_table(spark):
    assert lines.dedupe_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_are_levelled_and_not_shuffled(spark, tmp_path, conf):
    """Seven batches with fan-out 2 leave a run on levels 0, 1 and 2; a merge of a batch with a run needs no exchange."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    runs = lines.LineRuns(spark, "line_runs_test", str(tmp_path), fanout=2, buckets=3)
    for number in range(7):
        rows = [(number, number * 100 + k // 2) for k in range(0, 200, 2)] + [(number, 5), (number + 50, 5)]
        docs = spark.createDataFrame([(i, f"the line of number {k}") for i, k in rows], "doc_id long, text string")
        losing = runs.add(stored(lines.line_keys(docs), "test-lines"), number).collect()
        # Before its turn no batch holds a key but 5.
        assert {r.known for r in losing} == {number > 0} and len(losing) == 1
        assert losing[0].keep == (None if number else 0)
    assert {level: len(found) for level, found in runs.levels().items()} == {0: 1, 1: 1, 2: 1}
    tables = [t for found in runs.levels().values() for t in found]
    assert sum(spark.table(t).count() for t in tables) == 700
    for name in tables[1:]:
        joined = spark.table(tables[0]).join(spark.table(name), lines.KEYS, "left_anti")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == spark.table(tables[0]).count()
    runs.close()
    assert runs.levels() == {}


def test_native(spark, sf_dir):
    """No Python worker on the way."""
    plan = lines.dedupe_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
