"""Functions and broadcasts of the operators reach workers that have no copy of the package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from postloom.session import build_session
from postloom.llm import leaks, lm
import public_tokenizers as P
from pyspark.sql import functions as F

spark = build_session(cpus=2, memory="2g")
far = spark.range(1).select(F.lit(1)).rdd.map(lambda _: __import__("importlib.util").util.find_spec("postloom") is None).first()
assert far, "workers can import the package: nothing is tested"
item = "the quick brown fox jumps over the lazy dog while seven wizards watch the moon rise slowly"
docs = spark.createDataFrame([(i, f"words before {{i}} " + (item if i % 2 else "and others")) for i in range(12)], "doc_id long, text string")
items = spark.createDataFrame([(1, item)], "item_id long, text string")
assert sorted(r.id for r in leaks.find_leaks(docs, items).collect()) == [1, 3, 5, 7, 9, 11]
assert leaks.without_leaks(docs, items).count() == 6
scores = lm.score_texts(docs, docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
assert len(scores) == 12 and all(r.score < 0 for r in scores)
print("all reached")
"""


def test_workers_without_the_package(tmp_path):
    root = str(Path(__file__).parents[2])
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "all reached" in done.stdout, done.stderr[-3000:]
