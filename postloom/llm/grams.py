"""Hashed byte n-gram counts of many texts at once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.operators.ranking import top_per_group


def gram_counts(parts: list[bytes], dims: int, n: int = 3) -> np.ndarray:
    """Counts of hashed byte ``n``-grams, a row per part; parts shorter than ``n`` count none."""
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    places = len(data) - n + 1
    if places <= 0:
        return np.zeros((len(parts), dims), dtype=np.float32)
    code = data[:places].astype(np.uint32)
    for k in range(1, n):
        code = (code << np.uint32(8)) | data[k : k + places]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - (dims - 1).bit_length())
    part = np.repeat(np.arange(len(parts)), lengths)
    inside = part[:places] == part[n - 1 : n - 1 + places]
    cells = part[:places][inside] * dims + code[inside]
    return np.bincount(cells, minlength=len(parts) * dims).reshape(len(parts), dims).astype(np.float32)


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most about ``per_label`` rows of each label, by a hash of ``key``; never more than twice as many.

    The counts of all rows set each label's share. Labels must be few (they are collected).
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for k, v in sorted(counts.items()) for x in (k, min(1.0, per_label / v))])
    place = F.pmod(F.xxhash64(key), F.lit(1 << 20)) / (1 << 20)
    return rows.filter(place < share[F.col(label)]).limit(2 * per_label * len(counts))


def distinct_sample(rows: DataFrame, label: str, text: str, per_label: int) -> DataFrame:
    """``per_label`` different texts of each label (all, if there are fewer): those with the smallest hashes.

    Copies of a text count once, so however often one is repeated, it takes one place of its label
    and none of another's. Which texts are taken doesn't depend on the order of rows. Labels must be
    few: the result is collected by its users, and its size is bounded by their number.
    """
    keyed = rows.select(label, text, F.xxhash64(text).alias("_hash"))
    chosen = top_per_group(keyed.select(label, "_hash").distinct(), [label], [F.asc("_hash")], per_label, ["_hash"])
    chosen = chosen.select(F.col(label).alias("_label"), F.col("_hash").alias("_chosen"))
    # At most per_label rows of two values for each label.
    found = keyed.join(F.broadcast(chosen), (F.col(label) == F.col("_label")) & (F.col("_hash") == F.col("_chosen")), "left_semi")
    return found.groupBy(label, "_hash").agg(F.min(text).alias(text)).drop("_hash")
