"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Unit vectors are quantised to int8 with a scale each; the length of what rounding lost bounds how far
a product of codes can be from the cosine. Whole tiles of code products are taken first, and only
pairs that may reach the threshold are computed again in double precision. Vectors are dealt to cells
round pivots and cells to blocks of bounded size; two blocks meet in a task of their own, unless the
angles between their cells rule any link out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.components import connected_components, local_components
from postloom.llm.tables import stored

THRESHOLD = 0.95
BLOCK_NUMBERS = 1 << 21  # components in a block of vectors
LEAST_CELLS, MOST_CELLS = 8, 512
STRIP = 512
RECOMPUTED = 50_000  # pairs computed again at a time
SLACK = 1e-6  # for the rounding of the bounds themselves


def units(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, the scale of each, and the length of each one's rounding error."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(x - scale[:, None] * codes, axis=1)


def tile_links(a: np.ndarray, b: np.ndarray | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of unit vectors ``a`` and ``b`` with cosine at or above ``threshold``, a strip of ``a`` at a time.

    Without ``b``, pairs within ``a``, each once. With codes c, scales s and errors e, a cosine is
    within ``e_a * |s_b c_b| + e_b`` of ``s_a s_b c_a c_b``. Products of int8 codes are summed in
    floating point that holds them exactly.
    """
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    codes_a, scale_a, error_a = quantise(a)
    other = a if b is None else b
    codes_b, scale_b, error_b = (codes_a, scale_a, error_a) if b is None else quantise(b)
    right = codes_b.astype(exact).T
    length_b = np.linalg.norm(codes_b.astype(np.float64), axis=1) * scale_b
    for lo in range(0, len(a), STRIP):
        strip = slice(lo, lo + STRIP)
        product = codes_a[strip].astype(exact) @ right
        # product >= (threshold - e_a |b| - e_b) / (s_a s_b), rounded down
        least = (threshold - SLACK - error_a[strip, None] * length_b - error_b) / (scale_a[strip, None] * scale_b)
        i, j = np.nonzero(product >= least)
        i += lo
        if b is None:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), RECOMPUTED):
            p, q = i[at : at + RECOMPUTED], j[at : at + RECOMPUTED]
            near = np.einsum("nd,nd->n", a[p], other[q]) >= threshold
            yield p[near], q[near]


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, v)`` to ``(id, v, digest, dims)``; ``dims`` is 0 for vectors that link with nothing."""
    for batch in batches:
        digests, dims = [], []
        for v in batch.column(1):
            values = np.array([np.nan if x is None else x for x in v.as_py() or ()], dtype=np.float64) + 0.0
            sound = len(values) and np.isfinite(values).all() and values.any()
            sound = bool(sound and np.isfinite(np.linalg.norm(values)) and np.linalg.norm(values) > 0)
            digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            dims.append(len(values) if sound else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(dims, pa.int32())],
            ["id", "v", "digest", "dims"],
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pairs(pivots: np.ndarray, first_block: np.ndarray, blocks: np.ndarray, near: np.ndarray):
    """Vectors to a row for each pair of blocks that theirs is in: ``(pair, side, id, n, v)``.

    Cell c has the blocks from ``first_block[c]``; ``near`` says which cells can hold links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = int(blocks.sum())
        cell_of = np.repeat(np.arange(len(blocks)), blocks)
        for batch in batches:
            x = units(_matrix(batch.column("v")))
            cell = (x @ pivots.T).argmax(axis=1)
            ids = batch.column("id").to_numpy()
            own = first_block[cell] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[cell]
            meets = near[cell][:, cell_of]
            row, other = np.nonzero(meets)
            low, high = np.minimum(own[row], other), np.maximum(own[row], other)
            for lo in range(0, len(row), 20_000):
                part = slice(lo, lo + 20_000)
                taken = batch.select(["id", "n", "v"]).take(pa.array(row[part]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low[part] * total + high[part]), pa.array((own[row] == high)[part]), *taken.columns],
                    ["pair", "high", "id", "n", "v"],
                )

    return run


def _tiles(threshold: float, total: int):
    """Rows of pairs of blocks to ``(id, links, root)``: how many vectors each one is linked to there, and a link."""

    def solve(pair: int, high: np.ndarray, ids: np.ndarray, n: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        x = units(v)
        apart = pair // total != pair % total
        order = np.argsort(high, kind="stable") if apart else np.arange(len(ids))
        ids, n, x = ids[order], n[order], x[order]
        cut = int((~high).sum()) if apart else 0
        links = np.zeros(len(ids), dtype=np.int64)
        label = np.arange(len(ids))
        found = tile_links(x[:cut], x[cut:], threshold) if apart else tile_links(x, None, threshold)
        for p, q in found:
            q = q + cut
            np.add.at(links, p, n[q])
            np.add.at(links, q, n[p])
            known = np.flatnonzero(label != np.arange(len(label)))
            label = local_components(len(ids), np.append(p, known), np.append(q, label[known]))
        linked = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[linked]), pa.array(links[linked]), pa.array(ids[label[linked]])], ["id", "links", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            high, ids, n = (whole[c].to_numpy() for c in ("high", "id", "n"))
            return solve(held[0]["pair"][0].as_py(), high, ids, n, _matrix(whole["v"].combine_chunks()))

        for batch in batches:
            pair = batch.column("pair").to_numpy()
            edges = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1), len(pair)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if held and held[0]["pair"][0].as_py() != pair[lo]:
                    yield solved()
                    held = []
                held.append(part)
        if held:
            yield solved()

    return run


def linked_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links ``(id, links, root)`` among distinct sound ``vectors (id, n, v)`` of one length.

    ``links`` counts the rows (by ``n``) that a vector is linked to in one pair of blocks, ``root`` is
    a vector that it reaches there.
    """
    rows = vectors.count()
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "id bigint, links bigint, root bigint")
    if rows < 2:
        return empty
    size = len(vectors.select("v").head()[0])
    block = max(STRIP, BLOCK_NUMBERS // size)
    cells = int(min(MOST_CELLS, max(LEAST_CELLS, -(-rows // block))))
    # A fixed number of vectors, whatever the input.
    chosen = vectors.orderBy(F.xxhash64("id"), "id").select("v").limit(cells).collect()
    pivots = units(np.array([r.v for r in chosen]))

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = units(_matrix(batch.column(0))) @ pivots.T
            cell = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(cell)), cell], -1, 1))
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(angle)], ["cell", "angle"])

    count, reach = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))
    located_rows = vectors.select("v").mapInArrow(located, "cell int, angle double")
    for r in located_rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("far")).collect():
        count[r.cell], reach[r.cell] = r.n, r.far
    blocks = np.maximum(1, -(-count // block))
    between = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    near = between <= reach[:, None] + reach[None, :] + np.arccos(threshold) + 1e-6
    near |= np.eye(len(pivots), dtype=bool)
    kind = vectors.schema["v"].dataType.simpleString()
    paired = vectors.select("id", "n", "v").mapInArrow(
        _pairs(pivots, np.cumsum(blocks) - blocks, blocks, near), f"pair bigint, high boolean, id bigint, n bigint, v {kind}"
    )
    total = int(blocks.sum())
    return paired.repartition("pair").sortWithinPartitions("pair").mapInArrow(
        _tiles(threshold, total), "id bigint, links bigint, root bigint"
    )


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``(id, n_links, component, kept)`` for every row.

    Rows are linked if the cosine of their vectors, in double precision, is at least ``threshold``;
    equal vectors count each other. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, and vectors of different length never do. Rows that repeat an id
    are rows like others, and count in ``n_links``. Ids are whole numbers; a row whose id is null
    has no component. An empty table gives an empty result; other columns are not read.
    """
    kind = vectors.schema[vector_column].dataType.simpleString()
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("v"))
    rows = stored(rows.mapInArrow(_prepared, f"id bigint, v {kind}, digest binary, dims int"), "vectors")
    # Equal vectors once: copies are only counted.
    distinct = rows.filter("dims > 0 AND id IS NOT NULL").groupBy("digest").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "v")).alias("first"), F.first("dims").alias("dims")
    )
    distinct = stored(distinct.select("digest", "dims", "n", "first.id", "first.v"), "distinct-vectors")
    found = rows.sparkSession.createDataFrame([], "id bigint, links bigint, root bigint")
    for r in distinct.select("dims").distinct().collect():
        found = found.union(linked_vectors(distinct.filter(F.col("dims") == r.dims), threshold))
    found = stored(found, "links")
    components = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = distinct.select("digest", "id", "n").join(links, "id", "left").join(components, F.col("id") == F.col("node"), "left")
    classes = classes.select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    sound = (F.col("dims") > 0) & F.col("id").isNotNull()
    joined = rows.select("id", "dims", F.when(sound, F.col("digest")).alias("digest")).join(classes, "digest", "left")
    component = F.coalesce("component", "id")
    return joined.select(
        "id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component"), (F.col("id") == component).alias("kept")
    )
