"""Prefix trie of conversations: one row per distinct sequence of first turns.

A turn is two 64-bit hashes of role and text. Conversations are range partitioned by their sequence
of turns and then by id, so a node's members are neighbours, and a sequence that very many
conversations share is spread over shards like any other rows. Within a shard, turns lie in padded
matrices: lexsort orders the rows, masks of changed columns, OR-accumulated from the left, mark
where nodes start at each depth, and reduceat sums up every node of a depth at once. All measures
are sums over rows that need only a row's neighbour, so a node cut by shard borders is the sum of
its parts plus what the two rows at each border share. Those parts (the paths of a shard's first
and last row) meet by a digest of their turns; all other nodes are final in their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.tables import stored
from postloom.operators.joins import lookup_join

WIDTH = 8  # turns per matrix; rows that still tie go into the next one
SHARD_TURNS = 1 << 20  # turns per shard, about
PIECE_IDS = 1 << 16  # ids of conversations that end at one node, per piece
OUT_ROWS = 1 << 16
NODE = "key binary, parent_key binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
SHARD = f"kind int, place bigint, {NODE}, ends binary, turns array<bigint>, sizes array<bigint>"
FINAL, PART, BORDER = 0, 1, 2


def turn_sequences(turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """``(id, turns)``: turns as ``(h, g, size)`` in order, nulls first, ties by role and text; rows without an id are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    rows = turns.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.struct(
            F.col(turn_column).alias("turn"),
            role.alias("role"),
            F.xxhash64(role, text).alias("h"),
            F.xxhash64(F.lit("turn"), role, text).alias("g"),
            F.length(text).cast("bigint").alias("size"),
        ).alias("t"),
    )
    ordered = F.transform(F.array_sort("t"), lambda t: F.struct(t["h"].alias("h"), t["g"].alias("g"), t["size"].alias("size")))
    return rows.groupBy("id").agg(F.collect_list("t").alias("t")).select("id", ordered.alias("turns"))


def trie_order(ids: np.ndarray, offsets: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of their turns, then id, and how many first turns each shares with the row before it (-1 for the first).

    ``turns`` holds two numbers a turn; row i owns turns ``offsets[i]:offsets[i + 1]``.
    """
    n = len(ids)
    lengths = np.diff(offsets)
    order = np.argsort(ids, kind="stable")
    shared = np.full(n, -1, dtype=np.int64)
    group = np.zeros(n, dtype=np.int64)  # of each place: rows of one group agree in all turns so far
    places = np.arange(n)
    start = 0
    if n:
        shared[1:] = 0
    while len(places):
        rows = order[places]
        columns = np.minimum(lengths[rows] - start, WIDTH)
        width = int(columns.max(initial=0))
        if width <= 0:
            break
        at = offsets[rows][:, None] + start + np.arange(width)
        real = np.arange(width) < columns[:, None]
        at[~real] = 0
        matrix = np.where(real[..., None], turns.reshape(-1, 2)[at], 0)
        keys = [ids[rows], lengths[rows] > start + WIDTH]  # of rows that tie so far, those that end here come first
        for c in range(width - 1, -1, -1):
            keys += [matrix[:, c, 1], matrix[:, c, 0], real[:, c]]
        sorting = np.lexsort([*keys, group[places]])
        rows, matrix, real, columns = rows[sorting], matrix[sorting], real[sorting], columns[sorting]
        order[places] = rows
        # group[places] is sorted and stays as it is: sorting moves rows within groups only.
        same_group = np.append(False, group[places][1:] == group[places][:-1])
        change = np.ones((len(rows), width), dtype=bool)
        change[1:] = (matrix[1:] != matrix[:-1]).any(axis=2) | ~real[1:] | ~real[:-1]
        change = np.logical_or.accumulate(change, axis=1)
        equal = np.where(same_group, width - change.sum(axis=1), 0)
        shared[places] += equal
        tied = same_group & (equal == width) & (columns == WIDTH)
        group[places] = np.cumsum(~tied)
        going = lengths[rows] > start + WIDTH
        places = places[going]
        start += WIDTH
        # The first of a group to go on follows a row that ended right here, if any: they share all its turns, counted already.
    return order, shared


def path_keys(turns: np.ndarray) -> list[bytes]:
    """A digest of the first d turns for d = 0, 1, ...; ``turns`` is flat, two numbers a turn."""
    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    for turn in np.ascontiguousarray(turns, dtype="<i8").reshape(-1, 2):
        state.update(turn.tobytes())
        keys.append(state.digest())
    return keys


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shard_records(shard: int, ids: np.ndarray, offsets: np.ndarray, turns: np.ndarray, sizes: np.ndarray) -> Iterator[dict[str, list]]:
    """Columns of ``SHARD`` for one shard: final nodes, parts of nodes that may go on in other shards, and the border rows."""
    order, shared = trie_order(ids, offsets, turns)
    ids, begin, length = ids[order], offsets[:-1][order], np.diff(offsets)[order]
    last = len(ids) - 1
    leaf = np.append(shared[1:] < length[:-1], False)  # whether the last row's node goes on is known at the border only
    before = np.append(0, np.cumsum(sizes))  # code points before each turn of the shard
    reach = before[begin + np.maximum(shared, 0)]
    paths = [path_keys(turns[2 * begin[r] : 2 * (begin[r] + length[r])]) for r in (0, last)]
    empty = hashlib.sha256().digest()

    rows = np.arange(last + 1)
    parent_rows, parent_ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for depth in range(int(length.max()) + 1):
        rows = rows[length[rows] >= depth]
        starts = np.flatnonzero(shared[rows] < depth)
        first = rows[starts]
        conv = np.minimum.reduceat(ids[rows], starts)
        n_convs = np.diff(np.append(starts, len(rows)))
        opens = (length[rows] > depth) & (shared[rows] <= depth) & (rows > 0)
        n_children = np.add.reduceat(opens.astype(np.int64), starts)
        n_leaves = np.add.reduceat(leaf[rows].astype(np.int64), starts)
        again = np.where(shared[rows] >= depth, reach[rows] - before[begin[rows] + max(depth - 1, 0)], 0)
        saved = np.add.reduceat(again, starts)
        n_ends = np.add.reduceat((length[rows] == depth).astype(np.int64), starts)

        part = np.zeros(len(first), dtype=bool)
        part[0] |= rows[0] == 0
        part[-1] |= rows[-1] == last
        keys, parents = [None] * len(first), [None] * len(first)
        if depth:
            above = np.searchsorted(parent_rows, first, side="right") - 1
            parent = parent_ids[above]
            for path, whole in zip(paths, (0, len(parent_rows) - 1), strict=True):
                if len(path) >= depth:  # the path's node of the depth above is a part
                    for at in np.flatnonzero(above == whole) if parent_part[whole] else ():
                        parents[at] = path[depth - 1]
        for path, at in zip(paths, (0, -1), strict=True):
            if part[at] and len(path) > depth:
                keys[at] = path[depth]

        ends: list[bytes | None] = []
        pieces: list[tuple[int, bytes]] = []
        for at, (row, n) in enumerate(zip(first.tolist(), n_ends.tolist(), strict=True)):
            if keys[at] is None:
                ends.append(hashlib.sha256(_joined(ids[row : row + n])).digest() if n else empty)
            else:
                ends.append(None)
                pieces += [(at, _joined(ids[row + lo : min(row + n, row + lo + PIECE_IDS)])) for lo in range(0, n, PIECE_IDS)]
        known = [None if p is not None or not depth else c for p, c in zip(parents, (parent if depth else conv).tolist(), strict=True)]
        count = len(first)
        yield {
            "kind": [FINAL if k is None else PART for k in keys], "place": [shard << 32] * count, "key": keys, "parent_key": parents, "depth": [depth] * count,
            "conv_id": conv, "parent_conv_id": known, "n_convs": n_convs, "n_children": n_children, "n_leaves": n_leaves, "saved_tokens": saved, "ends": ends,
        }
        if pieces:
            yield {
                "kind": [PART] * len(pieces), "place": [(shard << 32) + i for i in range(len(pieces))], "key": [keys[at] for at, _ in pieces],
                "depth": [depth] * len(pieces), "ends": [text for _, text in pieces],
            }
        parent_rows, parent_ids, parent_part = first, conv, part
    border = [turns[2 * begin[r] : 2 * (begin[r] + length[r])] for r in (0, last)]
    yield {
        "kind": [BORDER] * 2, "place": [shard << 32, (shard << 32) + 1], "turns": border,
        "sizes": [sizes[begin[r] : begin[r] + length[r]] for r in (0, last)],
    }


def border_records(borders: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[dict[str, list]]:
    """What the shards' first and last rows, in order, add to the nodes on their paths."""
    held: tuple[np.ndarray, np.ndarray] | None = None  # the last row of the shard before

    def leaf(turns: np.ndarray, shared: int) -> Iterator[dict[str, list]]:
        keys = path_keys(turns)
        if shared < len(keys) - 1 or shared < 0:
            yield {"kind": [PART] * len(keys), "key": keys, "depth": list(range(len(keys))), "n_leaves": [1] * len(keys)}

    for number, (turns, sizes) in enumerate(borders):
        if number % 2:
            held = turns, sizes
            continue
        shared = -1
        if held is not None:
            common = min(len(held[0]), len(turns)) // 2
            differs = (held[0][: 2 * common] != turns[: 2 * common]).reshape(-1, 2).any(axis=1)
            shared = int(differs.argmax()) if differs.any() else common
            yield from leaf(held[0], shared)
        keys, depths = path_keys(turns), np.arange(len(sizes) + 1)
        before = np.append(0, np.cumsum(sizes))
        saved = np.where(depths <= shared, before[max(shared, 0)] - before[np.maximum(depths - 1, 0)], 0)
        opens = ((depths >= shared) & (depths < len(sizes))).astype(np.int64)
        yield {"kind": [PART] * len(keys), "key": keys, "depth": depths, "saved_tokens": saved, "n_children": opens}
    if held is not None:
        yield from leaf(held[0], -1)


def _batches(records: Iterator[dict[str, list]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for record in records:
        count = len(record["kind"])
        for lo in range(0, count, OUT_ROWS):
            columns = [
                pa.array(record[f.name][lo : lo + OUT_ROWS], f.type) if f.name in record else pa.nulls(min(count - lo, OUT_ROWS), f.type) for f in schema
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in SHARD.split(", "))])


def _solve_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    held = [(b.column(0).to_numpy(), b.column(1).value_lengths().to_numpy(zero_copy_only=False), b.column(1).flatten()) for b in batches if b.num_rows]
    if not held:
        return
    ids, lengths = (np.concatenate(part) for part in list(zip(*held, strict=True))[:2])
    h, g, sizes = (np.concatenate([flat.field(i).to_numpy(zero_copy_only=False) for _, _, flat in held]) for i in range(3))
    offsets = np.append(0, np.cumsum(lengths.astype(np.int64)))
    turns = np.stack([h, g], axis=1).reshape(-1)
    yield from _batches(shard_records(TaskContext.get().partitionId(), ids, offsets, turns, sizes), _arrow_schema())


def _solve_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for turns, sizes in zip(batch.column(1), batch.column(2), strict=True):
                yield np.array(turns.as_py(), dtype=np.int64), np.array(sizes.as_py(), dtype=np.int64)

    yield from _batches(border_records(rows()), _arrow_schema())


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key from pieces ``(key, place, ends)`` in order; a state is held, never the pieces."""
    key, state = None, hashlib.sha256()
    for batch in batches:
        out: list[tuple[bytes, bytes]] = []
        for this, piece in zip(batch.column(0), batch.column(2), strict=True):
            if this.as_py() != key:
                if key is not None:
                    out.append((key, state.digest()))
                key, state = this.as_py(), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_py())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.binary())], ["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.digest()], pa.binary())], ["key", "ends"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over ``conversations (id, turns)`` as :func:`turn_sequences` gives them.

    ``depth``, ``conv_id`` (smallest member), ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes in the subtree, itself included), ``saved_tokens``
    (code points that the subtree's nodes need not store again) and ``ends`` (SHA-256 over the comma
    separated ids, ascending, of the members that end there). Ids must be unique and not null.
    Conversations without turns are members of the root alone. Equal conversations share one path.
    Without conversations there is no node.
    """
    spark = conversations.sparkSession
    rows = stored(conversations.select("id", "turns"), "trie-rows")
    total = rows.agg(F.sum(F.size("turns") + 1)).head()[0] or 0
    by_sequence = [F.transform("turns", lambda t: F.struct(t["h"], t["g"])), F.col("id")]
    shards = -(-total // SHARD_TURNS)
    if shards > int(spark.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartitionByRange(shards, *by_sequence)
    else:
        rows = rows.repartitionByRange(*by_sequence)
    found = stored(rows.mapInArrow(_solve_shard, SHARD), "trie-shards")

    # Two rows a shard, however many conversations there are.
    borders = found.filter(F.col("kind") == BORDER).select("place", "turns", "sizes")
    borders = borders.repartition(1).sortWithinPartitions("place").mapInArrow(_solve_borders, SHARD)
    parts = found.filter(F.col("kind") == PART).unionAll(borders)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = parts.groupBy("key", "depth").agg(F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *sums)
    nodes = stored(nodes, "trie-parts")
    pieces = found.filter((F.col("kind") == PART) & F.col("ends").isNotNull()).select("key", "place", "ends")
    digests = pieces.repartition("key").sortWithinPartitions("key", "place").mapInArrow(_digest_pieces, "key binary, ends binary")
    nodes = nodes.join(digests, "key", "left").withColumn("ends", F.coalesce("ends", F.unhex(F.sha2(F.lit(""), 256))))

    parents = stored(nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "trie-parents")
    columns = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    final = found.filter(F.col("kind") == FINAL)
    waiting = final.filter(F.col("parent_key").isNotNull()).drop("parent_conv_id").unionByName(nodes, allowMissingColumns=True)
    return final.filter(F.col("parent_key").isNull()).select(columns).unionAll(lookup_join(waiting, parents, ["parent_key"], "left").select(columns))
