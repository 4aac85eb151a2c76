"""SimHash near-duplicates by a self-join over binary tries of fingerprints.

Fingerprints at most three bits apart agree in at least one of their four 16-bit quarters. So each is
filed four times, rotated to begin with each quarter in turn, and every first quarter is a trie of
its own. Within a trie, pairs of nodes go down together: the bits in which they differ add up, and a
pair is dropped once its sum exceeds the budget. Tries of over ``TRIE_ROWS`` fingerprints are cut
into blocks, and each pair of blocks is a task's work of its own; no trie is left out or cut short.

``near_copies`` does the same at a similarity of shingle sets: fingerprints are ``WIDE`` words long and
filed ``TURNS`` times, by ``PREFIX`` bits each; a traversal may differ in more bits of the 64 from there
on, and a leaf counts by the bits in which whole fingerprints differ.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.components import connected_components, local_components
from postloom.llm.tables import stored
from postloom.operators.dedupe import PLACE, at_places, stored_with_places

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 3  # differing bits; the four rotations rest on its being 3
QUARTER = 16
TRIE_ROWS = 4096
CHUNK_ROWS = 60_000
FRONTIER = 1 << 20

COPY_WORDS = 5
SIMILARITY = 0.8  # Jaccard of two texts' sets of shingles
WIDE = 8  # 64-bit words of a fingerprint
TURNS = 18  # stretches of PREFIX bits by which a fingerprint is filed
PREFIX = 14  # bits that select a trie; two texts at the similarity agree in one of TURNS stretches with 0.85
PASSES = (1, 2, 4, 7, 11)  # budgets of the traversals, for the 64 bits from a trie's first on


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles as an unsigned number; 0 for a text without words."""
    # bytes.lower and bytes.split know ASCII only: A-Z, blank and 0x09-0x0D.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[lo : lo + 65_536].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is a bigint with the fingerprint's bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def wide_fingerprint(text: str | None) -> np.ndarray:
    """SimHash of ``WIDE`` words over a text's set of ``COPY_WORDS``-word shingles; zeros for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(WIDE, dtype=np.uint64)
    many = max(len(words) - COPY_WORDS + 1, 1)
    shingles = map(b" ".join, zip(*(words[i : i + many] for i in range(min(COPY_WORDS, len(words)))), strict=True))
    digest = xxhash.xxh64_intdigest
    hashes = np.unique(np.array([digest(s, SEED) for s in shingles], dtype=np.uint64))
    ones = np.zeros(64 * WIDE, dtype=np.int64)
    for lo in range(0, len(hashes), 16_384):
        x = hashes[lo : lo + 16_384, None] + np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8 * WIDE), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).view(">u8").astype(np.uint64)


def most_apart(similarity: float) -> int:
    """Bits in which wide fingerprints of texts at this similarity differ on average."""
    return round(64 * WIDE * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def trie_links(
    values: np.ndarray,
    starts: np.ndarray,
    skip: int,
    passes: Sequence[int] = range(1, BUDGET + 1),
    whole: np.ndarray | None = None,
    most: int = 0,
) -> np.ndarray:
    """Local component of every value; equal components are linked by steps of at most the last pass's bits.

    With ``whole`` a step is instead one of at most ``most`` bits between the rows of ``whole``.

    ``values`` (unsigned, ascending within each trie, all distinct there) holds several tries, which
    begin at ``starts``; the first ``skip`` bits are the same throughout a trie. The traversal runs
    with the budgets of ``passes`` in turn, and leaves out pairs of nodes whose leaves already form one
    component, so a dense group of near copies isn't compared pair by pair.
    """
    n = len(values)
    label = np.arange(n)
    ends = np.append(starts[1:], n)
    wide = ends - starts > 1
    roots = np.stack([starts[wide], ends[wide]])
    sums: dict[int, np.ndarray] = {}

    def ones_before(level: int) -> np.ndarray:
        if level not in sums:
            bit = (values >> np.uint64(63 - level)) & np.uint64(1)
            sums[level] = np.append(0, np.cumsum(bit.astype(np.int64)))
        return sums[level]

    for allowed in passes:
        breaks = np.append(0, np.cumsum(label[1:] != label[:-1]))
        found: list[np.ndarray] = []
        # A stack of frontiers: rows are first node (lo, hi), second node (lo, hi), differing bits.
        stack = [(skip, np.vstack([roots, roots, np.zeros((1, roots.shape[1]), dtype=np.int64)]))]
        while stack:
            level, pairs = stack.pop()
            if pairs.shape[1] > FRONTIER:
                half = pairs.shape[1] // 2
                stack += [(level, pairs[:, :half]), (level, pairs[:, half:])]
                continue
            one = (breaks[pairs[1] - 1] == breaks[pairs[0]]) & (breaks[pairs[3] - 1] == breaks[pairs[2]])
            pairs = pairs[:, ~(one & (label[pairs[0]] == label[pairs[2]]))]
            leaves = (pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)
            a, b = pairs[0, leaves], pairs[2, leaves]
            if whole is None:
                near = np.bitwise_count(values[a] ^ values[b]) <= allowed
            else:
                bits = (np.bitwise_count(column[a] ^ column[b]).astype(np.int64) for column in whole.T)
                near = sum(bits, np.zeros(len(a), dtype=np.int64)) <= most
            found.append(np.stack([a[near], b[near]]))
            pairs = pairs[:, ~leaves]
            if level == 64 or not pairs.shape[1]:
                continue
            before = ones_before(level)
            mid_a = pairs[1] - (before[pairs[1]] - before[pairs[0]])
            mid_b = pairs[3] - (before[pairs[3]] - before[pairs[2]])
            apart = pairs[4] + 1
            low_high = np.stack([pairs[0], mid_a, mid_b, pairs[3], apart])
            high_low = np.stack([mid_a, pairs[1], pairs[2], mid_b, apart])
            down = np.hstack(
                [
                    np.stack([pairs[0], mid_a, pairs[2], mid_b, pairs[4]]),
                    np.stack([mid_a, pairs[1], mid_b, pairs[3], pairs[4]]),
                    low_high[:, apart <= allowed],
                    high_low[:, (apart <= allowed) & (pairs[0] != pairs[2])],
                ]
            )
            filled = (down[1] > down[0]) & (down[3] > down[2])
            alone = (down[0] == down[2]) & (down[1] - down[0] == 1)
            stack.append((level + 1, down[:, filled & ~alone]))
        links = np.hstack(found) if found else np.zeros((2, 0), dtype=np.int64)
        # Components so far, and what this pass adds.
        known = np.flatnonzero(label != np.arange(n))
        label = local_components(n, np.append(links[0], known), np.append(links[1], label[known]))
    return label


def _links_of_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``(a, b)`` between representatives, from rows ``(key, value, rep)`` in order of key."""

    def solve(key: np.ndarray, value: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((value, key))
        key, value, rep = key[order], value[order], rep[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=int)
        label = trie_links(value, starts, QUARTER)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(rep[label[linked]]), pa.array(rep[linked])], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        key, value, rep = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        held.append((key, value.view(np.uint64), rep))
        rows += len(key)
        if rows >= CHUNK_ROWS:
            key, value, rep = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(key, key[-1]))  # the last trie may go on in the next batch
            if cut:
                yield solve(key[:cut], value[:cut], rep[:cut])
            held, rows = [(key[cut:], value[cut:], rep[cut:])], len(key) - cut
    if held:
        yield solve(*(np.concatenate(x) for x in zip(*held, strict=True)))


def fingerprint_links(reps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect ``reps (fp, rep)`` within the budget; ``fp`` must be distinct.

    Not every pair is listed: within a trie, links form stars, which connect the same rows.
    """
    turns = [
        F.struct(
            F.lit(q).alias("turn"),
            (F.shiftleft("fp", q * QUARTER).bitwiseOR(F.shiftrightunsigned("fp", 64 - q * QUARTER)) if q else F.col("fp")).alias("value"),
        )
        for q in range(64 // QUARTER)
    ]
    filed = reps.select("rep", F.explode(F.array(*turns)).alias("t")).select(
        "rep",
        "t.value",
        (F.shiftrightunsigned("t.value", 64 - QUARTER) + F.col("t.turn") * (1 << QUARTER)).alias("trie"),
    )
    # At most 4 x 65,536 rows of two numbers, whatever the input: safe to broadcast.
    large = filed.groupBy("trie").count().filter(F.col("count") > TRIE_ROWS)
    large = large.select("trie", F.ceil(2 * F.col("count") / TRIE_ROWS).cast("int").alias("blocks"))
    filed = filed.join(F.broadcast(large), "trie", "left")
    own = F.pmod(F.xxhash64("value"), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
        lambda other: F.when(F.col("blocks").isNull(), F.lit(0).cast("bigint")).otherwise(
            F.least(own, other) * F.col("blocks").cast("bigint") + F.greatest(own, other)
        ),
    )
    keyed = filed.select("value", "rep", "trie", F.explode(pair).alias("pair"))
    keyed = keyed.select((F.col("pair") * (4 << QUARTER) + F.col("trie")).alias("key"), "value", "rep")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links_of_tries, "a bigint, b bigint")


def _stretch_from(wide: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits of each row of ``wide`` from its place ``at`` on, cyclically."""
    row, word, bit = np.arange(len(wide)), at // 64, (at % 64).astype(np.uint64)
    low = wide[row, (word + 1) % WIDE] >> np.uint64(1) >> (np.uint64(63) - bit)
    return (wide[row, word] << bit) | low


def _copies_of_tries(most: int):
    """Links ``(a, b)`` between representatives, from rows ``(key, turn, w0 .., rep)`` in order of key."""

    def solve(key: np.ndarray, turn: np.ndarray, wide: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        value = _stretch_from(wide, turn * PREFIX)
        order = np.lexsort((value, key))
        key, value, wide, rep = key[order], value[order], wide[order], rep[order]
        # Rows equal in all 64 bits are linked at once; the first stands for them in the trie.
        new = np.append(True, (key[1:] != key[:-1]) | (value[1:] != value[:-1]))[: len(key)]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        own = key[head]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])
        label = head[trie_links(value[head], starts, PREFIX, PASSES, wide[head], most)][group]
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(rep[label[linked]]), pa.array(rep[linked])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            key, turn, *words, rep = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            held.append((key, turn, np.column_stack(words).view(np.uint64), rep))
            rows += len(key)
            if rows >= CHUNK_ROWS:
                parts = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = int(np.searchsorted(parts[0], parts[0][-1]))  # the last trie may go on in the next batch
                if cut:
                    yield solve(*(x[:cut] for x in parts))
                held, rows = [tuple(x[cut:] for x in parts)], len(parts[0]) - cut
        if rows:
            yield solve(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def copy_links(reps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links ``(a, b)`` that connect ``reps (w0 .., rep)``, distinct wide fingerprints, at the similarity."""
    words = [f"w{i}" for i in range(WIDE)]

    def prefix(turn: int) -> Column:
        word, bit = divmod(turn * PREFIX, 64)
        from_bit = F.shiftleft(words[word], bit)
        if bit:
            from_bit = from_bit.bitwiseOR(F.shiftrightunsigned(words[(word + 1) % WIDE], 64 - bit))
        return F.shiftrightunsigned(from_bit, 64 - PREFIX)

    filed = reps.select("*", F.posexplode(F.array(*(prefix(t) for t in range(TURNS)))).alias("turn", "prefix"))
    filed = filed.withColumn("trie", F.col("turn").cast("bigint") * (1 << PREFIX) + F.col("prefix")).drop("prefix")
    # At most 18 x 16,384 rows of two numbers, whatever the input: safe to broadcast.
    large = filed.groupBy("trie").count().filter(F.col("count") > TRIE_ROWS)
    large = large.select("trie", F.ceil(2 * F.col("count") / TRIE_ROWS).cast("int").alias("blocks"))
    filed = filed.join(F.broadcast(large), "trie", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64(*words), F.col("blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(own, other) * F.col("blocks").cast("bigint") + F.greatest(own, other),
    )
    keyed = filed.select("turn", *words, "rep", "trie", F.explode(pair).alias("pair"))
    keyed = keyed.select((F.col("pair") * (32 << PREFIX) + F.col("trie")).alias("key"), "turn", *words, "rep")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_copies_of_tries(most_apart(similarity)), "a bigint, b bigint")


def near_copies(
    docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text", also: Sequence[str] = ()
) -> DataFrame:
    """``(id, component)`` for every row: the smallest id reachable by steps of similar sets of five-word shingles.

    Columns ``also`` of ``docs`` come along.

    The similarity is judged by the bits in which wide fingerprints differ, so near the threshold some
    pairs fall on the other side. Nulls, empty texts, repeated rows and tables are as in ``near_duplicates``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = np.array([wide_fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64).reshape(-1, WIDE).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *(pa.array(w.copy()) for w in wide.T)], ["id", *also, *words])

    words = [f"w{i}" for i in range(WIDE)]
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"), *also)
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in also]
    schema = ", ".join(["id bigint", *kinds, *(f"{w} bigint" for w in words)])
    fps = stored(rows.mapInArrow(run, schema), "wide-fingerprints")
    reps = stored(fps.groupBy(*words).agg(F.min("id").alias("rep")).filter("rep IS NOT NULL"), "representatives")
    # A link's ends are ids; a repeated id with two texts joins them, as its rows are one document.
    found = connected_components(copy_links(reps, similarity))
    classes = reps.join(found, F.col("rep") == F.col("node"), "left").select(*words, F.coalesce("component", "rep").alias("component"))
    return fps.join(classes, words, "left").select("id", "component", *also)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``fp`` (bigint) and ``component`` (smallest id reachable).

    A null text counts as empty; texts without words share fingerprint 0 and are linked like any
    others. Rows with equal texts, and rows that repeat an id, share a fingerprint and so a
    component. Rows with a null id keep a null component if alone with their fingerprint. An empty
    table gives an empty result; other columns are not read. The id must be a whole number.
    """
    fps = stored(fingerprints(docs, id_column, text_column).withColumn("id", F.col("id").cast("bigint")), "fingerprints")
    reps = stored(fps.groupBy("fp").agg(F.min("id").alias("rep")).filter("rep IS NOT NULL"), "representatives")
    found = connected_components(fingerprint_links(reps))
    classes = reps.join(found, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component")
    )
    return fps.join(classes, "fp", "left").select("id", "fp", "component")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``near_copies``: the one with the smallest id.

    Rows that repeat an id are one row. Rows with a null id can't be told apart, and all stay. Rows are
    written once and their places are dealt with, so no text is shuffled.
    """
    rows = stored_with_places(docs, "llm-documents")
    found = stored(near_copies(rows, SIMILARITY, id_column, text_column, PLACE), "near-duplicates")
    place = F.struct(*PLACE)
    of_id = found.filter("id IS NOT NULL").groupBy("id").agg(F.max(F.col("id") != F.col("component")).alias("later"), F.min(place).alias("place"))
    kept = of_id.filter("later IS NOT TRUE").select("place.*").union(found.filter("id IS NULL").select(PLACE))
    return at_places(rows, kept, "llm-kept").select(docs.columns)
