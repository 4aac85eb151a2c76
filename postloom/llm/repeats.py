"""Long repeated byte strings, by longest-previous-factor arrays over suffix order.

Two equal strings of ``min_bytes`` hold equal short grams at equal places, so each window of that
length names its smallest gram hash as its anchor, and equal windows name equal anchors. Only windows
whose anchor occurs twice can be repeated. Of those,

* stretches of windows with one anchor that are equal byte for byte are counted by their digest, and
* what differs (the ends of shared passages) is brought together by anchor, and sorted as suffixes:
  the previous and next smaller positions in that order give each window's earlier match.

Anchors with very many different surroundings are compared window by window, pre-aggregated, so no
task has to hold all places of one anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.tables import stored

MIN_BYTES = 200
GRAM = 64  # bytes of an anchor
PIECE = 1 << 18  # bytes searched at a time; places in a piece take PLACE_BITS bits
PLACE_BITS = 22
SORTED_BYTES = 1 << 18  # bytes sorted at a time
HOT_CLASSES = 2000  # anchors with more different surroundings are compared window by window
BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def anchor_runs(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, min_bytes: int, gram: int):
    """Runs of windows with equal anchors in each text ``data[start:stop]``: ``(text, lo, hi, places, hash)``.

    ``lo`` and ``hi`` are the first and last window start, as places in ``data``; ``places`` counts the
    places that the run's anchor stands at, which are several where the text repeats itself.
    """
    n, width = len(data), min_bytes - gram + 1
    grams = n - gram + 1
    if grams < width:
        return (np.zeros(0, dtype=np.int64),) * 4 + (np.zeros(0, dtype=np.uint64),)
    up, down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64))
    hashes = (sums[gram:] - sums[:-gram]) * down[:grams]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~mask) | np.arange(grams, dtype=np.uint64)
    # Minimum over each ``width`` keys: from blocks' running minima forwards and backwards.
    blocks = np.full(-(-grams // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:grams] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - min_bytes + 1
    anchor = (np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & mask).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), stops - starts)[:windows]
    inside = np.arange(windows) + min_bytes <= stops[text]
    named = hashes[anchor]
    change = np.append(True, (named[1:] != named[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1]))
    # A text that repeats itself names one anchor for long: such runs are cut every ``width`` windows.
    begin = np.flatnonzero(change)
    change |= (np.arange(windows) - begin[np.cumsum(change) - 1]) % width == 0
    lo = np.flatnonzero(change)
    hi = np.append(lo[1:], windows) - 1
    moves = np.append(0, np.cumsum(anchor[1:] != anchor[:-1]))
    lo, hi = lo[inside[lo]], hi[inside[lo]]
    return text[lo], lo, hi, moves[hi] - moves[lo] + 1, named[lo]


def _anchors(min_bytes: int, gram: int):
    """Packed rows ``(row, packed)`` to ``(row, anchor, digest, lo, size, places)``."""

    def found(rows: list[int], offsets: list[int], parts: list[bytes]) -> pa.RecordBatch:
        joined = b"".join(parts)
        stops = np.cumsum([len(p) for p in parts])
        starts = stops - [len(p) for p in parts]
        text, lo, hi, places, hashes = anchor_runs(np.frombuffer(joined, dtype=np.uint8), starts, stops, min_bytes, gram)
        digest, view = xxhash.xxh3_64_intdigest, memoryview(joined)
        ends = (hi + min_bytes).tolist()
        digests = [digest(view[a:b]) for a, b in zip(lo.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(rows, dtype=np.int64)[text]),
                pa.array(hashes.view(np.int64)),
                pa.array(np.array(digests, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(offsets, dtype=np.int64)[text] + lo - starts[text]),
                pa.array((hi - lo + 1).astype(np.int32)),
                pa.array(places.astype(np.int32)),
            ],
            ["row", "anchor", "digest", "lo", "size", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        rows, offsets, parts, size = [], [], [], 0
        for batch in batches:
            for row, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = unpack(packed.as_py())
                # Pieces of a long text overlap so that each window lies in exactly one of them.
                for at in range(0, max(len(text) - min_bytes + 1, 0), PIECE):
                    part = text[at : at + PIECE + min_bytes - 1]
                    if size + len(part) > PIECE and parts:
                        yield found(rows, offsets, parts)
                        rows, offsets, parts, size = [], [], [], 0
                    rows.append(row)
                    offsets.append(at)
                    parts.append(part)
                    size += len(part)
        if parts:
            yield found(rows, offsets, parts)

    return run


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ahead = keys[order]
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.append(0, np.cumsum(ahead[1:] != ahead[:-1]))
    return ranks


def suffix_order(data: np.ndarray, places: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``places`` of ``data`` in order of the ``depth`` bytes that follow, by prefix doubling.

    Also returns, for each entry, where the run of equal ``depth``-byte prefixes that it is in begins.
    """
    n = len(data)
    padded = np.append(data, np.zeros(depth + 8, dtype=np.uint8)).astype(np.uint64)
    width, keys = 1, padded
    while width < 8 and width * 2 <= depth:
        keys = (keys[: len(keys) - width] << np.uint64(8 * width)) | keys[width:]
        width *= 2
    ranks = _ranks(keys[: n + 1])
    while width * 2 <= depth:
        tail = np.append(ranks, np.zeros(width, dtype=np.int64))[width : width + len(ranks)]
        ranks = _ranks(ranks * (n + 2) + tail)
        width *= 2
    # Two overlapping prefixes of length ``width`` cover ``depth`` bytes.
    keys = ranks[places] * (n + 2) + ranks[np.minimum(places + depth - width, n)]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, dtype=bool)
    return order, np.flatnonzero(first)[np.cumsum(first) - 1] if len(keys) else np.zeros(0, dtype=np.int64)


def previous_smaller(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place of its run (from ``begin``) with a smaller value, else -1."""
    before = np.arange(len(values)) - 1
    before[before < begin] = -1
    while True:
        jump = np.flatnonzero((before >= 0) & (values[before] > values))
        if not len(jump):
            return before
        before[jump] = before[before[jump]]


def has_previous_factor(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor reaches the depth of the order.

    ``values`` are text positions in suffix order. An earlier position with a prefix as long can only
    be the previous or next smaller one within the run of equal prefixes.
    """
    n = len(values)
    stop = np.append(begin[1:] != begin[:-1], True) if n else np.zeros(0, dtype=bool)
    last = np.flatnonzero(stop)[np.cumsum(np.append(False, stop[:-1]))] if n else begin
    behind = previous_smaller(values[::-1], (n - 1 - last)[::-1])[::-1]
    return (previous_smaller(values, begin) >= 0) | (behind >= 0)


def _sorted_surroundings(min_bytes: int, keep_first: bool):
    """Rows ``(anchor, row, lo, size, region)`` in order of anchor to spans ``(row, start, stop)``."""

    def solve(rows, los, sizes, regions) -> pa.RecordBatch:
        lengths = np.array([len(r) for r in regions], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        region = np.repeat(np.arange(len(sizes)), sizes)
        within = np.arange(len(region)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order, begin = suffix_order(np.frombuffer(b"".join(regions), dtype=np.uint8), starts[region] + within, min_bytes)
        place = np.empty(len(rows), dtype=np.int64)
        place[np.lexsort((los, rows))] = np.arange(len(rows))
        position = (place[region] * (int(sizes.max()) + 1) + within)[order]
        repeated = has_previous_factor(position, begin)
        if not keep_first:
            repeated |= has_previous_factor(-position, begin)
        flags = np.zeros(len(region), dtype=bool)
        flags[order] = repeated
        first = flags & np.append(True, ~flags[:-1] | (within[1:] == 0))
        last = flags & np.append(~flags[1:] | (within[1:] == 0), True)
        at = np.flatnonzero(first)
        start = los[region[at]] + within[at]
        stop = los[region[at]] + within[np.flatnonzero(last)] + min_bytes
        return pa.RecordBatch.from_arrays([pa.array(rows[region[at]]), pa.array(start), pa.array(stop)], ["row", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > SORTED_BYTES and entry[0] != held[-1][0]:
                    _, rows, los, sizes, regions = zip(*held, strict=True)
                    yield solve(*(np.array(x, dtype=np.int64) for x in (rows, los, sizes)), regions)
                    held, size = [], 0
                held.append(entry)
                size += len(entry[4])
        if held:
            _, rows, los, sizes, regions = zip(*held, strict=True)
            yield solve(*(np.array(x, dtype=np.int64) for x in (rows, los, sizes)), regions)

    return run


def _regions(min_bytes: int):
    """Rows ``(row, packed, runs)`` to each run's bytes: ``(anchor, row, lo, size, region)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = ["anchor", "row", "lo", "size", "region"]
        for batch in batches:
            out, size = [], 0
            for row, packed, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                text = unpack(packed.as_py())
                for x in runs.as_py():
                    out.append((x["anchor"], row, x["lo"], x["size"], text[x["lo"] : x["lo"] + x["size"] + min_bytes - 1]))
                    size += x["size"] + min_bytes
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    return run


def _windows(min_bytes: int):
    """Rows ``(anchor, row, lo, size, region)`` to a digest of each window: ``(h1, h2, row, start)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, row, lo, size, region in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digests = b"".join(xxhash.xxh3_128_digest(region[i : i + min_bytes]) for i in range(size))
                pair = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), pa.array(np.full(size, row)), pa.array(np.arange(lo, lo + size))],
                    ["h1", "h2", "row", "start"],
                )

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, packed, spans)`` to ``(id, n_bytes, n_removed, n_spans, kept)``."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        counts, kept = [], []
        for packed, spans in zip(batch.column(1), batch.column(2), strict=True):
            text = unpack(packed.as_py())
            merged: list[list[int]] = []
            for x in sorted((s["start"], s["stop"]) for s in spans.as_py() or ()):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            edges = [0, *(e for span in merged for e in span), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            counts.append((len(text), len(text) - len(rest), len(merged)))
            kept.append(rest)
        columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] if counts else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = [pack((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "packed"])


def remove_repeats(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    keep_first: bool = True,
    gram: int = GRAM,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id, n_bytes, n_removed, n_spans, kept`` (binary: the bytes left).

    Each byte in a string of ``min_bytes`` bytes that starts elsewhere too, in any row or the same,
    is removed; with ``keep_first``, strings whose earlier start is nowhere stay. Rows stand in an
    order of their own, which is fixed during a run. Strings overlap freely, never run across rows,
    and are judged on the input. A null text counts as empty; rows may repeat ids or texts; an empty
    table gives an empty result; other columns are not read. Spans are cut by bytes, so what is left
    need not be valid UTF-8.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    # Compressed once: the texts move twice.
    packed = texts.mapInArrow(_pack, f"id {kind}, packed binary")
    packed = stored(packed.withColumn("row", F.monotonically_increasing_id()), "texts")
    runs = packed.select("row", "packed").mapInArrow(
        _anchors(min_bytes, gram), "row bigint, anchor bigint, digest bigint, lo bigint, size int, places int"
    )
    runs = stored(runs, "anchors")
    # Counts are written out before they are joined, so that both sides of the join are dealt anew and hot anchors can be split.
    often = stored(runs.groupBy("anchor").agg(F.sum("places").alias("n")).filter("n > 1").select("anchor"), "often")
    runs = stored(runs.join(often, "anchor"), "repeated-anchors")
    classes = runs.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.max("places").alias("places"), F.min(F.struct("row", "lo", "size")).alias("first")
    )
    classes = stored(classes, "classes")
    # Equal surroundings: every window of the run is repeated.
    whole = runs.join(classes.filter("n > 1").select("anchor", "digest", "first"), ["anchor", "digest"])
    if keep_first:
        whole = whole.filter("row <> first.row OR lo <> first.lo")
    spans = whole.select("row", F.col("lo").alias("start"), (F.col("lo") + F.col("size") + (min_bytes - 1)).alias("stop"))
    # Different surroundings of one anchor, or one that repeats itself: one of each kind is compared with the others.
    kinds = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("places").alias("places"))
    kinds = stored(kinds.filter("kinds > 1 OR places > 1").select("anchor", "kinds"), "kinds")
    odd = classes.join(kinds, "anchor").select("anchor", "first.row", "first.lo", "first.size", (F.col("kinds") > HOT_CLASSES).alias("hot"))
    odd = stored(odd, "surroundings")

    def surroundings(hot: bool) -> DataFrame:
        wanted = odd.filter(F.col("hot") == hot).groupBy("row").agg(F.collect_list(F.struct("anchor", "lo", "size")).alias("runs"))
        return packed.join(wanted, "row").select("row", "packed", "runs").mapInArrow(
            _regions(min_bytes), "anchor bigint, row bigint, lo bigint, size bigint, region binary"
        )

    near = surroundings(False).repartition("anchor").sortWithinPartitions("anchor")
    spans = spans.union(near.mapInArrow(_sorted_surroundings(min_bytes, keep_first), "row bigint, start bigint, stop bigint"))
    if not odd.filter("hot").isEmpty():
        windows = surroundings(True).mapInArrow(_windows(min_bytes), "h1 bigint, h2 bigint, row bigint, start bigint")
        windows = stored(windows, "windows")
        equal = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("row", "start")).alias("first")).filter("n > 1")
        equal = windows.join(equal, ["h1", "h2"])
        if keep_first:
            equal = equal.filter("row <> first.row OR start <> first.start")
        spans = spans.union(equal.select("row", "start", (F.col("start") + min_bytes).alias("stop")))
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return packed.join(spans, "row", "left").select("id", "packed", "spans").mapInArrow(
        _cut, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
