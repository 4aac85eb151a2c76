"""Benchmark passages in documents, by the q-gram lemma in diagonal bands.

A benchmark text is cut into overlapping pieces. A stretch of a document within ``e`` edits of a piece
of length ``n`` shares at least ``n - q + 1 - e q`` of its q-grams, on diagonals that differ by ``e`` at
most. So shared q-grams are counted in overlapping bands of diagonals, and only bands that reach this
count are aligned, within the band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 10  # small enough for whole items of 20 characters with an edit: size - Q + 1 - edits * Q is 1 at least
PIECE = 60  # characters of a piece, after folding
STRIDE = 10  # any run of PIECE + STRIDE - 1 characters of an item holds a whole piece
EDIT_RATE = 0.05
BLOCK_CHARS = 4 << 20  # benchmark text in one index; a larger benchmark is searched in several blocks
BATCH_CHARS = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
APART = 0x10FFFF  # stands between documents; no text has it after folding
BITS = 22


def folding() -> np.ndarray:
    """For each character of the basic plane: lower case of letters and digits, and a blank for all others."""
    table = np.full(0x10000, 32, dtype=np.uint32)
    for code in range(0x10000):
        if chr(code).isalnum():
            table[code] = ord(chr(code).lower()[0])
    return table


def fold(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's folded characters, runs of blanks as one, and where in the text each stands."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    folded = np.where(codes < 0x10000, table[np.minimum(codes, 0xFFFF)], codes)
    blank = folded == 32
    keep = np.flatnonzero(~(blank & np.append(True, blank[:-1])))
    return folded[keep], keep


def gram_hashes(codes: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` characters from each place on."""
    if len(codes) < Q:
        return np.zeros(0, dtype=np.uint64)
    sums = np.append(np.uint64(0), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], dtype=np.uint64))
    hashes = (sums[Q:] - sums[:-Q]) * down[: len(codes) - Q + 1]
    hashes ^= hashes >> np.uint64(32)
    return hashes * np.uint64(0xD6E8FEB86659FD93)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        row = np.full(n, base, dtype=np.uint64)
        row[0] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    return out[0], out[1]


@dataclass
class Index:
    """Pieces of a block of benchmark items and their q-grams."""

    items: list[int]  # of each piece
    pieces: list[np.ndarray]
    budgets: np.ndarray
    needed: np.ndarray
    totals: dict[int, int]  # pieces of each item
    grams: np.ndarray  # distinct hashes, ascending
    starts: np.ndarray  # of each gram's postings
    piece_of: np.ndarray
    place_of: np.ndarray


def build_index(rows: list[tuple[int, str]], rate: float = EDIT_RATE) -> Index:
    table = folding()
    items, pieces = [], []
    for item, text in rows:
        codes, _ = fold(text, table)
        codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
        last = max(len(codes) - PIECE, 0)
        for at in [*range(0, last, STRIDE), last]:
            if len(codes) >= Q:
                items.append(item)
                pieces.append(codes[at : at + PIECE])
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    budgets = np.minimum((rate * sizes).astype(np.int64), (sizes - Q) // Q)
    up, down = powers(PIECE + 1)
    hashes = [gram_hashes(p, up, down) for p in pieces]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    piece = np.repeat(np.arange(len(pieces)), [len(h) for h in hashes]).astype(np.int64)
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, dtype=np.int64)
    order = np.argsort(flat, kind="stable")
    grams, starts = np.unique(flat[order], return_index=True)
    totals: dict[int, int] = {}
    for item in items:
        totals[item] = totals.get(item, 0) + 1
    return Index(
        items, pieces, budgets, sizes - Q + 1 - budgets * Q, totals, grams, np.append(starts, len(flat)), piece[order], place[order]
    )


def candidates(codes: np.ndarray, hashes: np.ndarray, index: Index, seen: np.ndarray) -> np.ndarray:
    """Rows ``(piece, first diagonal, last diagonal)`` of the bands with enough shared q-grams."""
    at = np.flatnonzero(seen[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
    gram = np.searchsorted(index.grams, hashes[at])
    real = (gram < len(index.grams)) & (index.grams[np.minimum(gram, len(index.grams) - 1)] == hashes[at])
    at, gram = at[real], gram[real]
    count = index.starts[gram + 1] - index.starts[gram]
    posting = np.arange(count.sum()) + np.repeat(index.starts[gram] - np.cumsum(count) + count, count)
    piece = index.piece_of[posting]
    # Diagonals of different documents are far apart, as places count through the whole batch.
    diagonal = np.repeat(at, count) - index.place_of[posting] + PIECE
    step = index.budgets[piece] + 1
    band = np.concatenate([diagonal // step, diagonal // step - 1])
    key = np.tile(piece, 2) * (len(codes) + 2 * PIECE + 2) + band + 1
    keys, shared = np.unique(key, return_counts=True)
    piece, band = keys // (len(codes) + 2 * PIECE + 2), keys % (len(codes) + 2 * PIECE + 2) - 1
    enough = shared >= index.needed[piece]
    piece, band = piece[enough], band[enough]
    first = band * (index.budgets[piece] + 1) - PIECE
    return np.column_stack([piece, first, first + 2 * index.budgets[piece] + 1])


def align(piece: np.ndarray, codes: np.ndarray, first: int, last: int, budget: int) -> tuple[int, int, int] | None:
    """Least edits of ``piece`` against a stretch of ``codes`` in a band of diagonals, with the stretch; None over budget.

    The path may leave the diagonals ``first`` to ``last`` by as many steps as the budget allows.
    """
    low, high = first - budget, last + budget
    width = high - low + 1
    far = budget + 1
    padded = np.full(width + len(piece), APART, dtype=np.int64)
    lo, hi = max(low, 0), min(low + len(padded), len(codes))
    if hi > lo:
        padded[lo - low : hi - low] = codes[lo:hi]
    cost, begin = np.zeros(width + 1, dtype=np.int64), np.arange(width + 1)
    cost[-1] = far
    steps = np.arange(width)
    for i in range(len(piece)):
        # Column k of row i ends at place low + i + k: keep or change a character, or leave it out.
        change = cost[:-1] + (padded[i : i + width] != piece[i])
        out = cost[1:] + 1
        best = np.minimum(change, out)
        start = np.where(change <= out, begin[:-1], begin[1:])
        # One more character of the document: a running minimum along the row.
        ahead = np.minimum.accumulate((best - steps) * (width + 1) + steps)
        source = ahead % (width + 1)
        cost = np.append(best[source] + steps - source, far)
        begin = np.append(start[source], 0)
    k = int(cost[:-1].argmin())
    if cost[k] > budget:
        return None
    return int(cost[k]), low + int(begin[k]), low + len(piece) + k


def search(batch: list[tuple[int, str]], index: Index, table: np.ndarray, up: np.ndarray, down: np.ndarray, seen: np.ndarray):
    """Leaks ``(number, item, edits, start, stop, pieces found)`` in numbered texts, places in characters of the text."""
    folded = [fold(text, table) for _, text in batch]
    apart = np.array([APART], dtype=np.uint32)
    codes = np.concatenate([x for f, _ in folded for x in (f, apart)])
    hashes = np.concatenate([gram_hashes(codes[lo : lo + len(up)], up, down) for lo in range(0, len(codes), len(up) - Q + 1)])
    stops = np.cumsum([len(f) + 1 for f, _ in folded])
    found: dict[tuple[int, int], dict[int, tuple[int, int, int]]] = {}
    for piece, first, last in candidates(codes, hashes, index, seen).tolist():
        middle = min(max((first + last) // 2 + len(index.pieces[piece]) // 2, 0), len(codes) - 1)
        for number in {int(np.searchsorted(stops, x, side="right")) for x in (max(middle - PIECE, 0), middle, min(middle + PIECE, len(codes) - 1))}:
            own = (number, index.items[piece])
            if piece in found.get(own, {}):
                continue
            begin = int(stops[number]) - len(folded[number][0]) - 1
            hit = align(index.pieces[piece], folded[number][0], first - begin, last - begin, int(index.budgets[piece]))
            if hit:
                found.setdefault(own, {})[piece] = hit
    for (number, item), hits in found.items():
        places = folded[number][1]
        start = min(int(places[min(max(s, 0), len(places) - 1)]) for _, s, _ in hits.values())
        stop = max(int(places[min(max(e, 1), len(places)) - 1]) + 1 for _, _, e in hits.values())
        yield number, item, min(e for e, _, _ in hits.values()), start, stop, len(hits)


def _batch_leaks(texts: pa.Array, index: Index, tables: tuple) -> list[tuple]:
    """Leaks as from ``search``, numbered by the texts' places, a bounded number of characters at a time."""
    held: list[tuple[int, str]] = []
    size, numbers, out = 0, [], []
    for number in range(len(texts) + 1):
        if held and (number == len(texts) or size > BATCH_CHARS):
            out += [(numbers[n], *rest) for n, *rest in search(held, index, *tables)]
            held, size, numbers = [], 0, []
        if number < len(texts) and (text := texts[number].as_py()):
            held.append((number, text))
            numbers.append(number)
            size += len(text)
    return out


def _tables(index: Index) -> tuple:
    seen = np.zeros(1 << BITS, dtype=bool)
    seen[(index.grams >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return (folding(), *powers(1 << 20), seen)


def _searched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(**shared.value)
        tables = _tables(index)
        names = ["id", "item_id", "edits", "start", "stop", "pieces", "all_pieces"]
        for batch in batches:
            out = _batch_leaks(batch.column(1), index, tables)
            if out:
                number, *columns = zip(*out, strict=True)
                columns.append([index.totals[item] for item in columns[0]])
                ids = batch.column(0).take(pa.array(number))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns)], names)

    return run


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, item_id, edits, start, stop, pieces, all_pieces)``: a row per document and item found in it.

    Case, punctuation and the width of gaps don't count. An item is found where one of its pieces of
    ``PIECE`` characters (the whole item, if shorter) lies within ``rate`` edits a character. Pieces begin every ``STRIDE``
    characters, so each verbatim run of ``PIECE + STRIDE - 1`` folded characters of an item is found;
    ``pieces`` of ``all_pieces`` were found, the best with ``edits`` edits, from character ``start`` to
    ``stop`` of the text. Null and empty texts hold nothing; items that are null or have under ``Q``
    letters, digits and gaps are nowhere; repeated rows repeat what they hold; an empty table on
    either side gives an empty result. A benchmark of any size is searched, a block at a time.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {kind}, item_id bigint, edits bigint, start bigint, stop bigint, pieces bigint, all_pieces bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    for shared in _indexes(benchmark, rate):
        found = found.union(rows.mapInArrow(_searched(shared), schema))
    return found


def _indexes(benchmark: DataFrame, rate: float) -> Iterator:
    """Broadcast indexes of the benchmark's blocks, each of about ``BLOCK_CHARS`` characters."""
    spark = benchmark.sparkSession
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    blocks = 1 + (items.agg(F.sum(F.length("text"))).head()[0] or 0) // BLOCK_CHARS
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = build_index(sorted((r.item_id, r.text) for r in part.collect()), rate)
        if index.items:
            yield spark.sparkContext.broadcast(vars(index))  # plain arrays: workers need no class to read them


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, text_column: str = "text") -> DataFrame:
    """The rows, with all columns, in which ``find_leaks`` finds nothing."""

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(**shared.value)
            tables = _tables(index)
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[number for number, *_ in _batch_leaks(batch.column(text_column), index, tables)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for shared in _indexes(benchmark, rate):
        docs = docs.mapInArrow(clean(shared), docs.schema)
    return docs
