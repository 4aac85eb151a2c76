"""Byte-level BPE: merges by rank over the byte arrays of distinct words, and decoding.

Texts are cut into words in Python, a bounded stretch of documents at a time, and each stretch lists
its distinct words once. Ranked merges are folded over arrays of the bytes of many words, a merge in
each word at a time, looking pairs up in a broadcast rank map. Words that the most stretches hold are
counted and folded beforehand, once for the whole corpus, and handed to all tasks, at most
``HEAD_WORDS`` of them; the others are folded where they stand. Last, the words' ids are laid out per
document. Only distinct words are shuffled; a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.tables import stored

STRETCH_BYTES = 32 << 20  # text per stretch; a longer document is a stretch of its own
STRETCH_WORDS = 250_000  # distinct words per stretch, likewise
HEAD_WORDS = 500_000  # words folded once for all; of at most FOLD_BYTES, so some tens of MB at most
HEAD_TASK_WORDS = 20_000
FOLD_BYTES = 128  # longer words are merged by a heap, in n log n steps instead of n squared
SLOTS_AN_ENTRY = 1.15, 1.2  # of the two tables of the rank map, so that both are less than half full
ID_SPACE = 1 << 20
NO_RANK = ID_SPACE - 1
FOLD_CHUNK = 1 << 16  # bytes of words folded together: few enough for the caches of a core
PLACE_BITS = 32

# Texts with no other characters than QUICK's may be cut by a pattern for the standard library, which is three
# times as fast as the general one. It says the same as the pattern of the 50k vocabularies.
_LETTERS, _NUMBERS, _SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
QUICK = "\0-\u024f"
QUICK_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines of a base64 piece and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _prime_from(number: int) -> int:
    return next(n for n in itertools.count(max(number, 2)) if all(n % k for k in range(2, math.isqrt(n) + 1)))


def placed(entries: dict[int, int]) -> tuple[list[int], list[int]]:
    """Two tables in which each key stands at its place in one of them, as ``key * ID_SPACE + value``.

    A key's place is its remainder by a table's size. It goes to its place in the first table; whoever stood
    there moves to its place in the other. Sizes are different primes and grow with the entries.
    """
    sizes = [_prime_from(101 + int(part * len(entries))) for part in SLOTS_AN_ENTRY]
    sizes[1] = _prime_from(max(sizes) + 1) if sizes[0] == sizes[1] else sizes[1]
    tables = ([-1] * sizes[0], [-1] * sizes[1])
    for key, value in entries.items():
        item = key * ID_SPACE + value
        for turn in range(500):
            side = turn % 2
            at = item // ID_SPACE % sizes[side]
            tables[side][at], item = item, tables[side][at]
            if item < 0:
                break
        else:
            raise ValueError("no place in the tables; raise SLOTS_AN_ENTRY")
    return tables


RankMap = tuple[np.ndarray, np.ndarray, np.ndarray]


def rank_map(ranks: dict[bytes, int]) -> RankMap:
    """The id of each byte, and from two adjacent ids to the rank of their joined bytes as two tables by ``placed``."""
    entries = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                entries[left * ID_SPACE + right] = rank
    one, two = (np.array(table, dtype=np.int64) for table in placed(entries))
    return np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64), one, two


def _ranks_of(left: np.ndarray, right: np.ndarray, table: RankMap) -> np.ndarray:
    """The rank of each two ids' merge, or ``NO_RANK``."""
    key = left * ID_SPACE + right
    found = np.full(len(key), NO_RANK)
    for places in table[1:]:
        item = places[key % len(places)]
        found = np.where(item >> 20 == key, item & (ID_SPACE - 1), found)
    return found


def fold_merges(values: np.ndarray, sizes: np.ndarray, table: RankMap) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of words whose byte values stand one after another: the lowest rank merges first, leftmost on a tie.

    The ids of word ``i`` are the ``size[i]`` from ``first[i]`` on in ``flat``, of ``(flat, first, size)``. Each
    piece has the rank of its merge with the next and its place as one number, so that a word's smallest number
    is its next merge.
    """
    first, size = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    word = np.flatnonzero(sizes)
    sizes = sizes[word].astype(np.int64)
    ids, done, begin = table[0][values], [], 0
    ends = np.cumsum(sizes)
    rank = np.append(_ranks_of(ids[:-1], ids[1:], table), NO_RANK)[: len(ids)]
    rank[ends - 1] = NO_RANK
    while len(word):
        starts = ends - sizes
        lowest = np.minimum.reduceat((rank << PLACE_BITS) + np.arange(len(rank)), starts)
        goes_on = lowest < NO_RANK << PLACE_BITS
        stay = np.repeat(goes_on, sizes)
        over = ~goes_on
        if over.any():
            own = sizes[over]
            first[word[over]], size[word[over]] = begin + np.cumsum(own) - own, own
            done.append(ids[~stay])
            begin += len(done[-1])
        at, word, sizes, starts = lowest[goes_on], word[goes_on], sizes[goes_on] - 1, starts[goes_on]
        new, at = at >> PLACE_BITS, at & ((1 << PLACE_BITS) - 1)
        ids[at] = new
        stay[at + 1] = False
        ids, rank = ids[stay], rank[stay]
        ends = np.cumsum(sizes)
        at += ends - sizes - starts
        # The new piece's merges with the next one and with the one before it.
        followed, led = at < ends - 1, at > ends - sizes
        rank[at[~followed]] = NO_RANK
        left = np.concatenate([at[followed], at[led] - 1])
        rank[left] = _ranks_of(ids[left], ids[left + 1], table)
    return np.concatenate(done) if done else ids, first, size


def fold_words(values: np.ndarray, sizes: np.ndarray, table: RankMap) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``fold_merges`` a bounded number of bytes at a time."""
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
    found, lo, begin = [], 0, 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + FOLD_CHUNK, "right")) - 1)
        flat, first, size = fold_merges(values[ends[lo] : ends[hi]], sizes[lo:hi], table)
        found.append((flat.astype("<u4"), first + begin, size))
        begin += len(flat)
        lo = hi
    if not found:
        return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    flat, first, size = (np.concatenate(x) for x in zip(*found, strict=True))
    return flat, first, size


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word, with a heap of pairs and links between neighbours."""
    n = len(word)
    end, left, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and (j := end[i]) < n:
            rank = ranks.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if gone[i] or end[i] != j or gone[j] or end[j] != stop:
            continue
        gone[j], end[i] = True, stop
        if stop < n:
            left[stop] = i
        offer(i)
        offer(left[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


def _cutter(pattern: str, quick_pattern: str | None):
    """A function from a text to its words."""
    import regex

    words_of = regex.compile(pattern).findall
    quickly = re.compile(quick_pattern).findall if quick_pattern else words_of
    others = re.compile(f"[^{QUICK}]").search
    return lambda text: words_of(text) if others(text) else quickly(text)


def _listed_words(pattern: str, quick_pattern: str | None):
    """Texts to the distinct words of each stretch that are short enough to fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cutter(pattern, quick_pattern)

        def rows(words: set[str]) -> pa.RecordBatch:
            listed = [w.encode("utf-8", "surrogatepass") for w in words]
            return pa.RecordBatch.from_arrays([pa.array([w for w in listed if len(w) <= FOLD_BYTES], pa.binary())], ["word"])

        words: set[str] = set()
        for batch in batches:
            for text in batch.column(0):
                if len(words) > STRETCH_WORDS:
                    yield rows(words)
                    words = set()
                words.update(cut(text.as_py() or ""))
        yield rows(words)

    return run


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words beside their byte values."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        ends = np.cumsum([0] + [len(w) for w in words], dtype=np.int32)
        values = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["word", "bytes"])


def head_words(texts: DataFrame, pattern: str, quick_pattern: str | None, folded) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words that most stretches hold, where each one's ids begin, and all ids one after another.

    ``folded`` is a function from a column of arrays of byte values to one of arrays of ids. Words are
    taken by the number of stretches, in tiers that are taken whole, up to ``HEAD_WORDS``; a word of one
    stretch is left to it.
    """
    found = texts.mapInArrow(_listed_words(pattern, quick_pattern), "word binary")
    counted = stored(found.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1"), "words")
    tier = F.floor(F.log2("n") * 8)
    sizes = {r[0]: r[1] for r in counted.groupBy(tier).count().collect()}  # some hundred rows
    lowest, held = None, 0
    for t in sorted(sizes, reverse=True):
        if held + sizes[t] > HEAD_WORDS:
            break
        lowest, held = t, held + sizes[t]
    if lowest is None:
        return pa.array([], pa.binary()), np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")
    spread = counted.filter(tier >= lowest).select("word").repartition(1 + held // HEAD_TASK_WORDS, "word")
    rows = spread.mapInArrow(_as_bytes, "word binary, bytes array<int>").select("word", folded(F.col("bytes")).alias("ids")).toArrow()
    ids = rows["ids"].combine_chunks()
    first = np.append(0, np.cumsum(ids.value_lengths().to_numpy(), dtype=np.int64))
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
    return rows["word"].combine_chunks(), first, flat


def _laid_out(pattern: str, quick_pattern: str | None, shared, head_shared, with_ids: bool):
    """Documents ``(id, text)`` to rows ``(id, n_tokens, ids, ids_sha256, decoded_sha256)``, a stretch of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cutter(pattern, quick_pattern)
        ranks, table = shared.value
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        # Sent as one Arrow array: the driver holds no object for each word.
        head_words_held, head_first, head_flat = head_shared.value
        head = {w: i for i, w in enumerate(head_words_held.to_pylist())}

        def solve(keys: list, places: list[np.ndarray], index: dict[str, int]) -> Iterator[pa.RecordBatch]:
            words = [w.encode("utf-8", "surrogatepass") for w in index]
            number = np.array([head.get(w, -1) for w in words], dtype=np.int64)
            known = number >= 0
            short = [w for w, h in zip(words, number.tolist(), strict=True) if h < 0 and len(w) <= FOLD_BYTES]
            length = np.array([len(w) for w in words], dtype=np.int64)
            folds = ~known & (length <= FOLD_BYTES)
            flat, own_first, own_size = fold_words(np.frombuffer(b"".join(short), dtype=np.uint8), length[folds], table)
            first, sizes = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
            first[folds], sizes[folds] = own_first, own_size
            first[known] = len(flat) + head_first[number[known]]
            sizes[known] = head_first[number[known] + 1] - head_first[number[known]]
            parts, begin = [flat, head_flat], len(flat) + len(head_flat)
            for at in np.flatnonzero(~known & ~folds).tolist():  # words too long to fold stand behind the others
                parts.append(np.array(merge_long(words[at], ranks), dtype="<u4"))
                first[at], sizes[at] = begin, len(parts[-1])
                begin += len(parts[-1])
            flat = np.concatenate(parts)
            rows: list[tuple[int, np.ndarray, str, str]] = []
            done, held = 0, 0
            for at in places:
                count = sizes[at]
                stop = np.cumsum(count)
                total = int(stop[-1]) if len(stop) else 0
                ids = flat[np.arange(total) + np.repeat(first[at] - stop + count, count)]
                decoded = hashlib.sha256(decode_ids(ids, pieces)).hexdigest()
                rows.append((total, ids.astype(np.int32) if with_ids else None, hashlib.sha256(ids.tobytes()).hexdigest(), decoded))
                held += total
                if held > 1_000_000:
                    yield _rows(keys[done : done + len(rows)], rows)
                    done, rows, held = done + len(rows), [], 0
            if rows:
                yield _rows(keys[done:], rows)

        id_type, keys, places, size = None, [], [], 0
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__

        def _rows(keys: list, rows: list) -> pa.RecordBatch:
            counts, lists, digests, decoded = zip(*rows, strict=True)
            columns = {"id": pa.array(keys, id_type), "n_tokens": pa.array(counts, pa.int64())}
            if with_ids:
                ends = pa.array(np.cumsum([0, *counts], dtype=np.int32))
                columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists)))
            columns |= {"ids_sha256": pa.array(digests), "decoded_sha256": pa.array(decoded)}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            id_type = batch.schema.types[0]
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py() or ""
                if keys and (size + len(text) > STRETCH_BYTES or len(index) > STRETCH_WORDS):
                    yield from solve(keys, places, index)
                    keys, places, size = [], [], 0
                    index.clear()
                places.append(np.array(list(map(index.__getitem__, cut(text))), dtype="<u4"))
                keys.append(key.as_py())
                size += len(text)
        if keys:
            yield from solve(keys, places, index)

    return run


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    quick_pattern: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """``(id, n_tokens, ids array<int>, ids_sha256, decoded_sha256)`` for every row, without special tokens.

    ``quick_pattern`` must say the same as ``pattern`` on texts of the characters in ``QUICK``.

    Each match of ``pattern`` is merged by itself. A null or empty text has no tokens. Equal rows
    give equal rows; nothing else is read, and an empty table gives an empty result. ``ids_sha256``
    digests the ids as little-endian unsigned 32-bit integers, ``decoded_sha256`` what they decode to.
    Without ``with_ids`` the ids themselves are left out.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    share = docs.sparkSession.sparkContext.broadcast
    shared = share((ranks, rank_map(ranks)))

    @F.arrow_udf("array<int>")
    def folded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            flat, first, size = fold_words(words.flatten().to_numpy(), words.value_lengths().to_numpy(), shared.value[1])
            ends = np.append(0, np.cumsum(size))
            ids = flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)].astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))

    head = share(head_words(rows.select("text"), pattern, quick_pattern, folded))
    schema = f"id {kind}, n_tokens bigint, " + "ids array<int>, " * with_ids + "ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(_laid_out(pattern, quick_pattern, shared, head, with_ids), schema)


def decode_ids(ids: np.ndarray, pieces: list[bytes]) -> bytes:
    """The bytes of ids: their pieces one after another."""
    return b"".join(map(pieces.__getitem__, ids.tolist()))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids: their pieces one after another. An unknown id is an error, null stays null."""
    pieces = {rank: piece for piece, rank in ranks.items()}
    listed = F.split(F.lit(",".join(pieces.get(i, b"").hex() for i in range(max(pieces) + 1))), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(listed, i + 1)), ""))
