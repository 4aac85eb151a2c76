"""Periodic runs of words: maximal stretches that repeat their first words several times.

Periods up to ``SMALL`` are found by comparing the words with themselves, shifted. For each dyadic
scale t, periods from 2t to 4t are proposed by a string synchronising set: the positions i where a
hash of the t words from i or from i + t is the smallest of all those that begin in between. Whether
a position is chosen depends on the 2t words from it alone, so in a run the choice repeats with the
period, and one chosen position meets its equal context exactly one period later. Windows with a
period of t/3 or less are never chosen (the set would be dense there): they lie in runs found at
smaller scales. In what remains of a run of period 2t or more there is always a chosen position.
Proposals are extended both ways by comparing hashes, and every run is then checked word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_EXPONENT = 4
MIN_WORDS = 6
SMALL = 3
CHUNK_WORDS = 1 << 17
# Two primes below 2^31 and a base for each.
MODULI = ((2147483647, 1000003), (2147483629, 998244353))
NONE = np.uint64(2**64 - 1)
RESULT = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A pseudo-random number for each number."""
    x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class WindowHashes:
    """62-bit hashes of any windows of a sequence, from prefix sums of a polynomial modulo two primes."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.parts = []
        values = _mixed(words)
        for prime, base in MODULI:
            p = np.uint64(prime)
            powers = np.ones(1, dtype=np.uint64)
            while len(powers) <= n:
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), prime)) % p])
            powers = powers[: n + 1]
            sums = np.cumsum(values % p * powers[:n] % p)
            self.parts.append((p, powers[::-1], np.append(np.uint64(0), sums) % p))

    def __call__(self, at: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        found = []
        for p, weights, sums in self.parts:
            found.append((sums[end] + p - sums[at]) % p * weights[at] % p)
        return (found[0] << np.uint64(31)) | found[1]


def _equal_ahead(h: WindowHashes, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """How many words from a on equal those from b on (a < b), by bisection."""
    low, high = np.zeros(len(a), dtype=np.int64), n - b
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = h(a, a + mid) == h(b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _equal_behind(h: WindowHashes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before a equal those before b (a < b)."""
    low, high = np.zeros(len(a), dtype=np.int64), a.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = h(a - mid, a) == h(b - mid, b)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def synchronising_set(h: WindowHashes, n: int, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions chosen at scale ``t``; ``periodic`` marks windows of t words with a period of t/3 or less."""
    ids = _mixed(h(slice(0, n - t + 1), slice(t, n + 1)))
    ids[periodic[: len(ids)]] = NONE
    smallest, width = ids, 1
    while 2 * width <= t + 1:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    count = n - 2 * t + 1  # whole contexts of 2t words
    over = t + 1 - width
    smallest = np.minimum(smallest[:count], smallest[over : over + count])
    return np.flatnonzero(((smallest == ids[:count]) | (smallest == ids[t : t + count])) & (smallest != NONE))


def _covered(n: int, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A mask of the positions in any of the ranges."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, stop, -1)
    return np.cumsum(steps[:-1]) > 0


def _holds(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each stretch has its period, word by word."""
    if not len(start):
        return np.zeros(0, dtype=bool)
    size = end - start - period
    first = np.cumsum(size) - size
    at = np.repeat(start - first, size) + np.arange(size.sum())
    return np.logical_and.reduceat(words[at] == words[at + np.repeat(period, size)], first)


def _exact_stretch(words: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The stretch of period d around i by direct comparison; for a proposal whose hashes collided."""
    equal = words[:-d] == words[d:]
    ahead, behind = np.flatnonzero(~equal[i:]), np.flatnonzero(~equal[:i])
    end = i + int(ahead[0]) if len(ahead) else len(equal)
    start = int(behind[-1]) + 1 if len(behind) else 0
    return (start, end + d) if end > start else (i, i)


def _small_runs(words: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    equal = np.concatenate([[False], words[:-d] == words[d:], [False]])
    edges = np.flatnonzero(equal[1:] != equal[:-1])
    start, end = edges[::2], edges[1::2] + d
    long = end - start >= 3 * d
    start, end = start[long], end[long]
    if d > 1:  # periods 2 and 3 are prime: a smaller one is 1
        own = (words[start] != words[start + 1]) | (words[start + 1] != words[start + 2])
        start, end = start[own], end[own]
    return start, end


def _proposed_runs(words: np.ndarray, h: WindowHashes, t: int, periodic: np.ndarray) -> np.ndarray:
    """Runs of at least three periods with a period from 2t up to, not including, 4t: rows start, end, period."""
    n = len(words)
    chosen = synchronising_set(h, n, t, periodic)
    proposals = []
    for context, least, most in ((3 * t, 2 * t, 3 * t), (4 * t, 3 * t + 1, 4 * t - 1)):
        at = chosen[chosen + context <= n]
        hashes = h(at, at + context)
        order = np.argsort(hashes, kind="stable")
        at, hashes = at[order], hashes[order]
        apart = np.diff(at)
        near = (hashes[1:] == hashes[:-1]) & (apart >= least) & (apart <= most)
        proposals.append(np.stack([at[:-1][near], apart[near]]))
    at, d = np.hstack(proposals)
    start = at - _equal_behind(h, at, at + d)
    end = at + d + _equal_ahead(h, at, at + d, n)
    long = end - start >= 3 * d
    at, start, end, d = at[long], start[long], end[long], d[long]
    # Each period of a run proposes the whole run; it is compared once.
    distinct, group = np.unique(np.stack([start, end, d]), axis=1, return_inverse=True)
    for k in np.flatnonzero(~_holds(words, *distinct)[group.ravel()]):
        start[k], end[k] = _exact_stretch(words, int(at[k]), int(d[k]))
    found = np.stack([start, end, d])[:, end - start >= 3 * d]
    return np.unique(found, axis=1)


def find_runs(words: np.ndarray, owner: np.ndarray, min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> np.ndarray:
    """Runs as rows start, end, period, in order of start, then period.

    ``words`` are numbers of words of several texts; ``owner`` (ascending) says which text a place
    belongs to. A text's last place holds a number found nowhere else, which ends its runs.
    ``min_exponent`` is 3 at least. A text without room for ``min_exponent`` periods of a scale is
    left out at that scale and above.
    """
    found = [np.zeros((3, 0), dtype=np.int64)]
    for d in range(1, SMALL + 1):
        if len(words) > 3 * d:
            start, end = _small_runs(words, d)
            found.append(np.stack([start, end, np.full(len(start), d)]))
    place = np.arange(len(words))  # of the words that are left, in the whole
    t = (SMALL + 1) // 2
    while True:
        sizes = np.bincount(owner[place], minlength=1) if len(place) else np.zeros(1, dtype=np.int64)
        place = place[sizes[owner[place]] > 2 * t * min_exponent]
        if not len(place):
            break
        left = words[place]
        known = np.hstack(found)
        known = known[:, (3 * known[2] <= t) & (known[1] - known[0] >= t)]
        first = np.searchsorted(place, known[0])
        inside = first < len(place)
        inside[inside] = place[first[inside]] == known[0][inside]
        first, known = first[inside], known[:, inside]
        periodic = _covered(len(left), first, first + known[1] - known[0] - t + 1)
        runs = _proposed_runs(left, WindowHashes(left), t, periodic)
        shift = place[runs[0]] - runs[0]
        found.append(np.stack([runs[0] + shift, runs[1] + shift, runs[2]]))
        t *= 2
    runs = np.hstack(found)  # ascending periods; a multiple of a run's period, let in by a collision, has the same span
    runs = runs[:, np.sort(np.unique(runs[:2], axis=1, return_index=True)[1])]
    length = runs[1] - runs[0]
    runs = runs[:, (length >= min_words) & (length >= min_exponent * runs[2])]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _texts_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of some texts at a time: about ``CHUNK_WORDS``, or one longer text."""
    ids: list = []
    texts: list[list[bytes]] = []
    size = 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1), strict=True):
            words = (text.as_py() or b"").split()  # blanks of bytes are 0x20 and 0x09-0x0D
            if size + len(words) > CHUNK_WORDS and ids:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i.as_py())
            texts.append(words)
            size += len(words)
    if ids:
        yield ids, texts


def _solve(texts: list[list[bytes]], min_exponent: int, min_words: int) -> tuple[list[list[dict]], list[bytes]]:
    """Runs of each text, and each text without what its runs repeat."""
    vocabulary: dict[bytes, int] = {}
    numbers = [[vocabulary.setdefault(word, len(vocabulary)) for word in text] + [-1] for text in texts]
    words = np.fromiter((x for text in numbers for x in text), dtype=np.int64, count=sum(map(len, numbers)))
    ends = np.flatnonzero(words < 0)
    words[ends] = len(vocabulary) + np.arange(len(ends))
    sizes = np.diff(np.append(-1, ends))
    begins = ends + 1 - sizes
    runs = find_runs(words, np.repeat(np.arange(len(texts)), sizes), min_exponent, min_words)
    dropped = _covered(len(words), runs[0] + runs[2], runs[1])
    found: list[list[dict]] = [[] for _ in texts]
    for (start, end, period), text in zip(runs.T.tolist(), np.searchsorted(ends, runs[0]).tolist(), strict=True):
        found[text].append({"start": start - int(begins[text]), "length": end - start, "period": period})
    collapsed = []
    for text, own, begin in zip(texts, found, begins.tolist(), strict=True):
        if own:
            text = [word for word, gone in zip(text, dropped[begin : begin + len(text)].tolist(), strict=True) if not gone]
        collapsed.append(b" ".join(text))
    return found, collapsed


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``runs`` and the ``collapsed`` text.

    Words are what lies between blanks (0x20, 0x09-0x0D). A run is a stretch of at least
    ``min_words`` words and ``min_exponent`` (3 or more) times its smallest period that can't be
    extended; runs are given as word number, length and period, by start, then period. ``collapsed``
    keeps the words outside runs and the first period of each run (unless another run drops them),
    joined by one blank. A null or empty text has no runs and an empty collapsed text. Rows are
    worked on one by one, so null, repeated or missing ids don't matter; an empty table gives an
    empty result; other columns are not read. A text's words are held in one task.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in batches:
            for ids, texts in _texts_of_chunks(iter([batch])):
                found, collapsed = _solve(texts, min_exponent, min_words)
                columns = [pa.array(ids, batch.schema.field(0).type), pa.array(found, runs_type), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "runs", "collapsed"])

    return rows.mapInArrow(run, f"id {kind}, {RESULT}")
