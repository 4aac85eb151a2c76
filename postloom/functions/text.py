"""Text cleaning and stop words: as native expressions, and both at once in Arrow batches for whole posts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Mentions and tags, up to the first character that is no ASCII letter or digit.
MARKS = r"[@#][A-Za-z0-9]+"
# The same plus links and the scheme of a link that is cut off after it. A link may start at a word
# start or right behind the last match, so that a long word is tried once and not from each letter.
MARKS_AND_LINKS = MARKS + r"|(?:(?<!\w)|\G)\w++://[^\s\x1c-\x1f]+|https?://"
# Everything but ASCII letters and control characters: digits, punctuation, non-ASCII.
NOT_LETTERS = r"[\x21-\x40\x5b-\x60\x7b-\x7e\x80-\x{10ffff}]+"
# Java's \s does not hold the four separators \x1c-\x1f.
ANY_BLANKS = r"[\s\x1c-\x1f]+"
LONE_LETTER = r"\b[a-zA-Z]\b"
# Escapes that arrived as two characters, in this order; a real tab or newline is an ordinary blank.
ESCAPES = (("\\t", " "), ("\\n", " "), ("\\u", ""), ("\\", ""))
# MARKS_AND_LINKS for Python: there is no \G, but only a mark with an underscore behind it ends where a link may begin.
PYTHON_MARKS_AND_LINKS = MARKS + r"(?:_\w*+://[^\s\x1c-\x1f]+)?|(?<!\w)\w++://[^\s\x1c-\x1f]+|https?://"

# Characters of texts that are cleaned together: few enough for the caches of a core.
CHUNK = 200_000


def clean_text(text: Column) -> Column:
    """Lower-case words of ASCII letters, parted by blanks; null gives ``''``.

    Links, mentions and tags become blanks, other non-letters vanish, so ``100%`` leaves nothing
    and ``don't`` becomes ``dont``. Single letters are removed last and leave their blanks behind,
    so the result may hold several blanks in a row or at its ends.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    out = lowered
    for escape, instead in ESCAPES:
        out = F.replace(out, F.lit(escape), F.lit(instead))
    # Most texts hold none, and finding that out is cheap.
    out = F.when(F.contains(text, F.lit("\\")), out).otherwise(lowered)
    # Most texts hold no link, and finding that out is cheap.
    out = F.when(F.contains(out, F.lit("://")), F.regexp_replace(out, MARKS_AND_LINKS, " ")).otherwise(
        F.regexp_replace(out, MARKS, " ")
    )
    out = F.regexp_replace(out, NOT_LETTERS, "")
    out = F.trim(F.regexp_replace(out, ANY_BLANKS, " "))
    return F.regexp_replace(out, LONE_LETTER, "")


def remove_stop_words(cleaned: Column, stop_words: Iterable[str]) -> Column:
    """Cleaned text without the given words; empty text stays ``''``.

    Above ten words Catalyst turns the membership test into a hash set, so long lists are fine.
    """
    words = sorted(set(stop_words))
    if not words:
        return F.coalesce(cleaned, F.lit(""))
    kept = F.filter(F.split(F.coalesce(cleaned, F.lit("")), " "), lambda word: ~word.isin(words))
    return F.array_join(kept, " ")


def cleaned_texts(text: Column, stop_words: Iterable[str]) -> Column:
    """``struct<cleaned_text, stopword_text>``: :func:`clean_text`, and :func:`remove_stop_words` of it, in one pass.

    The expressions above go over a text once for each rule and once more for its words; here many texts
    lie one after another as bytes, and rules and words are arrays over these, in a fraction of the time.
    """
    stop = {word.encode() for word in stop_words}
    # Local names only: executors run this without a copy of the package.
    marks, marks_and_links, escapes = re.compile(MARKS), re.compile(PYTHON_MARKS_AND_LINKS, re.ASCII), ESCAPES
    blanks = bytes([*range(9, 14), *range(28, 32)])
    to_blank = bytes.maketrans(blanks, b" " * len(blanks))
    not_letters = bytes([*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
    no_controls = bytes(range(0x20, 0x7F))
    lone_letter = re.compile(rb"\b[a-zA-Z]\b")

    # A character that parts the texts and words like any blank; texts that hold it themselves go one by one.
    between, chunk = "\x1f", CHUNK
    to_blank_within = bytes.maketrans(blanks[:-1], b" " * (len(blanks) - 1))
    links, blank, mark = re.compile(PYTHON_MARKS_AND_LINKS.encode()), re.compile(rb"[ \x1f]"), re.compile(rb"[A-Za-z0-9]+")
    deleted = not_letters + bytes(range(0x80, 0x100))
    plain = no_controls + between.encode()
    short_stops = {
        size: np.array([int.from_bytes(word, "little") for word in stop if len(word) == size], np.uint64) for size in {len(w) for w in stop} if 2 <= size <= 8
    }
    long_stops = {size: {word for word in stop if len(word) == size} for size in {len(w) for w in stop} if size > 8}

    def words_of(text: str) -> list[bytes]:
        """The cleaned text, split at every blank."""
        lowered = text.lower()
        if "\\" in lowered:
            for escape, instead in escapes:
                lowered = lowered.replace(escape, instead)
        lowered = (marks_and_links if "://" in lowered else marks).sub(" ", lowered)
        letters = lowered.encode("ascii", "ignore").translate(to_blank, not_letters)
        if letters.translate(None, no_controls):
            return lone_letter.sub(b"", b" ".join(letters.split())).split(b" ")
        return [word if len(word) > 1 else b"" for word in letters.split()] or [b""]

    def one_by_one(texts: list[str]) -> list[pa.Array]:
        cleaned, kept = [], []
        for text in texts:
            words = words_of(text)
            cleaned.append(b" ".join(words))
            kept.append(b" ".join([word for word in words if word not in stop]))
        return [pa.array(found, pa.binary()).cast(pa.string()) for found in (cleaned, kept)]

    def without_marks(joined: str) -> bytes:
        """Lower-case letters, blanks and ends of texts."""
        lowered = joined.lower()
        if "\\" in lowered:
            for escape, instead in escapes:
                lowered = lowered.replace(escape, instead)
        data = lowered.encode().translate(to_blank_within)
        # No link reaches over a blank, so the pattern only sees what stands around ``://``.
        pieces, done, at = [], 0, data.find(b"://")
        while at >= 0:
            begin = max(done - 1, data.rfind(b" ", done, at), data.rfind(b"\x1f", done, at)) + 1
            end = blank.search(data, at).start()
            pieces += [data[done:begin], links.sub(b" ", data[begin:end])]
            done, at = end, data.find(b"://", end)
        data = bytearray(b"".join([*pieces, data[done:]]))
        found = np.frombuffer(data, np.uint8)
        for begin in np.flatnonzero((found == ord("@")) | (found == ord("#"))).tolist():
            name = mark.match(data, begin + 1)
            if name:
                end = name.end()
                found[begin:end] = ord(" ")
        return bytes(data).translate(None, deleted)

    def together(texts: list[str]) -> list[pa.Array]:
        joined = between.join([*texts, ""])
        letters = b"" if joined.count(between) != len(texts) else without_marks(joined)
        if not letters or letters.translate(None, plain):
            return one_by_one(texts)
        data = np.frombuffer(letters, np.uint8)
        is_letter = data > ord(" ")
        edges = np.flatnonzero(is_letter[1:] != is_letter[:-1]) + 1
        if is_letter[0]:
            edges = np.append(0, edges)
        starts, ends = edges[::2], edges[1::2]
        sizes = ends - starts
        words_until = np.searchsorted(starts, np.flatnonzero(data == ord(between)))
        lone = sizes == 1
        is_letter[starts[lone]] = False
        sizes[lone] = 0
        is_stop = lone if b"" in stop else np.zeros(len(starts), bool)
        for size, codes in short_stops.items():
            own = np.flatnonzero(sizes == size)
            code = np.zeros(len(own), np.uint64)
            for place in range(size):
                code |= data[starts[own] + place].astype(np.uint64) << np.uint64(8 * place)
            is_stop[own[np.isin(code, codes)]] = True
        for size, words in long_stops.items():
            for word in np.flatnonzero(sizes == size).tolist():
                is_stop[word] = letters[starts[word] : ends[word]] in words

        def laid_out(kept: np.ndarray) -> pa.Array:
            """Kept words of each text, with one blank between them: the byte behind a word."""
            stays = is_letter.copy()
            for size in np.unique(sizes[~kept]).tolist():
                own = starts[~kept & (sizes == size)]
                for place in range(size):
                    stays[own + place] = False
            number = np.flatnonzero(kept)
            until = np.append(0, np.cumsum(kept))[words_until]
            last = number[until[np.diff(until, prepend=0) > 0] - 1]
            stays[ends[number]] = True
            stays[ends[last]] = False
            length = np.where(kept, sizes + 1, 0)
            length[last] -= 1
            offsets = np.append(0, np.append(0, np.cumsum(length))[words_until]).astype(np.int32)
            return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data[stays]))

        cleaned = laid_out(np.ones(len(starts), bool))
        return [cleaned, laid_out(~is_stop) if is_stop.any() else cleaned]

    @F.arrow_udf("cleaned_text string, stopword_text string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            cleaned, kept, held, size = [pa.array([], pa.string())], [pa.array([], pa.string())], [], 0
            for at, value in enumerate(texts, 1):
                held.append(value.as_py() or "")
                size += len(held[-1])
                if size > chunk or at == len(texts):
                    for columns, found in zip((cleaned, kept), together(held), strict=True):
                        columns.append(found)
                    held, size = [], 0
            yield pa.StructArray.from_arrays([pa.concat_arrays(cleaned), pa.concat_arrays(kept)], ["cleaned_text", "stopword_text"])

    return both(text)
