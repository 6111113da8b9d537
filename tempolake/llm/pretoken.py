"""Splitting text into tokenizer words, and ids of words kept from batch to batch.

The split is that of the published byte-level pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

worked out on arrays of code points: a word starts where the class of the characters changes,
a blank before a word belongs to it, and an apostrophe that starts a word takes its suffix.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from tempolake.llm import arrowtext

SPACE, LETTER, NUMBER, OTHER = range(4)

# The code points with the Unicode property White_Space.
_WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

_BLANK, _APOSTROPHE = 0x20, 0x27

#: Code points per piece of a long text.
LONG = arrowtext.CHUNK_BYTES


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    by_category = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (by_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
        np.uint8,
        0x110000,
    )
    table[list(_WHITE_SPACE)] = SPACE
    return table


def word_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where words start; ``bounds`` are the offsets of the rows, whose words are separate."""
    size = len(points)
    if not size:
        return np.empty(0, np.int64)
    kind = classes()[points]
    first = np.zeros(size + 1, bool)
    first[bounds] = True
    start = np.empty(size, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= first[:size]
    # The last white space before a word is a word of its own, or the word's blank.
    lead = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:size])
    start[lead] = True
    start[lead + 1] = points[lead] != _BLANK
    # Contractions.
    marks = np.flatnonzero((points == _APOSTROPHE) & start)
    marks = marks[(marks + 1 < size) & ~first[marks + 1]]
    if len(marks):
        one = points[marks + 1]
        two = np.where(
            (marks + 2 < size) & ~first[marks + 2], points[np.minimum(marks + 2, size - 1)], 0
        )
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        for hit, length in ((short, 2), (long, 3)):
            at = marks[hit]
            start[at + 1] = False
            after = at + length
            start[after[after < size]] = True
    return np.flatnonzero(start)


def safe_cuts(points: np.ndarray, every: int = LONG) -> np.ndarray:
    """Offsets that cut a long text between words: before a blank between visible characters."""
    kind = classes()[points]
    safe = np.flatnonzero(
        (points[1:-1] == _BLANK) & (kind[:-2] != SPACE) & (kind[2:] != SPACE)
    )
    safe = safe + 1
    wanted = np.arange(every, len(points), every)
    at = np.searchsorted(safe, wanted)
    cuts = np.unique(safe[at[at < len(safe)]])
    return np.concatenate([[0], cuts, [len(points)]]).astype(np.int64)


class WordIds:
    """Token ids by word, kept between batches up to a bound on the words held.

    ``encode`` gives the ids of words not seen before. Words are told apart by 64-bit hashes.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        slots_log2: int = 20,
        limit: int = 1_200_000,
    ):
        self._encode, self._limit = encode, limit
        self._mask = np.uint64((1 << slots_log2) - 1)
        self._slots = 1 << slots_log2
        self._clear()

    def _clear(self) -> None:
        self._key = np.zeros(self._slots, np.uint64)
        self._entry = np.full(self._slots, -1, np.int32)
        self._offset = np.empty(1 << 16, np.int64)
        self._count = np.empty(1 << 16, np.int32)
        self._ids = np.empty(1 << 18, np.int32)
        self._entries = self._used = 0

    @staticmethod
    def _grown(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.resize(array, max(size, 2 * len(array)))

    def _add(self, words: list[str]) -> np.ndarray:
        ids, counts = self._encode(words)
        first, entries = self._entries, self._entries + len(words)
        used = self._used + len(ids)
        self._offset = self._grown(self._offset, entries)
        self._count = self._grown(self._count, entries)
        self._ids = self._grown(self._ids, used)
        self._ids[self._used : used] = ids
        self._count[first:entries] = counts
        self._offset[first:entries] = self._used + np.cumsum(counts) - counts
        self._entries, self._used = entries, used
        return np.arange(first, entries, dtype=np.int32)

    def ids(self, text: str, points: np.ndarray, bounds: np.ndarray):
        """Ids of all rows, one after another, and the number of ids of each row."""
        starts = word_starts(points, bounds)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(bounds) - 1, np.int64)
        if self._entries > self._limit:
            self._clear()
        ends = np.append(starts[1:], len(points))
        hashes = arrowtext.span_hashes(points, starts, ends)
        slot = (hashes & self._mask).astype(np.int64)
        entry = np.where(self._key[slot] == hashes, self._entry[slot], -1)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, at, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            where = missing[at]
            words = [
                text[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)
            ]
            added = self._add(words)
            entry[missing] = added[back]
            self._key[slot[where]] = new
            self._entry[slot[where]] = added
        counts = self._count[entry]
        flat = self._ids[arrowtext.ragged(self._offset[entry], counts)]
        totals = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(counts, out=totals[1:])
        per_row = totals[np.searchsorted(starts, bounds)]
        return flat, np.diff(per_row)


def row_ids(array: pa.Array, words: WordIds) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids of the rows one after another, ids per row) for the whole column."""
    data, offsets = arrowtext.byte_rows(array)
    for first, last in arrowtext.row_spans(offsets):
        text, points, bounds = arrowtext.code_points(data, offsets[first : last + 1])
        if last == first + 1 and len(points) > 2 * LONG:
            cuts = safe_cuts(points)
            parts = [
                words.ids(text[a:b], points[a:b], np.array([0, b - a]))[0]
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
            ]
            flat = np.concatenate(parts)
            yield first, flat, np.array([len(flat)], np.int64)
        else:
            flat, counts = words.ids(text, points, bounds)
            yield first, flat, counts
