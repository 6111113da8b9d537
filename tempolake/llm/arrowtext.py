"""Arrow text columns as flat numpy arrays, so that one pass works on many rows at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; bounds a task's memory whatever the batch size is.
CHUNK_BYTES = 1 << 20

_U64 = np.uint64
_BASE = _U64(0x9E3779B97F4A7C15)
_MIX = (_U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB))
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> _U64(30))
    values = values * _MIX[0]
    values = values ^ (values >> _U64(27))
    values = values * _MIX[1]
    return values ^ (values >> _U64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) <= size:
        size = max(size + 1, 2 * CHUNK_BYTES)
        inverse = _U64(pow(int(_BASE), -1, 1 << 64))
        tables = []
        for base in (_BASE, inverse):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = (tables[0], tables[1])
    return _powers


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]``, equal for equal content wherever it stands."""
    up, down = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    scrambled = mix(values.astype(np.uint64) + _U64(1))
    np.cumsum(scrambled * up[: len(values)], out=sums[1:])
    content = (sums[ends] - sums[starts]) * down[starts]
    return mix(content ^ ((ends - starts).astype(np.uint64) * _MIX[0]))


def byte_rows(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and each row's offsets; null rows are empty."""
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    rows = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat, rows


def row_spans(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The text of consecutive rows, its code points and each row's offsets into them."""
    raw = data[offsets[0] : offsets[-1]]
    try:
        text = raw.tobytes().decode("utf-8")
        heads = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
        bounds = heads[offsets - offsets[0]]
    except UnicodeDecodeError:
        rows = [
            data[a:b].tobytes().decode("utf-8", "replace")
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        text = "".join(rows)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return text, points, bounds


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``start .. start + count``."""
    total = int(counts.sum())
    shift = starts - (np.cumsum(counts) - counts)
    return np.repeat(shift, counts) + np.arange(total)
