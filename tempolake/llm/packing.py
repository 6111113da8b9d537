"""Packing token sequences into windows of equal size by multiway differencing.

Documents are cut into full windows and a rest of small pieces. The rests are dealt into groups
by a hash; in each group Karmarkar-Karp differencing starts with one partial partition per
piece, and keeps merging the two partitions with the largest imbalance, the fullest window of
one with the emptiest of the other, until one near-equal partition is left. When a window of it
exceeds the capacity, the group is dealt again over more windows.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolake.llm import pretoken, scratch

CAPACITY = 1024
#: Rests are cut into pieces of this many tokens: several per window let it fill evenly.
PIECE = 256
#: Pieces per group, on average. A group is the unit of one task's work.
GROUP_PIECES = 4000

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def differencing(lengths: list[int], windows: int) -> list[list[int]]:
    """The indices of ``lengths`` in ``windows`` windows of near-equal sums."""
    # A partition: sums and members of its used windows, ascending; the others are empty.
    heap = [(-length, i, [(length, i)], {i: [i]}) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    label = len(lengths)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, other, other_members = heapq.heappop(heap)
        if len(sums) < len(other):
            sums, members, other, other_members = other, other_members, sums, members
        # The fullest windows of one meet the emptiest of the other; empty ones stay implicit.
        shared = max(0, len(sums) + len(other) - windows)
        meeting, alone = other[:shared][::-1], other[shared:]
        joined = []
        for (a, x), (b, y) in zip(sums[:shared], meeting, strict=True):
            members[x].extend(other_members[y])
            joined.append((a + b, x))
        for _, y in alone:
            members[y] = other_members[y]
        new = joined + alone
        if len(new) == 1:
            del sums[:shared]
            insort(sums, new[0])
        else:
            sums = sorted(sums[shared:] + new)
        low = sums[0][0] if len(sums) == windows else 0
        heapq.heappush(heap, (low - sums[-1][0], label, sums, members))
        label += 1
    _, _, sums, members = heap[0]
    return [members[name] for _, name in sums]


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until none is exceeded."""
    if not lengths:
        return []
    total = sum(lengths)
    windows = max(1, -(-total // capacity))
    while True:
        packed = differencing(lengths, windows) if windows > 1 else [list(range(len(lengths)))]
        if max(sum(lengths[i] for i in window) for window in packed) <= capacity:
            return packed
        windows += max(1, windows // 400)


@cache
def _words(tokenizer_path: str) -> pretoken.WordIds:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
        return np.array(found.ids, np.int32), counts

    return pretoken.WordIds(encode)


def _cuts(tokens: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then small ones."""
    full = tokens - tokens % capacity
    cuts = [(start, capacity) for start in range(0, full, capacity)]
    cuts += [(start, min(piece, tokens - start)) for start in range(full, tokens, piece)]
    return cuts


def pieces(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    separator: int = 0,
) -> DataFrame:
    """The pieces of every text: ids, then the separator, cut for packing.

    Null and empty texts are one piece of the separator alone. Repeated rows and null ids each
    give pieces of their own.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_path)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for first, flat, counts in pretoken.row_ids(batch.column("text"), words):
                ends = np.cumsum(counts)
                ids = np.insert(flat, ends, separator).astype("<u4")
                begin = 0
                for row, count in enumerate(counts.tolist()):
                    total = count + 1
                    for start, length in _cuts(total, capacity, piece):
                        at = begin + start
                        crc = zlib.crc32(ids[at : at + length])
                        rows.append((names[first + row], start, length, crc, total))
                    begin += total
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return documents.select("doc_id", "text").mapInArrow(task, PIECE_SCHEMA)


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    Needs columns ``doc_id`` and ``text``, ignores others. Returns doc_id, start, length,
    ids_crc32 and doc_tokens of :func:`pieces`, sequence_id and offset. Every id of every
    document lies in exactly one piece; no sequence exceeds ``capacity``. An empty table gives
    no rows.
    """
    cut = scratch.written(pieces(documents, tokenizer_path, capacity, piece), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).alias("bin")

    def task(rows: pa.Table) -> pa.Table:
        # The order of equal rows decides nothing but which of them comes first.
        keys = ["doc_id", "start", "ids_crc32", "doc_tokens"]
        rows = rows.sort_by([(key, "ascending") for key in keys])
        lengths = rows.column("length").to_numpy()
        order = np.argsort(-lengths, kind="stable")
        whole = order[lengths[order] == capacity]
        rest = order[lengths[order] < capacity]
        windows = [[int(i)] for i in whole]
        rest_lengths = lengths[rest].tolist()
        windows += [[int(rest[i]) for i in window] for window in pack(rest_lengths, capacity)]
        sequence = np.zeros(len(rows), np.int64)
        offset = np.zeros(len(rows), np.int64)
        base = rows.column("bin")[0].as_py() << 32
        for number, window in enumerate(windows):
            at = 0
            for i in window:
                sequence[i], offset[i] = base + number, at
                at += int(lengths[i])
        rows = rows.drop_columns("bin").append_column("sequence_id", pa.array(sequence))
        return rows.append_column("offset", pa.array(offset))

    return (
        cut.select("*", group)
        .repartition(max(partitions, min(groups, 8 * partitions)), "bin")
        .groupBy("bin")
        .applyInArrow(task, f"{PIECE_SCHEMA}, sequence_id long, offset long")
    )
