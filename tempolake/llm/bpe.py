"""Byte-level BPE encoding and decoding by replaying the merges over a whole set of words.

The distinct words of a batch form one corpus. An inverted index leads from each pair of
adjacent tokens to the places where it stands; merges are applied in rank order, each to all
its places at once, and only the two neighbours of a place are indexed anew.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tempolake.llm import arrowtext, pretoken


#: Distinct words that one replay goes over: the bound of the inverted index in memory.
CORPUS_WORDS = 20_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class MergeReplay:
    """Encodes sets of words by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._bytes = [ranks[bytes([b])] for b in range(256)]
        self._pair_rank: dict[int, int] = {}

    def _rank(self, left: int, right: int) -> int:
        """The rank of two adjacent tokens as one, -1 if that is none."""
        pair = left << 32 | right
        rank = self._pair_rank.get(pair)
        if rank is None:
            rank = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            if len(self._pair_rank) > 300_000:
                self._pair_rank.clear()
            self._pair_rank[pair] = rank
        return rank

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of ids of each."""
        parts = [
            self._replay(words[at : at + CORPUS_WORDS])
            for at in range(0, len(words), CORPUS_WORDS)
        ]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _replay(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [word.encode("utf-8", "surrogatepass") for word in words]
        ranks, singles = self.ranks, self._bytes
        token: list[int] = []  # the token that starts here; -1 inside one, -2 between words
        whole: list[int] = []
        for word in raw:
            rank = ranks.get(word)
            if rank is None:
                token.extend([singles[b] for b in word])
                whole.append(-1)
            else:
                whole.append(rank)
            token.append(-2)
        size = len(token)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        places: dict[int, list[tuple[int, int, int]]] = {}

        def index(at: int) -> int:
            """Note the pair that starts at ``at``; its rank, or -1."""
            left, right = token[at], token[after[at]]
            if left < 0 or right < 0:
                return -1
            rank = self._rank(left, right)
            if rank >= 0:
                found = places.get(rank)
                if found is None:
                    places[rank] = [(at, left, right)]
                    heapq.heappush(heap, rank)
                else:
                    found.append((at, left, right))
            return rank

        heap: list[int] = []
        for at in range(size - 1):
            index(at)
        ends = [i for i, t in enumerate(token) if t == -2]
        ends_array = np.array(ends)
        while heap:
            rank = heapq.heappop(heap)
            todo = places.pop(rank, None)
            if todo is None:
                continue
            todo.sort()
            held = -1  # up to here a lower merge, made possible by this one, goes first
            for place in todo:
                at, left, right = place
                if at < held:
                    again = places.get(rank)
                    if again is None:
                        places[rank] = [place]
                        heapq.heappush(heap, rank)
                    else:
                        again.append(place)
                    continue
                if token[at] != left:
                    continue
                second = after[at]
                if token[second] != right:
                    continue
                token[at], token[second] = rank, -1
                follow = after[second]
                after[at] = follow
                if follow < size:
                    before[follow] = at
                lower = index(at)
                previous = before[at]
                if previous >= 0:
                    other = index(previous)
                    if other >= 0 and (lower < 0 or other < lower):
                        lower = other
                if 0 <= lower < rank:
                    held = ends[int(np.searchsorted(ends_array, at))]
        out: list[int] = []
        counts: list[int] = []
        begin = 0
        for end, rank in zip(ends, whole, strict=True):
            if rank >= 0:
                out.append(rank)
                counts.append(1)
            else:
                ids = [t for t in token[begin:end] if t >= 0]
                out.extend(ids)
                counts.append(len(ids))
            begin = end + 1
        return np.array(out, np.int32), np.array(counts, np.int64)


@cache
def _words(path: str) -> pretoken.WordIds:
    return pretoken.WordIds(MergeReplay(read_ranks(path)).encode)


@cache
def _bytes_by_id(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, and by id where they start and how many there are."""
    ranks = read_ranks(path)
    starts = np.zeros(max(ranks.values()) + 1, np.int64)
    lengths = np.zeros(len(starts), np.int64)
    at = 0
    for token, rank in ranks.items():
        starts[rank], lengths[rank] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), np.uint8), starts, lengths


def _appended(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != name]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + [column], [n for n, _ in kept] + [name])


def encode(
    rows: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``rows`` with a column of token ids; null and empty texts have none.

    A column already called ``ids`` is replaced; all others are kept. Each row is encoded on its
    own, so repeated rows get the same ids, and an empty table gives no rows. ``ranks_path`` names
    the rank file, which every executor reads for itself.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(ranks_path)
        for batch in batches:
            for first, flat, counts in pretoken.row_ids(batch.column(text), words):
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                yield _appended(batch.slice(first, len(counts)), ids, values)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != ids]
    return rows.mapInArrow(task, ", ".join([*kept, f"`{ids}` array<int>"]))


def decode(
    rows: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``rows`` with the bytes that their token ids stand for; null ids give no bytes.

    A decoded id that the vocabulary lacks is an error, as a silent gap would corrupt the text.
    Repeated rows get the same bytes, and an empty table gives no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts, lengths = _bytes_by_id(ranks_path)
        for batch in batches:
            column = batch.column(ids)
            values = column.flatten().to_numpy(zero_copy_only=False)
            if len(values) and (values.min() < 0 or values.max() >= len(starts)):
                raise ValueError("an id is not in the vocabulary")
            per_row = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int64)
            for first, last in arrowtext.row_spans(ends):
                part = values[ends[first] : ends[last]]
                sizes = lengths[part]
                raw = table[arrowtext.ragged(starts[part], sizes)].tobytes()
                cuts = np.concatenate([[0], np.cumsum(sizes)])[ends[first : last + 1] - ends[first]]
                texts = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                part = batch.slice(first, last - first)
                yield _appended(part, decoded, pa.array(texts, pa.binary()))

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != decoded]
    return rows.mapInArrow(task, ", ".join([*kept, f"`{decoded}` binary"]))
