"""Repair of the turn structure of conversations by least-cost edits.

A conversation is to read as an optional system turn and then pairs of a user's and an
assistant's turn. Its rows are kept, given another role or deleted, and turns without text are
inserted. A node is a place between rows together with the role that came last; what may be
inserted there, or made of the next row, is one role only, so a node has at most one arc per edit.

The cheapest costs to the end come from a dynamic program over the nodes, from the right. Only
the arcs on cheapest paths remain. They are ranked by prefix doubling: the first edit gives the
rank of an arc, and its rank by the first 2n edits comes from the pair of its rank by n edits and
the rank of the arc that follows after n. The pointers to these arcs are doubled along. The
least-ranked arc of the first node then starts the least of the cheapest edit strings, and the
doubled pointers give its t-th arc for all t at once.

Rows are put in order by a range sort, so a conversation of any length spreads over tasks, and
are cut into blocks of a bounded number of rows, one byte each. Costs pass between the blocks of a
long conversation as min-plus products of 4 x 4 matrices, and its path as maps of four states, in
rounds that double the distance. Texts are only read again, front to back, by what writes the
repaired conversation, which holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolake.llm import arrowtext, scratch

#: Rows of a block.
BLOCK = 4096
#: Rows whose nodes are worked on at a time.
CHUNK = 1 << 15

# The role that came last: none, system, user, assistant.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
#: After each state, the role (as a state) that may be inserted or made of a row.
_NEXT = np.array([_USER, _USER, _ASSISTANT, _USER])
_NAMES = (None, "system", "user", "assistant")
_EDITS = "DIKR"
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
#: What the edits cost, and a truncated row that is not deleted.
_COST_DELETE, _COST_INSERT, _COST_REROLE, _COST_TRUNCATED = 3, 2, 2, 1
_FAR = 1 << 50
#: What an end costs by the last role, with the insertions that complete it.
_END = np.array([0, 4, 2, 0], np.int64)

# A row's code: its role's initial (system, user, assistant, other) and four times its fault.
_OTHER = 3
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 3
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code: the cost of a new role, and by state the cost of keeping and the next state."""
    rerole = np.full(16, _FAR, np.int64)
    keep = np.full((16, 4), _FAR, np.int64)
    target = np.zeros((16, 4), np.int64)
    for code in range(16):
        initial, fault = code % 4, code // 4
        if fault in (_BLANK, _DUPLICATE):
            continue
        extra = _COST_TRUNCATED if fault == _TRUNCATED else 0
        rerole[code] = _COST_REROLE + extra
        for state in range(4):
            after = {0: _SYSTEM, 1: _USER, 2: _ASSISTANT}.get(initial)
            if after == (_SYSTEM if state == _NONE and initial == 0 else _NEXT[state]):
                keep[code, state], target[code, state] = extra, after
    return rerole, keep, target


_REROLE_COST, _KEEP_COST, _KEEP_TO = _tables()


def costs(codes: np.ndarray, offsets: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cheapest costs to the end by place and state, for consecutive blocks of codes.

    Block k holds ``codes[offsets[k]:offsets[k + 1]]``; its places are these numbers plus k, one
    more than it has rows. ``right`` has the costs at its last place.
    """
    blocks = len(offsets) - 1
    found = np.empty((len(codes) + blocks, 4), np.int64)
    found[offsets[1:] + np.arange(blocks)] = right
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    falling = -lengths[order]
    for t in range(1, int(lengths.max(initial=0)) + 1):
        active = order[: np.searchsorted(falling, -t, side="right")]
        row = offsets[active + 1] - t
        code, place = codes[row], row + active
        after = found[place + 1]
        best = np.minimum(after + _COST_DELETE, _REROLE_COST[code][:, None] + after[:, _NEXT])
        kept = np.take_along_axis(after, _KEEP_TO[code], axis=1)
        best = np.minimum(best, _KEEP_COST[code] + kept)
        user, assistant = best[:, _USER].copy(), best[:, _ASSISTANT].copy()
        best[:, _USER] = np.minimum(user, assistant + _COST_INSERT)
        best[:, _ASSISTANT] = np.minimum(assistant, user + _COST_INSERT)
        for state in (_NONE, _SYSTEM):
            np.minimum(best[:, state], best[:, _USER] + _COST_INSERT, out=best[:, state])
        found[place] = np.minimum(best, _FAR)
    return found


def optimal_arcs(
    codes: np.ndarray, offsets: np.ndarray, found: np.ndarray, final: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, edit, to) of the arcs on cheapest paths; a node is four times its place + state.

    Nothing is inserted at the last place of a block that is not ``final``: its successor does.
    """
    blocks = len(offsets) - 1
    place = np.arange(len(codes)) + np.repeat(np.arange(blocks), np.diff(offsets))
    now, after = found[place], found[place + 1]
    open_places = np.ones(len(found), bool)
    open_places[(offsets[1:] + np.arange(blocks))[~final]] = False
    every = np.flatnonzero(open_places)
    state = np.arange(4)
    sources, edits, targets = [], [], []

    def add(cost: np.ndarray, goal: np.ndarray, at: np.ndarray, edit: int, to: np.ndarray) -> None:
        row, own = np.nonzero((cost == goal) & (goal < _FAR))
        sources.append(at[row] * 4 + own)
        edits.append(np.full(len(row), edit, np.int64))
        targets.append(to[row, own])

    below = (place[:, None] + 1) * 4
    add(after + _COST_DELETE, now, place, _DELETE, below + state)
    kept = np.take_along_axis(after, _KEEP_TO[codes], axis=1)
    add(_KEEP_COST[codes] + kept, now, place, _KEEP, below + _KEEP_TO[codes])
    add(_REROLE_COST[codes][:, None] + after[:, _NEXT], now, place, _REROLE, below + _NEXT)
    inserted = found[every][:, _NEXT] + _COST_INSERT
    add(inserted, found[every], every, _INSERT, every[:, None] * 4 + _NEXT)
    return np.concatenate(sources), np.concatenate(edits), np.concatenate(targets)


@dataclass
class Paths:
    """The least cheapest paths from every node, by ranks and doubled pointers.

    The arc after the last one stands for the end: it has no edit and follows itself.
    """

    edits: np.ndarray
    targets: np.ndarray
    #: The least-ranked arc of every node.
    first: np.ndarray
    #: The number of edits from every arc to the end.
    lengths: np.ndarray
    #: For each power of two, the arc that many edits later.
    jumps: list[np.ndarray]

    def read(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arcs of the paths from ``nodes``, one path after the other, and their numbers."""
        start = self.first[nodes]
        counts = self.lengths[start]
        arc = np.repeat(start, counts)
        step = arrowtext.ragged(np.zeros(len(counts), np.int64), counts)
        for power, jump in enumerate(self.jumps):
            further = (step >> power) & 1 == 1
            arc[further] = jump[arc[further]]
        return arc, counts


def _least(sources: np.ndarray, ranks: np.ndarray, nodes: int) -> np.ndarray:
    """The arc of the least rank by source node, the end where there is none."""
    order = np.lexsort((ranks[:-1], sources))
    lead = np.ones(len(order), bool)
    lead[1:] = sources[order][1:] != sources[order][:-1]
    first = np.full(nodes, len(sources), np.int64)
    first[sources[order][lead]] = order[lead]
    return first


def rank_paths(sources: np.ndarray, edits: np.ndarray, targets: np.ndarray, nodes: int) -> Paths:
    """Ranks arcs by their least edit strings, twice as long a part of them in each round."""
    end = len(edits)
    ranks = np.append(edits + 1, 0)
    jump = np.append(_least(sources, ranks, nodes)[targets], end)
    lengths = np.append(np.ones(end, np.int64), 0)
    jumps = []
    while (jump != end).any():
        pairs = ranks * (int(ranks.max()) + 1) + ranks[jump]
        ranks = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        lengths = lengths + lengths[jump]
        jumps.append(jump)
        jump = jump[jump]
    return Paths(edits, targets, _least(sources, ranks, nodes), lengths, jumps)


# -- rows and their order ----------------------------------------------------------------


_SPACE = " \t\n\x0b\x0c\r"


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) damaged by a hash of conversation and turn; nulls are a space."""
    space = F.lit(" ")
    name = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    kind = F.crc32(name.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), space) for c in ("text", "role"))
    return (
        turns.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "")
            .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_copies"),
        )
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
        .select("conv_id", "turn", "role", "text")
    )


def _key() -> Column:
    """A text for every conv_id, also for none."""
    text = F.col("conv_id").cast("string")
    return F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text)).alias("key")


def _ordered(turns: DataFrame) -> DataFrame:
    """The rows with their place ``at``: increasing within and between conversations' turns.

    Rows of a turn go by role, then by the SHA-256 of their text. Equal rows, which may be
    many, are spread by their place in the input: any order of theirs is the same.
    """
    space = F.lit(" ")
    rows = turns.select(
        _key(),
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.sha2(F.coalesce("text", space), 256).alias("digest"),
        F.monotonically_increasing_id().alias("spread"),
    )
    order = ["key", F.asc_nulls_first("turn"), "role", "digest", "spread"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.written(
        placed.select("key", "turn", "role", "text", "digest").withColumn(
            "at", F.monotonically_increasing_id()
        ),
        "ordered",
    )


def _coded(ordered: DataFrame) -> DataFrame:
    """(key, at, code) of every row; only the first of equal rows is no duplicate.

    Equal rows are found by a grouped minimum, which is combined before the shuffle, and marked by
    a join on their unique places.
    """
    trimmed = F.rtrim("text", F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    rows = ordered.select(
        "key",
        "at",
        "role",
        "digest",
        F.when(initial == "s", 0)
        .when(initial == "u", 1)
        .when(initial == "a", 2)
        .otherwise(_OTHER)
        .alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    first = rows.groupBy("key", "role", "digest").agg(F.min("at").alias("at"))
    marked = rows.drop("role", "digest").join(
        first.select("at", F.lit(True).alias("first")), "at", "left"
    )
    fault = (
        F.when(F.col("blank"), _BLANK)
        .when(F.col("first").isNull(), _DUPLICATE)
        .when(F.col("truncated"), _TRUNCATED)
        .otherwise(0)
    )
    return marked.select("key", "at", (F.col("initial") + 4 * fault).cast("byte").alias("code"))


def _blocks(coded: DataFrame, size: int) -> DataFrame:
    """(key, at, codes): up to ``size`` consecutive rows of a conversation, one byte each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, int, list[bytes], int] | None = None

        def put(key: str, at: int, codes: np.ndarray, out: list) -> None:
            nonlocal held
            while len(codes):
                if held is None or held[0] != key or held[3] == size:
                    if held:
                        out.append((held[0], held[1], b"".join(held[2])))
                    held = (key, at, [], 0)
                part = codes[: size - held[3]]
                held = (key, held[1], [*held[2], part.tobytes()], held[3] + len(part))
                codes, at = codes[len(part) :], at + len(part)

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.binary())
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["key", "at", "codes"],
            )

        for batch in batches:
            out: list = []
            keys = batch.column("key").dictionary_encode()
            number = keys.indices.to_numpy()
            at, codes = (batch.column(c).to_numpy() for c in ("at", "code"))
            # Places follow one another within a file of the ordered rows, not between files.
            edge = (np.diff(number) != 0) | (np.diff(at) != 1)
            edges = np.concatenate([[0], np.flatnonzero(edge) + 1, [len(at)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                put(keys.dictionary[int(number[a])].as_py(), int(at[a]), codes[a:b], out)
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([(held[0], held[1], b"".join(held[2]))])

    placed = coded.repartitionByRange("at").sortWithinPartitions("at")
    return placed.select("key", "at", "code").mapInArrow(
        task, "key string, at long, codes binary"
    )


# -- blocks of long conversations --------------------------------------------------------


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of blocks with their codes and offsets, of about ``CHUNK`` codes."""
    data, offsets = arrowtext.byte_rows(column)
    for a, b in arrowtext.row_spans(offsets, CHUNK):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _matrices(blocks: DataFrame) -> DataFrame:
    """(key, block, m): cheapest costs from each state before a block to each state after it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = np.where(np.eye(4, dtype=bool), 0, _FAR)
        for batch in batches:
            for a, b, codes, offsets in _chunks(batch.column("codes")):
                first = offsets[:-1] + np.arange(b - a)
                by_end = [
                    costs(codes, offsets, np.broadcast_to(unit[end], (b - a, 4)))[first]
                    for end in range(4)
                ]
                flat = np.stack(by_end, axis=2).reshape(b - a, 16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(a, b - a),
                        batch.column("block").slice(a, b - a),
                        pa.array(flat.tolist(), pa.list_(pa.int64())),
                    ],
                    ["key", "block", "m"],
                )

    return blocks.select("key", "block", "codes").mapInArrow(
        task, "key string, block int, m array<long>"
    )


def _product(left: str, right: str) -> Column:
    """The min-plus product of two flat 4 x 4 matrices."""
    return F.expr(
        f"transform(sequence(0, 15), x -> least({_FAR}L, array_min(transform(sequence(0, 3), k -> "
        f"{left}[4 * (x div 4) + k] + {right}[4 * k + x % 4]))))"
    )


def _scanned(rows: DataFrame, value: str, most: int, forward: bool, join: Column) -> DataFrame:
    """Running products of ``value`` over the blocks of each conversation, by doubled distances.

    ``join`` combines a block's value ``own`` with that at a distance, ``other``. The keys of
    the joins are unique, so they have no hot one.
    """
    step = 1
    while step < most:
        away = F.col("block") + (step if forward else -step)
        other = rows.select("key", away.alias("block"), F.col(value).alias("other"))
        joined = rows.withColumnRenamed(value, "own").join(other, ["key", "block"], "left")
        combined = F.when(F.col("other").isNull(), F.col("own")).otherwise(join)
        rows = scratch.written(joined.select("key", "block", combined.alias(value)), "scan")
        step *= 2
    return rows


def _exits(blocks: DataFrame) -> DataFrame:
    """(key, block, f): the state after a block for each state before it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = np.array(batch.column("right").to_pylist(), np.int64).reshape(-1, 4)
            for a, b, codes, offsets in _chunks(batch.column("codes")):
                final = np.zeros(b - a, bool)
                found = costs(codes, offsets, right[a:b])
                paths = rank_paths(*optimal_arcs(codes, offsets, found, final), found.size)
                first = (offsets[:-1] + np.arange(b - a))[:, None] * 4 + np.arange(4)
                arcs, counts = paths.read(first.ravel())
                last = paths.targets[arcs[np.cumsum(counts) - 1]] % 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(a, b - a),
                        batch.column("block").slice(a, b - a),
                        pa.array(last.reshape(-1, 4).tolist(), pa.list_(pa.int64())),
                    ],
                    ["key", "block", "f"],
                )

    return blocks.select("key", "block", "codes", "right").mapInArrow(
        task, "key string, block int, f array<long>"
    )


def _borders(blocks: DataFrame) -> DataFrame:
    """(key, at, right, entry, before) of the blocks of conversations that have several.

    ``right``: the costs after the block (null: it is the last), ``entry``: the state before it,
    ``before``: the code of the row before it (null: it is the first).
    """
    several = blocks.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    order = Window.partitionBy("key").orderBy("at")
    last_code = F.col("codes").substr(F.length("codes"), F.lit(1))
    # A row per block of thousands of rows.
    numbered = (
        blocks.select("key", "at", last_code.alias("last"))
        .join(several, "key")
        .select(
            "key",
            "at",
            "n",
            F.row_number().over(order).alias("block"),
            F.conv(F.hex(F.lag("last").over(order)), 16, 10).cast("int").alias("before"),
        )
    )
    numbered = scratch.written(numbered, "numbered")
    most = numbered.agg(F.max("n")).first()[0] or 0
    own = blocks.join(numbered, ["key", "at"])
    suffix = _scanned(
        scratch.written(_matrices(own), "matrices"), "m", most, False, _product("own", "other")
    )
    end = ", ".join(f"{x}L" for x in _END)
    to_end = F.expr(
        "transform(sequence(0, 3), q -> array_min(transform(sequence(0, 3), "
        f"k -> m[4 * q + k] + array({end})[k])))"
    )
    right = suffix.select("key", (F.col("block") - 1).alias("block"), to_end.alias("right"))
    known = scratch.written(own.join(right, ["key", "block"]).drop("at", "n", "before"), "right")
    follow = F.expr("transform(other, q -> own[int(q)])")
    prefix = _scanned(scratch.written(_exits(known), "exits"), "f", most, True, follow)
    entry = prefix.select("key", (F.col("block") + 1).alias("block"), F.expr("f[0]").alias("entry"))
    return numbered.join(known.select("key", "block", "right"), ["key", "block"], "left").join(
        entry, ["key", "block"], "left"
    )


def _solved(blocks: DataFrame) -> DataFrame:
    """(key, at, edits, blank, duplicate, truncated, illegal, cost) of every block."""
    names = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.frombuffer(_EDITS.encode(), np.uint8)
        for batch in batches:
            known = batch.column("right").to_pylist()
            entries = batch.column("entry").to_pylist()
            befores = batch.column("before").to_pylist()
            for a, b, codes, offsets in _chunks(batch.column("codes")):
                final = np.array([r is None for r in known[a:b]])
                right = np.array([_END if r is None else r for r in known[a:b]], np.int64)
                entry = np.array([e or 0 for e in entries[a:b]])
                found = costs(codes, offsets, right)
                paths = rank_paths(*optimal_arcs(codes, offsets, found, final), found.size)
                first = offsets[:-1] + np.arange(b - a)
                arcs, counts = paths.read(first * 4 + entry)
                ends = np.concatenate([[0], np.cumsum(counts)])
                leave = paths.targets[arcs[ends[1:] - 1]] % 4
                cost = found[first, entry] - np.where(final, 0, right[np.arange(b - a), leave])
                written = letters[paths.edits[arcs]].tobytes().decode()
                edits = [written[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
                initial = (codes % 4).astype(np.int64)
                pairs = np.zeros(len(codes), np.int64)
                pairs[1:] = ~_LEGAL[initial[:-1], initial[1:]]
                pairs[offsets[:-1]] = [
                    before is not None and not _LEGAL[before % 4, initial[at]]
                    for before, at in zip(befores[a:b], offsets[:-1].tolist(), strict=True)
                ]
                sums = [np.add.reduceat(codes // 4 == fault, offsets[:-1], dtype=np.int64)
                        for fault in (_BLANK, _DUPLICATE, _TRUNCATED)]
                sums += [np.add.reduceat(pairs, offsets[:-1]), cost]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(a, b - a),
                        batch.column("at").slice(a, b - a),
                        pa.array(edits, pa.string()),
                        *[pa.array(s, pa.int64()) for s in sums],
                    ],
                    ["key", "at", "edits", *names],
                )

    schema = "key string, at long, edits string, " + ", ".join(f"{n} long" for n in names)
    return blocks.select("key", "at", "codes", "right", "entry", "before").mapInArrow(task, schema)


# -- applying the edits ------------------------------------------------------------------

_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


@dataclass
class _Reader:
    """Applies a conversation's edits to its rows, which come in order, edits before rows."""

    key: str | None = None
    state: int = _NONE
    edits: str = ""
    done: int = 0
    pieces: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(_COUNTS, 0))
    low: int | None = None
    high: int | None = None
    distinct: int = 0

    def take(self, edits: str, counts: dict[str, int]) -> Iterator[tuple[str, str]]:
        """The edits of the next block; what the last one inserts after its rows comes first."""
        yield from self.insertions()
        self.edits, self.done = edits, 0
        self.pieces.append(edits)
        for name in _COUNTS:
            self.counts[name] += counts[name]

    def insertions(self) -> Iterator[tuple[str, str]]:
        while self.done < len(self.edits) and self.edits[self.done] == "I":
            self.done += 1
            self.state = int(_NEXT[self.state])
            yield _NAMES[self.state], ""

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str]]:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        yield from self.insertions()
        edit = self.edits[self.done]
        self.done += 1
        if edit == "K":
            self.state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
            yield role, text
        elif edit == "R":
            self.state = int(_NEXT[self.state])
            yield _NAMES[self.state], text

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _lines(
    turns: DataFrame, conversations: DataFrame | None, block: int
) -> tuple[DataFrame, str]:
    """Rows and edits of all conversations in the order in which a reader takes them.

    A conversation's id comes first (at -1), then by place the edits of each block, and its rows.
    """
    ordered = _ordered(turns)
    blocks = scratch.written(_blocks(_coded(ordered), block), "blocks")
    borders = _borders(blocks).select("key", "at", "right", "entry", "before")
    solved = _solved(blocks.join(borders, ["key", "at"], "left"))
    named = conversations if conversations is not None else turns
    ids = named.select(_key(), "conv_id").distinct()
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in [*solved.schema, *ordered.schema]}
    nothing |= {f.name: F.lit(None).cast(f.dataType) for f in ids.schema}
    columns = ["key", "at", "kind", "conv_id", "turn", "role", "text", "edits", *_COUNTS]

    def part(rows: DataFrame, kind: int, **own: Column) -> DataFrame:
        given = {c: F.col(c) for c in rows.columns} | own | {"kind": F.lit(kind)}
        return rows.select(*[given.get(c, nothing.get(c)).alias(c) for c in columns])

    lines = part(ids, 0, at=F.lit(-1).cast("long"))
    lines = lines.unionByName(part(solved, 1)).unionByName(part(ordered, 2))
    kind = ids.schema["conv_id"].dataType.simpleString()
    return lines.repartition("key").sortWithinPartitions("key", "at", "kind"), kind


def _read(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[object, _Reader, str | None, str | None]]:
    """(conv_id, reader, role, text) of repaired rows; role None: the conversation is over."""
    conv_id, reader = None, None
    for batch in batches:
        columns = batch.to_pydict()
        for i, key in enumerate(columns["key"]):
            if reader is None or reader.key != key:
                if reader:
                    for role, text in reader.insertions():
                        yield conv_id, reader, role, text
                    yield conv_id, reader, None, None
                conv_id, reader = columns["conv_id"][i], _Reader(key)
            if columns["kind"][i] == 1:
                counts = {name: columns[name][i] for name in _COUNTS}
                found = reader.take(columns["edits"][i], counts)
            elif columns["kind"][i] == 2:
                found = reader.row(columns["turn"][i], columns["role"][i], columns["text"][i])
            else:
                continue
            for role, text in found:
                yield conv_id, reader, role, text
    if reader:
        for role, text in reader.insertions():
            yield conv_id, reader, role, text
        yield conv_id, reader, None, None


def repaired(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations, position from 0.

    See ``reports`` for what odd rows give. A conversation of which nothing is kept has no rows.
    """
    lines, kind = _lines(turns, None, block)
    size = 2000

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, out, schema = 0, [], None
        names = ["conv_id", "position", "role", "text"]

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in batches:
                own = batch.schema.field("conv_id").type
                schema = schema or [own, pa.int64(), pa.string(), pa.string()]
                yield batch

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for conv_id, _, role, text in _read(typed(batches)):
            if role is None:
                position = 0
                continue
            out.append((conv_id, position, role, text))
            position += 1
            if len(out) == size:
                yield batch_of()
                out = []
        if out:
            yield batch_of()

    return lines.mapInArrow(task, f"conv_id {kind}, position long, role string, text string")


def reports(
    turns: DataFrame, conversations: DataFrame | None = None, block: int = BLOCK
) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and repaired_sha256.

    ``turns`` has conv_id, turn (a whole number), role and text; other columns are ignored.
    ``conversations`` (conv_id) adds conversations without rows: zeros, an empty audit and the
    hash of an empty text. The audit is the string of edits: Keep, Rerole, Delete, Insert.

    Null roles and texts count as one space, so such a text is blank; a row whose role is empty or
    has another initial than s, u or a cannot stay as it is; a null turn stands first
    and is no turn in the count of gaps; rows without conv_id are one conversation. Rows of one
    turn go by role, then by the SHA-256 of their text; repeated rows are duplicates after the
    first. Of several cheapest repairs the one with the ASCII-least audit is taken. A very long
    text is read once. An empty table gives no rows. ``block`` bounds the rows that a task solves at
    a time and changes no result.
    """
    lines, kind = _lines(turns, conversations, block)
    names = ["conv_id", "gaps", *_COUNTS, "audit", "repaired_sha256"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list = []

        def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not kinds:
                    kinds.extend([batch.schema.field("conv_id").type, *[pa.int64()] * 6])
                    kinds.extend([pa.string()] * 2)
                yield batch

        def batch_of(out: list) -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        out, digest, lines_seen = [], hashlib.sha256(), 0
        for conv_id, reader, role, text in _read(typed(batches)):
            if role is not None:
                line = f"{role}:{text}" if not lines_seen else f"\n{role}:{text}"
                digest.update(line.encode("utf-8", "surrogatepass"))
                lines_seen += 1
                continue
            out.append(
                (
                    conv_id,
                    reader.gaps,
                    *[reader.counts[c] for c in _COUNTS],
                    "".join(reader.pieces),
                    digest.hexdigest(),
                )
            )
            digest, lines_seen = hashlib.sha256(), 0
            if len(out) == 2000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    counts = ", ".join(f"{c} long" for c in ["gaps", *_COUNTS])
    return lines.mapInArrow(
        task, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string"
    )
