"""Approximate nearest neighbours by multiprobe hashing with p-stable projections.

Each table hashes a vector by ``hashes`` Gaussian projections, cut into intervals of one width:
the intervals are the bucket. A query visits its own bucket and those next to it in the order
of their estimated success: the nearer the projection to a boundary, the likelier the neighbour
lies beyond it. The candidates of all tables are ranked by exact double-precision distances.

Rows and probes are dealt by bucket in one shuffle and meet in its tasks, so neither side is ever
held whole; large tables take the hash tables one after the other. A full bucket is dealt over several cells, each row meeting each probe in one of
them. A cell returns its nearest few per query, not its pairs. Equal vectors are indexed once,
with the smallest ids that can be among the results, and equal queries are looked up once. A
query that its probes leave with too few results is compared with all rows, in cells as well.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempolake.llm import scratch, vectors

TABLES = 6
HASHES = 6
PROBES = 40
#: Width of the intervals in mean vector lengths.
WIDTH = 2.0
_SEED = 20240607
_ROWS, _QUERIES = 2048, 512
#: Bytes of rows, and queries, that a cell holds at most, give or take what chance deals it.
_CELL, _ASKED = 1 << 24, 1 << 16
#: Bytes of rows that the tables of a step copy into its shuffle, if that is over one table.
_STEP = 1 << 28
_BATCH = 10_000
_BUCKET = ["number", "bucket", "dim"]

#: Of vectors of one length: the number of a table, positions, and the bucket of each.
Keys = Callable[[np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]


class Projections:
    """The hash functions of all tables, the same in every task."""

    def __init__(self, dim: int, tables: int, hashes: int, width: float):
        random = np.random.default_rng([_SEED, dim])
        self.directions = random.normal(size=(tables, dim, hashes))
        self.offsets = random.uniform(0, width, size=(tables, 1, hashes))
        self.factors = random.integers(1, 1 << 62, size=hashes, dtype=np.int64) * 2 + 1
        self.width = width

    def places(self, block: np.ndarray, table: int) -> np.ndarray:
        """By vector, the projections in interval widths."""
        return (block.astype(np.float64) @ self.directions[table] + self.offsets[table]) / self.width

    def key(self, intervals: np.ndarray) -> np.ndarray:
        """64-bit bucket keys of interval numbers."""
        with np.errstate(over="ignore"):
            mixed = (intervals.astype(np.int64) * self.factors).sum(axis=-1)
            return mixed ^ (mixed >> 29)


def probes(inside: np.ndarray, count: int) -> np.ndarray:
    """Shifts of the ``count`` likeliest buckets, the own one first.

    ``inside`` holds the places within the intervals, 0 to 1. A shift costs the sum of the
    squared distances to the boundaries it crosses; sets of crossings are made in ascending
    order of cost by growing or moving on the last crossing of a cheaper set.
    """
    hashes = len(inside)
    crossings = sorted(
        [(x, i, -1) for i, x in enumerate(inside)] + [(1 - x, i, 1) for i, x in enumerate(inside)]
    )
    costs = [x * x for x, _, _ in crossings]
    shifts = [np.zeros(hashes, np.int64)]
    heap: list[tuple[float, tuple[int, ...]]] = [(costs[0], (0,))]
    while heap and len(shifts) < count:
        cost, chosen = heapq.heappop(heap)
        if len({crossings[c][1] for c in chosen}) == len(chosen):
            shift = np.zeros(hashes, np.int64)
            for c in chosen:
                shift[crossings[c][1]] = crossings[c][2]
            shifts.append(shift)
        last = chosen[-1]
        if last + 1 < len(crossings):
            grown = cost + costs[last + 1]
            heapq.heappush(heap, (grown - costs[last], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (grown, (*chosen, last + 1)))
    return np.array(shifts)


def nearest(
    queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, id, distance) of the ``k`` nearest rows of every query, ties by id."""
    x, y = queries.astype(np.float64), rows.astype(np.float64)
    squares = (y * y).sum(axis=1)
    rough = squares - 2 * (x @ y.T) + (x * x).sum(axis=1)[:, None]
    if len(ids) > k:
        limit = np.partition(rough, k - 1, axis=1)[:, k - 1]
        slack = 1e-9 * (squares.max() + (x * x).sum(axis=1))
        q, r = np.nonzero(rough <= (limit + slack)[:, None])
    else:
        q, r = (a.ravel() for a in np.indices(rough.shape))
    exact = np.sqrt(((x[q] - y[r]) ** 2).sum(axis=1))
    return _first(q, ids[r], exact, k)


def _first(
    q: np.ndarray, ids: np.ndarray, distance: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest of every query, ties by id."""
    order = np.lexsort((ids, distance, q))
    q, ids, distance = q[order], ids[order], distance[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], distance[keep]


class Parts:
    """Over how many parts the rows, and the queries, of each full bucket are dealt.

    A cell is one part of the rows with one of the queries: a row goes to the cells of all parts
    of the queries, and a query to those of all parts of the rows.
    """

    def __init__(self, rows: pa.Table | None = None, asked: pa.Table | None = None):
        self.sides: list[dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]] = []
        for full in (rows, asked):
            side = {}
            if full is not None and len(full):
                number, bucket, dim, parts = (
                    full.column(c).to_numpy() for c in (*_BUCKET, "parts")
                )
                for n, d in set(zip(number.tolist(), dim.tolist(), strict=True)):
                    own = np.flatnonzero((number == n) & (dim == d))
                    own = own[np.argsort(bucket[own])]
                    side[n, d] = bucket[own], parts[own]
            self.sides.append(side)

    def cells(
        self, number: int, dim: int, keys: np.ndarray, ids: np.ndarray, asked: bool
    ) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``keys``, once for each cell that the vector goes to, and the cells."""
        counts = []
        for side in self.sides:
            bucket, parts = side.get((number, dim), (None, None))
            if bucket is None:
                counts.append(np.ones(len(keys), np.int64))
                continue
            at = np.minimum(np.searchsorted(bucket, keys), len(bucket) - 1)
            counts.append(np.where(bucket[at] == keys, parts[at], 1))
        own, others = counts[::-1] if asked else counts
        at = np.repeat(np.arange(len(keys)), others)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(others) - others, others)
        with np.errstate(over="ignore"):
            mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        part = (mixed.astype(np.int64) % own)[at]
        return at, nth * own[at] + part if asked else part * others[at] + nth


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length, rows, vectors) of a few rows with vectors of one length at a time."""
    for whole in batches:
        for at in range(0, len(whole), _ROWS):
            batch = whole.slice(at, _ROWS)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                yield int(dim), part, vectors.matrix(part.column("embedding"))


def _counted(rows: DataFrame, keys_of: Callable[[int], Keys]) -> DataFrame:
    """(number, bucket, dim, n): the vectors that go to each bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, _, block in _by_length(batches):
            for number, _, keys in keys_of(dim)(block):
                bucket, n = np.unique(keys, return_counts=True)
                same = [np.full(len(n), x, np.int64) for x in (number, dim)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (same[0], bucket, same[1], n)], [*_BUCKET, "n"]
                )

    counts = rows.mapInArrow(task, "number long, bucket long, dim long, n long")
    return counts.groupBy(*_BUCKET).agg(F.sum("n").alias("n"))


def _dealt(rows: DataFrame, keys_of: Callable[[int], Keys], parts: Parts, asked: bool) -> DataFrame:
    """Each vector of ``rows`` (id, embedding, dim) once for each cell that it goes to."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, block in _by_length(batches):
            ids = part.column("id").to_numpy()
            for number, rows, keys in keys_of(dim)(block):
                at, cells = parts.cells(number, dim, keys, ids[rows], asked)
                for a in range(0, len(at), _BATCH):
                    some, cell = at[a : a + _BATCH], cells[a : a + _BATCH]
                    out = part.take(pa.array(rows[some]))
                    same = [pa.array(np.full(len(some), x, np.int64)) for x in (number, dim, asked)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            same[0], pa.array(keys[some]), same[1], pa.array(cell), same[2],
                            out.column("id"), out.column("embedding"),
                        ],
                        [*_BUCKET, "part", "asked", "id", "embedding"],
                    )

    kind = rows.schema["embedding"].dataType.simpleString()
    schema = "number long, bucket long, dim long, part long, asked long, id long"
    return rows.select("dim", "id", "embedding").mapInArrow(task, f"{schema}, embedding {kind}")


def _ranked(rows: DataFrame, asked: DataFrame, partitions: int, k: int) -> DataFrame:
    """(query_id, near, distance) of the nearest rows of every query in each cell."""
    cell = [*_BUCKET, "part"]
    # Both sides in one shuffle, not in a join: an estimate from the files of the queries, before
    # they are probed, would let a join send all probes through the driver.
    met = (
        rows.unionByName(asked)
        .repartition(partitions, *cell)
        .sortWithinPartitions(*cell, "asked", "id")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = [], []
        found, size = [], 0

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["query_id", "near", "distance"])

        for batch in batches:
            columns = [batch.column(c).to_numpy().tolist() for c in (*cell, "asked")]
            for a, b in vectors.equal_runs(batch, [*cell, "asked"], _ROWS):
                *own, probe = (c[a] for c in columns)
                if own != at:
                    at, held = own, []
                if probe and not held:
                    continue
                part = batch.slice(a, b - a)
                ids, block = part.column("id").to_numpy(), vectors.matrix(part.column("embedding"))
                if not probe:
                    held.append((block, ids))
                    continue
                for c in range(0, len(ids), _QUERIES):
                    some = [nearest(block[c : c + _QUERIES], *rows, k) for rows in held]
                    q, near, distance = some[0]
                    if len(some) > 1:
                        joined = (np.concatenate(x) for x in zip(*some, strict=True))
                        q, near, distance = _first(*joined, k)
                    found.append((ids[c : c + _QUERIES][q], near, distance))
                    size += len(q)
                if size >= _BATCH:
                    yield batch_of()
                    found, size = [], 0
        if found:
            yield batch_of()

    return met.mapInArrow(task, "query_id long, near long, distance double")


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest_first = Window.partitionBy("query_id").orderBy("distance", "near")
    distinct = found.groupBy("query_id", "near").agg(F.min("distance").alias("distance"))
    return distinct.withColumn("rank", F.row_number().over(nearest_first)).filter(
        F.col("rank") <= k
    )


def _one_per_id(rows: DataFrame) -> DataFrame:
    """The least vector of every vec_id, whichever order the rows come in."""
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def search(
    table: DataFrame,
    queries: DataFrame,
    k: int = 10,
    tables: int = TABLES,
    hashes: int = HASHES,
    count: int = PROBES,
    width: float = WIDTH,
) -> DataFrame:
    """The ``k`` nearest rows of ``table`` found for each row of ``queries``.

    Both have vec_id and embedding; queries are rows of ``table`` and are not among their own
    results. Returns query_id, rank from 1, vec_id and score, the Euclidean distance in double
    precision; ties go to the smaller vec_id. Vectors that are null, zero or hold null or
    non-finite components, and rows without vec_id, take no part; vectors are compared with
    those of their own length. Of several usable vectors with one vec_id the least one counts,
    as a row and as a query. With fewer than ``k`` other vectors all are returned, and none for an empty table. Other columns are ignored.
    """
    spark = table.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    everything = vectors.rows(table)
    width_of = np.dtype(vectors.dtype(everything)).itemsize
    valid = _one_per_id(vectors.usable(everything))
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    # Of equal vectors only the k + 1 smallest ids can be results.
    listed = valid.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    first = F.min("vec_id").over(Window.partitionBy("embedding"))
    listed = scratch.written_alone(listed.withColumn("near", first), "listed")
    index = listed.filter(F.col("copy") == 1).select(
        F.col("vec_id").alias("id"), "embedding", F.size("embedding").alias("dim")
    )
    size = index.agg(F.count("*"), F.avg(_length())).first()
    # Rounded: the order in which an average adds up must not decide buckets.
    unit = float(f"{size[1] or 1.0:.4g}") * width
    # A query is the row that its vec_id stands for in the table.
    ids = vectors.rows(queries).select("vec_id").distinct()
    asked = scratch.written_alone(valid.join(ids, "vec_id", "left_semi"), "queries")
    # Equal queries are looked up once, under the smallest of their ids.
    questions = scratch.written_alone(
        asked.groupBy("embedding")
        .agg(F.min("vec_id").alias("id"))
        .select("id", "embedding", F.size("embedding").alias("dim")),
        "questions",
    )
    # By length, the numbers of rows and questions.
    totals, wanted = _by_dim(index), _by_dim(questions)

    def hashed(most: int, numbers: list[int]) -> Callable[[int], Keys]:
        """The bucket of each vector in some tables, and those next to it up to ``most``."""

        def keys_of(dim: int) -> Keys:
            def keys(block: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
                functions = Projections(dim, tables, hashes, unit)
                for t in numbers:
                    places = functions.places(block, t)
                    intervals = np.floor(places).astype(np.int64)
                    if most == 1:
                        yield t, np.arange(len(block)), functions.key(intervals)
                        continue
                    shifts = [probes(x, most) for x in places - intervals]
                    rows = np.repeat(np.arange(len(block)), [len(s) for s in shifts])
                    yield t, rows, functions.key(intervals[rows] + np.concatenate(shifts))

            return keys

        return keys_of

    def full(rows: DataFrame, most: int, cap: Callable[[int], int], by: dict[int, int]):
        """The buckets with more vectors than a cell may have, of lengths that can have such."""
        dims = [dim for dim, n in by.items() if n > cap(dim)]
        if not dims:
            return None
        caps = spark.createDataFrame([(dim, cap(dim)) for dim in dims], "dim long, cap long")
        crowded = rows.join(F.broadcast(caps.select("dim")), "dim")
        counts = _counted(crowded, hashed(most, list(range(tables))))
        return (
            counts.join(F.broadcast(caps), "dim")
            .filter(F.col("n") > F.col("cap"))
            .select(*_BUCKET, F.ceil(F.col("n") / F.col("cap")).alias("parts"))
            .toArrow()
        )

    def most_rows(dim: int) -> int:
        return max(1, _CELL // (dim * width_of))

    parts = Parts(
        full(index, 1, most_rows, totals), full(questions, count, lambda dim: _ASKED, wanted)
    )
    # Dealt evenly, as a few rows make many probes.
    evenly = questions.repartition(partitions, "id")
    copied = tables * sum(n * dim * width_of for dim, n in totals.items())
    steps = np.array_split(np.arange(tables), min(tables, -(-copied // _STEP) or 1))
    found = []
    for numbers in (step.tolist() for step in steps):
        rows = _dealt(index, hashed(1, numbers), parts, False)
        probed = _dealt(evenly, hashed(count, numbers), parts, True)
        near = _best(_ranked(rows, probed, partitions, k + 1), k + 1)
        found.append(scratch.written_alone(near.select("query_id", "near", "distance"), "found"))
    if len(found) > 1:
        near = _best(reduce(DataFrame.unionByName, found), k + 1)
        found = [scratch.written_alone(near.select("query_id", "near", "distance"), "found")]
    found = found[0]

    # Questions with fewer results than there are vectors: compare them with all.
    lengths = spark.createDataFrame(list(totals.items()), "dim int, total long")
    have = found.groupBy("query_id").agg(F.count("*").alias("have"))
    short = scratch.written_alone(
        questions.join(F.broadcast(lengths), "dim")
        .join(have, questions["id"] == have["query_id"], "left")
        .filter(F.coalesce("have", F.lit(0)) < F.least(F.lit(k + 1), F.col("total")))
        .select("id", "embedding", "dim"),
        "short",
    )
    few = _by_dim(short)
    if few:

        def whole(dim: int) -> Keys:
            """One bucket of all vectors of a length."""
            return lambda block: iter([(0, np.arange(len(block)), np.zeros(len(block), np.int64))])

        dims = np.array(list(few), np.int64)
        zeros = np.zeros(len(dims), np.int64)
        every = [
            pa.table({"number": zeros, "bucket": zeros, "dim": dims, "parts": np.array(x, np.int64)})
            for x in (
                [-(-totals[dim] // most_rows(dim)) for dim in few],
                [-(-n // _ASKED) for n in few.values()],
            )
        ]
        lone = F.broadcast(lengths.filter(F.col("dim").isin(list(few))).select("dim"))
        rows = _dealt(index.join(lone, "dim"), whole, Parts(*every), False)
        more = _ranked(rows, _dealt(short, whole, Parts(*every), True), partitions, k + 1)
        found = _best(found.unionByName(more), k + 1).select("query_id", "near", "distance")
    members = listed.select("near", "vec_id")
    same = asked.join(
        questions.select("embedding", F.col("id").alias("question")), "embedding"
    ).select("question", F.col("vec_id").alias("query_id"))
    nearest_first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumnRenamed("query_id", "question")
        .join(same, "question")
        .join(members, "near")
        .filter("vec_id <> query_id")
        .select("query_id", "vec_id", F.col("distance").alias("score"))
        .withColumn("rank", F.row_number().over(nearest_first))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _by_dim(rows: DataFrame) -> dict[int, int]:
    """The number of vectors by length."""
    return dict(map(tuple, rows.groupBy("dim").agg(F.count("*")).collect()))


def _length():
    """The Euclidean length of a vector."""
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") ** 2)
    return F.sqrt(squares)
