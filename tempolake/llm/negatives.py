"""Hard negatives by exact integer scores from Kronecker-packed products.

Components are integers (256 times the original, rounded down). The j-th components of a run of
candidates, biased so that none is negative, become the fields of one wide integer; an anchor's
j-th component, biased too, multiplies it once for the whole run. The sum of these products over
j holds every candidate's biased score in its own field, which is wide enough for the largest sum,
so no field runs into the next, and the scores come out exact once the biases are taken off.

Candidates are dealt into parts by a hash, anchors into others; each pair of parts is one task's
tile. A first pass over the tiles finds each anchor's positives, for which only runs of its own
label are multiplied; a second one, that knows the positives' scores, finds the negatives. Tiles
return a few rows per anchor, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolake.llm import scratch

#: Candidates and anchors of a tile, on average.
CANDIDATES = 8192
ANCHORS = 2048
#: Candidates in one wide integer.
FIELDS = 2048
#: What the integers are multiples of.
SCALE = 256


class Packed:
    """Candidates (rows of integers) packed for products with any number of anchors."""

    def __init__(self, rows: np.ndarray):
        self.count, self.dimensions = rows.shape
        self.bias = max(0, -int(rows.min())) if rows.size else 0
        biased = rows + self.bias
        self.largest = int(biased.max()) if rows.size else 0
        self.sums = biased.sum(axis=1)
        self.biased = biased
        self._words: dict[int, list[int]] = {}

    def _packed(self, width: int) -> list[int]:
        """One integer per dimension with a field of ``width`` bytes per candidate."""
        if width not in self._words:
            if width <= 8:
                columns = np.zeros((self.dimensions, self.count, width), np.uint8)
                raw = self.biased.T.astype("<u8")[:, :, None].copy().view(np.uint8)
                columns[:] = raw[:, :, :width]
                data = [c.tobytes() for c in columns]
            else:
                data = [
                    b"".join(int(x).to_bytes(width, "little") for x in column)
                    for column in self.biased.T
                ]
            self._words[width] = [int.from_bytes(d, "little") for d in data]
        return self._words[width]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The exact inner product of every candidate with ``anchor``."""
        if not self.count or not self.dimensions:
            return np.zeros(self.count, np.int64)
        bias = max(0, -int(anchor.min()))
        factors = [int(x) + bias for x in anchor]
        bound = max(1, self.dimensions * max(factors) * self.largest)
        bits = bound.bit_length()
        width = 4 if bits <= 32 else 8 if bits <= 62 else -(-bits // 8)
        total = sum(map(mul, factors, self._packed(width)))
        raw = total.to_bytes(width * self.count, "little")
        if width <= 8:
            fields = np.frombuffer(raw, f"<u{width}").astype(np.int64)
        else:
            fields = np.array(
                [int.from_bytes(raw[i : i + width], "little") for i in range(0, len(raw), width)],
                object,
            )
        # sum (a + A)(c + C) = a.c + A sum(c + C) + C sum(a)
        return fields - bias * self.sums - self.bias * int(sum(map(int, anchor)))


def integers(column: pa.Array, dimensions: int) -> np.ndarray:
    """floor(256 * x) of a list column, one row per vector, short ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    small = not len(values) or float(np.abs(values).max()) < 2.0**24
    wide = values.astype(np.int64) if small else np.array([int(v) for v in values], object)
    rows = np.zeros((len(column), dimensions), wide.dtype)
    rows[np.arange(dimensions) < lengths[:, None]] = wide
    return rows


def participants(table: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, one per vec_id."""

    def finite(x: Column) -> Column:
        # An infinite multiple has no integer below it.
        scaled = F.abs(x) * SCALE
        return F.coalesce((scaled < float("inf")) & ~F.isnan(x), F.lit(False))

    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.forall("embedding", finite), F.lit(False))
    )
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    return one.select("vec_id", "row.label", "row.embedding")


def _tiles(rows: DataFrame, anchors: DataFrame, extra: list[str]) -> DataFrame:
    """Candidates and anchors of every tile, candidates first, by label.

    Columns: tile, anchor (boolean), vec_id, label, embedding and, of anchors, ``extra``.
    """
    n_rows, n_anchors = rows.count(), anchors.count()
    left = max(1, -(-n_rows // CANDIDATES))
    right = max(1, -(-n_anchors // ANCHORS))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(parts))

    def all_of(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    types = {f.name: f.dataType for f in anchors.schema}
    columns = ["tile", "anchor", "vec_id", "label", "embedding", *extra]
    own = rows.select(
        "vec_id", "label", "embedding", dealt(left).alias("l"), all_of(right).alias("r")
    ).select(
        (F.col("l") * right + F.col("r")).alias("tile"),
        F.lit(False).alias("anchor"),
        "vec_id",
        "label",
        "embedding",
        *[F.lit(None).cast(types[c]).alias(c) for c in extra],
    )
    asked = anchors.select("*", dealt(right).alias("r"), all_of(left).alias("l")).select(
        (F.col("l") * right + F.col("r")).alias("tile"), F.lit(True).alias("anchor"), *columns[2:]
    )
    return (
        own.unionByName(asked)
        .repartition(left * right, "tile")
        .sortWithinPartitions("tile", "anchor", "label", "vec_id")
    )


class _Candidates:
    """One tile's candidates, sorted by label and vec_id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self._packs: dict[tuple[int, int], Packed] = {}

    def runs(self, low: int, high: int) -> Iterator[tuple[slice, Packed]]:
        """Rows ``low`` to ``high`` as packed runs."""
        for at in range(low, high, FIELDS):
            key = (at, min(at + FIELDS, high))
            if key not in self._packs:
                self._packs[key] = Packed(self.rows[key[0] : key[1]])
            yield slice(*key), self._packs[key]

    def of_label(self, label: int) -> tuple[int, int]:
        low, high = np.searchsorted(self.labels, [label, label + 1])
        return int(low), int(high)


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` highest scores, ties to the smaller id."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    order = sorted(kept.tolist(), key=lambda i: (-scores[i], ids[i]))
    return np.array(order[:most], np.int64)


def _long(value: int) -> int:
    if not -(1 << 63) <= value < 1 << 63:
        raise OverflowError(f"the score {value} does not fit into 64 bits")
    return int(value)


def _positives(tile: _Candidates, batch: pa.RecordBatch, rows: np.ndarray, most: int) -> Iterator:
    """(anchor_id, positive_id, positive_score) candidates of a tile."""
    ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
    for anchor_id, label, row in zip(ids.tolist(), labels.tolist(), rows, strict=True):
        for where, pack in tile.runs(*tile.of_label(label)):
            own = tile.ids[where]
            others = np.flatnonzero(own != anchor_id)
            scores = pack.scores(row)[others]
            for i in _first(scores, own[others], most).tolist():
                yield anchor_id, int(own[others][i]), _long(scores[i])


def _negatives(tile: _Candidates, batch: pa.RecordBatch, rows: np.ndarray, most: int) -> Iterator:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score) of a tile."""
    ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
    positives = batch.column("positives").to_pylist()
    for anchor_id, label, row, found in zip(
        ids.tolist(), labels.tolist(), rows, positives, strict=True
    ):
        # Between four fifths of a negative score and the score itself there is nothing.
        found = [(p["positive_id"], p["positive_score"]) for p in found if p["positive_score"] >= 0]
        if not found:
            continue
        low = -(-80 * min(s for _, s in found) // 100)
        high = max(s for _, s in found)
        for where, pack in tile.runs(0, len(tile.ids)):
            scores = pack.scores(row)
            near = np.flatnonzero(
                (scores >= low) & (scores <= high) & (tile.labels[where] != label)
            )
            if not len(near):
                continue
            near_ids, near_scores = tile.ids[where][near], scores[near]
            for positive_id, score in found:
                fits = np.flatnonzero((80 * score <= 100 * near_scores) & (near_scores <= score))
                for i in _first(near_scores[fits], near_ids[fits], most).tolist():
                    at = fits[i]
                    yield (
                        anchor_id, positive_id, score, int(near_ids[at]), _long(near_scores[at])
                    )


def _searched(tiles: DataFrame, find, most: int, names: list[str]) -> DataFrame:
    """What ``find`` yields for the anchors of every tile."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, parts, held = None, [], None
        for batch in batches:
            marks = batch.column("tile").to_numpy() * 2 + batch.column("anchor").to_numpy(
                zero_copy_only=False
            )
            edges = np.flatnonzero(np.diff(marks, prepend=marks[0] - 1, append=marks[-1] + 1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = batch.slice(a, b - a)
                number, asked = divmod(int(marks[a]), 2)
                if number != tile:
                    tile, parts, held = number, [], None
                if not asked:
                    parts.append(part)
                    continue
                if not parts:
                    continue
                vectors = part.column("embedding")
                width = max(
                    int(p.column("embedding").value_lengths().to_numpy().max(initial=0))
                    for p in [*parts, part]
                )
                if held is None or held.rows.shape[1] < width:
                    held = _Candidates(
                        np.concatenate([p.column("vec_id").to_numpy() for p in parts]),
                        np.concatenate([p.column("label").to_numpy() for p in parts]),
                        np.concatenate([integers(p.column("embedding"), width) for p in parts]),
                    )
                rows = list(find(held, part, integers(vectors, held.rows.shape[1]), most))
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return tiles.mapInArrow(task, ", ".join(f"{n} long" for n in names))


def _best(rows: DataFrame, keys: list[str], score: str, other: str, most: int) -> DataFrame:
    """The first ``most`` rows per key with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(
    table: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 5,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``table``.

    ``table`` has vec_id, label and embedding; other columns are ignored. ``is_anchor`` selects
    anchors by vec_id. Per anchor and positive come the first negatives whose score is between 80
    and 100 percent of the positive's; so a positive with a negative score has none. Higher scores
    come first, ties by smaller vec_id.

    Rows without vec_id, label or vector, and those with a null or non-finite component, take no
    part (neither do components so large that 256 times them is infinite). Of rows with one
    vec_id that with the least label, then vector, counts. Short and empty vectors count as
    filled up with zeros. Scores are exact whatever their size; one to be returned that needs over
    64 bits raises OverflowError. Empty tables and tables without anchors give no rows.
    """
    rows = scratch.written(participants(table), "participants")
    anchors = rows.filter(is_anchor)
    found = _searched(
        _tiles(rows, anchors, []),
        _positives,
        n_positives,
        ["anchor_id", "positive_id", "positive_score"],
    )
    kept = _best(found, ["anchor_id"], "positive_score", "positive_id", n_positives)
    pairs = F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    known = kept.groupBy(F.col("anchor_id").alias("vec_id")).agg(pairs)
    asked = scratch.written(anchors.join(known, "vec_id"), "anchors")
    negatives = _searched(
        _tiles(rows, asked, ["positives"]),
        _negatives,
        n_negatives,
        ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
    )
    ranked = _best(
        negatives, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives
    )
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
