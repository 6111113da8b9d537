"""Toxicity scores from subword embeddings averaged into a linear softmax.

A text is the bag of the character n-grams of its distinct words, with marks for word ends, and
of the words themselves. Each hashed n-gram has an embedding; their mean, with a fixed number of
zeros added so that a few n-grams decide nothing by chance, goes into a linear softmax.
Embeddings and softmax are trained jointly by stochastic gradient descent on a bounded labelled
sample. A word never seen before is scored by the n-grams it shares with known ones.

As the softmax is linear in the mean, a trained model is one number per n-gram: scoring reads
each text once and adds up numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempolake.llm import arrowtext, pretoken

#: Labelled texts per class in the training sample, the bound of what the driver gets.
SAMPLE = {0: 2400, 1: 1200}
BUCKETS_LOG2 = 17
SIZES = (3, 4, 5, 6)
DIMENSIONS = 8
#: Zeros in every mean.
ZEROS = 200
#: Training steps, a text each: small samples are gone over more often.
STEPS = 40_000
RATE = 2.0
_SEED = 7

_U32 = np.uint32
_GAP = 1


@dataclass(frozen=True)
class Model:
    """The weight of every n-gram for the toxic class, and that of a text without any."""

    weights: np.ndarray
    bias: float


_folded: np.ndarray | None = None


def _fold() -> np.ndarray:
    """By code point, the lower-case code point; white space is the gap."""
    global _folded
    if _folded is None:
        table = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x30000):
            lower = chr(c).lower()
            if len(lower) == 1:
                table[c] = ord(lower)
        table[pretoken.classes() == pretoken.SPACE] = _GAP
        _folded = table
    return _folded


def features(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram buckets, their row) of the distinct words of consecutive rows.

    Every row stands between gaps; the gap before a word counts as part of it.
    """
    rows = len(bounds) - 1
    stream = np.insert(_fold()[points], bounds, _GAP)
    gap = stream == _GAP
    gaps = np.concatenate([[0], np.cumsum(gap)])
    row = np.repeat(np.arange(rows + 1), np.diff(bounds, append=len(points)) + 1)
    size = len(stream)
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    words = arrowtext.span_hashes(stream, start, end)
    order = np.lexsort((words, row[start]))
    again = np.zeros(len(words), bool)
    again[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (
        row[start][order[1:]] == row[start][order[:-1]]
    )
    first = np.zeros(size, np.int8)
    first[start[~again] - 1] = 1
    first[end[~again]] -= 1
    first = np.cumsum(first, dtype=np.int8).astype(bool)  # in a word that is new in its row
    hashed = stream * _U32(0x9E3779B1)
    found, owner = [], []
    for n in range(2, max(SIZES) + 1):
        hashed = hashed[: size - n + 1] * _U32(0x85EBCA6B) + stream[n - 1 :]
        if n not in SIZES or size < n:
            continue
        # A gap may stand at either end, as the mark of a word's start or end.
        inner = gaps[n - 1 : size] == gaps[1 : size - n + 2]
        inner &= first[: size - n + 1] & ~(gap[: size - n + 1] & gap[n - 1 :])
        at = np.flatnonzero(inner)
        mixed = (hashed[at] ^ (hashed[at] >> _U32(15))) * _U32(0xC2B2AE35)
        found.append((mixed >> _U32(32 - BUCKETS_LOG2)).astype(np.int32))
        owner.append(row[at])
    found.append((words[~again] >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int32))
    owner.append(row[start[~again]])
    return np.concatenate(found), np.concatenate(owner)


def _chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = arrowtext.byte_rows(column)
    for first, last in arrowtext.row_spans(offsets, arrowtext.CHUNK_BYTES // 2):
        _, points, bounds = arrowtext.code_points(data, offsets[first : last + 1])
        yield last - first, *features(points, bounds)


def _sample(documents: DataFrame, labels: DataFrame, sample: dict[int, int]) -> DataFrame:
    """(toxic, buckets, counts) of a bounded number of labelled texts per class."""
    one_each = (
        labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(*sample))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .join(documents.filter("text is not null").select("doc_id"), "doc_id", "left_semi")
    )
    # The first few of each class: every task keeps that many at most, whatever the class holds.
    first = [
        one_each.filter(F.col("toxic") == label)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
        .select("doc_id", "toxic")
        for label, most in sample.items()
    ]
    ids = reduce(DataFrame.union, first)
    # As many rows as the sample at most, so texts outside it never leave the scan.
    joined = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    again = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    chosen = joined.filter("text is not null").withColumn("n", F.row_number().over(again))
    chosen = chosen.filter(F.col("n") == 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, toxic = 0, batch.column("toxic").to_pylist()
            for rows, buckets, row in _chunks(batch.column("text")):
                for i in range(rows):
                    own, counts = np.unique(buckets[row == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([toxic[at + i]], pa.int32()),
                            pa.array([own.astype("<i4").tobytes()]),
                            pa.array([counts.astype("<i4").tobytes()]),
                        ],
                        ["toxic", "buckets", "counts"],
                    )
                at += rows

    return chosen.select("toxic", "text").mapInArrow(
        task, "toxic int, buckets binary, counts binary"
    )


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]]) -> Model | None:
    """Embeddings and softmax trained jointly on (label, buckets, counts); None without any."""
    if not bags:
        return None
    random = np.random.default_rng(_SEED)
    embeddings = random.uniform(-0.1, 0.1, (1 << BUCKETS_LOG2, DIMENSIONS)).astype(np.float32)
    softmax = np.array([[-1.0], [1.0]], np.float32) * random.uniform(0.5, 1, DIMENSIONS)
    softmax = softmax.astype(np.float32)
    toxic = sum(label for label, _, _ in bags)
    bias = np.log(np.array([len(bags) - toxic + 1, toxic + 1], np.float32) / len(bags))
    squares = np.full(1 << BUCKETS_LOG2, 1e-4, np.float32)
    softmax_squares, bias_squares = np.full_like(softmax, 1e-4), np.full_like(bias, 1e-2)
    epochs = -(-STEPS // len(bags))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for i in random.permutation(len(bags)):
            label, buckets, counts = bags[i]
            if not len(buckets):
                continue
            share = (counts / (counts.sum() + ZEROS)).astype(np.float32)
            rows = embeddings[buckets]
            mean = share @ rows
            logits = softmax @ mean + bias
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = error @ softmax
            slope = np.outer(error, mean)
            softmax_squares += slope * slope
            softmax -= 0.1 * rate * slope / np.sqrt(softmax_squares)
            bias_squares += error * error
            bias -= 0.1 * rate * error / np.sqrt(bias_squares)
            # Adaptive steps per n-gram: rare ones move as far as common ones.
            squares[buckets] += share * share * float(back @ back) / DIMENSIONS
            step = rate * share / np.sqrt(squares[buckets])
            embeddings[buckets] = rows - step[:, None] * back
    weights = embeddings @ (softmax[1] - softmax[0])
    return Model(weights.astype(np.float64), float(bias[1] - bias[0]))


def train(
    documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE
) -> Model | None:
    """A model from texts (doc_id, text) and labels (doc_id, toxic 0 or 1).

    The sample takes labelled texts in the order of a hash of their id, whole, up to the given
    number per class; of rows with the same doc_id one text and the larger label. None without
    a labelled text.
    """
    bags = [
        (r["toxic"], np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["counts"], "<i4"))
        for r in _sample(documents, labels, sample).toLocalIterator()
    ]
    # In an order of their own, whichever task was first.
    bags.sort(key=lambda bag: (bag[0], len(bag[1]), zlib.crc32(bag[1]), zlib.crc32(bag[2])))
    return fit(bags)


def scores(model: Model, column: pa.Array) -> Iterator[np.ndarray]:
    """Scores of consecutive ranges of rows."""
    for rows, buckets, row in _chunks(column):
        sums = np.bincount(row, model.weights[buckets], minlength=rows)[:rows]
        counts = np.bincount(row, minlength=rows)[:rows]
        logits = sums / (counts + ZEROS) + model.bias
        yield 1 / (1 + np.exp(-np.clip(logits, -700, 700)))


def score(
    rows: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``rows`` with score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    Null and empty texts get the score of a text without n-grams, which is the share of toxic
    texts in training; without a model all scores are 0. A score of exactly 0.5 counts as toxic.
    Each row is scored on its own, so repeated rows get the same score, and an empty table gives
    no rows. Columns that have the result's names are replaced, all others kept; ``keep`` narrows
    them.
    """
    names = ["score", "predicted"]
    kept = [c for c in (keep or rows.columns) if c not in names]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns = list(dict.fromkeys([*kept, text]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = batch.column(text)
            found = list(scores(own, column)) if own else [np.zeros(len(batch))]
            score = np.concatenate([*found, np.empty(0)])
            predicted = (score >= 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).columns, pa.array(score), pa.array(predicted)],
                [*kept, *names],
            )

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    return rows.select(*columns).mapInArrow(
        task, ", ".join([*schema, "score double", "predicted int"])
    )
