"""Quality scores from how well good and bad text help to compress a text.

One zstandard dictionary is trained on labelled good texts, one on labelled bad ones. A text is
cut into pieces, each compressed with either dictionary on its own, so that a long text cannot
become its own dictionary and every part of it counts alike. The bytes that the good dictionary
saves over the bad one, per byte of text, are the text's difference; a logistic curve, fitted to
labelled texts that are in neither dictionary, turns it into the chance that the text is good.
Text that says nothing new (one word over and over) compresses to nothing with both and so gets
the small difference of a bad text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolake.llm import arrowtext

#: Labelled texts per class for the dictionaries, and as many for the calibration.
SAMPLE_TEXTS = 1000
#: Pieces of one text that go into a dictionary's sample at most, spread over the whole text.
SAMPLE_PIECES = 4
#: Bytes of text that are compressed at a time.
PIECE = 1024
#: Size of a dictionary.
DICTIONARY = 112_640
LEVEL = 3
#: Bytes added to a text's length, so that a few saved bytes decide nothing in a short text.
PADDING = 50


@dataclass(frozen=True)
class Model:
    """Two dictionaries (good, bad; empty: none) and the curve from difference to chance."""

    good: bytes
    bad: bytes
    slope: float
    bias: float


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Frames without head or checksum, whose bytes would blur the difference."""
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=settings)
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=settings)


def build_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on ``samples``; too few of them to train on are taken as they are."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY:]


@lru_cache(maxsize=4)
def _pair(good: bytes, bad: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    return _compressor(good), _compressor(bad)


def differences(good: bytes, bad: bytes, column: pa.Array) -> np.ndarray:
    """Bytes the good dictionary saves over the bad one, per byte, of every whole text."""
    first, second = _pair(good, bad)
    data, offsets = arrowtext.byte_rows(column)
    view = memoryview(data)
    saved = np.zeros(len(column))
    for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for at in range(start, end, PIECE):
            piece = view[at : min(at + PIECE, end)]
            saved[row] += len(second.compress(piece)) - len(first.compress(piece))
    return saved / (np.diff(offsets) + PADDING)


def calibrate(difference: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the chance of ``good`` by ``difference``, by Newton's method.

    The labels are softened by one text of either class, so that the curve stays finite when
    the difference separates the classes.
    """
    positive, count = float(good.sum()), len(good)
    bias = float(np.log((positive + 1) / (count - positive + 1)))
    if not count:
        return 0.0, bias
    centre, spread = float(difference.mean()), float(difference.std())
    if not spread:
        return 0.0, bias
    target = np.where(good == 1, (positive + 1) / (positive + 2), 1 / (count - positive + 2))
    x = np.column_stack([(difference - centre) / spread, np.ones(count)])

    def loss(weights: np.ndarray) -> float:
        logits = x @ weights
        return float((np.logaddexp(0, logits) - target * logits).sum())

    w = np.array([0.0, bias])
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (chance - target)
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + 1e-9 * np.eye(2)
        step, share = np.linalg.solve(curve, slope), 1.0
        while loss(w - share * step) > loss(w) and share > 1e-6:
            share /= 2
        w = w - share * step
        if np.abs(share * step).max() < 1e-10:
            break
    return float(w[0] / spread), float(w[1] - w[0] * centre / spread)


def _sample(documents: DataFrame, labels: DataFrame, texts: int) -> DataFrame:
    """(quality, use, text) of at most ``2 * texts`` labelled texts per class.

    They are the first by a hash of their id; every other one is for the calibration.
    """
    quality = F.col("quality").cast("int")
    agreed = (
        labels.select("doc_id", quality.alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_other"))
        .filter(F.col("quality") == F.col("_other"))
        .select("doc_id", "quality")
    )
    present = documents.filter(F.length("text") > 0).select("doc_id")
    labelled = agreed.join(present, "doc_id", "left_semi")
    mixed = F.xxhash64(F.lit("sample"), "doc_id")
    first = [
        labelled.filter(F.col("quality") == label)
        .orderBy(mixed, "doc_id")
        .limit(2 * texts)
        .withColumn("use", F.xxhash64(F.lit("use"), "doc_id") % 2)
        for label in (0, 1)
    ]
    # At most four times ``texts`` rows, so the rest of the texts stays in its scan.
    ids = F.broadcast(reduce(DataFrame.union, first))
    one = documents.select("doc_id", "text").filter(F.length("text") > 0).join(ids, "doc_id")
    # Of rows with one doc_id the least text counts.
    return one.groupBy("doc_id", "quality", "use").agg(F.min("text").alias("text"))


def _pieces(rows: DataFrame) -> DataFrame:
    """(quality, doc_id, piece) of a few pieces spread evenly over each text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("quality", "doc_id", "text"))
            for quality, doc_id, text in zip(*columns, strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                starts = np.linspace(0, max(len(raw) - PIECE, 0), SAMPLE_PIECES)
                for at in sorted({int(s) for s in starts}) if len(raw) > PIECE else [0]:
                    found.append((quality, doc_id, raw[at : at + PIECE]))
            yield pa.RecordBatch.from_pylist(
                [{"quality": q, "doc_id": d, "piece": p} for q, d, p in found],
                pa.schema([("quality", pa.int32()), ("doc_id", pa.string()), ("piece", pa.binary())]),
            )

    named = rows.select("quality", F.col("doc_id").cast("string").alias("doc_id"), "text")
    return named.mapInArrow(task, "quality int, doc_id string, piece binary")


def train(
    documents: DataFrame, labels: DataFrame, texts: int = SAMPLE_TEXTS
) -> Model | None:
    """A model from texts (doc_id, text) and labels (doc_id, quality 0 or 1).

    Learns from at most ``2 * texts`` labelled texts per class, half for the dictionaries (some
    pieces of each) and half, whole, for the curve. Null and empty texts teach nothing, neither do
    labels of one doc_id that differ; repeated rows count once. With one class only, the score
    is nearly that class for all texts; without labelled texts there is no model.
    """
    sample = _sample(documents, labels, texts).persist()
    try:
        parts = _pieces(sample.filter("use = 0")).collect()
        parts.sort(key=lambda r: (r["doc_id"], r["piece"]))
        good, bad = (
            build_dictionary([bytes(r["piece"]) for r in parts if r["quality"] == label])
            for label in (1, 0)
        )
        rest = _with_difference(sample.filter("use <> 0"), good, bad, ["quality"]).collect()
    finally:
        sample.unpersist()
    if not parts and not rest:
        return None
    rest.sort(key=lambda r: (r["quality"], r["difference"]))
    slope, bias = calibrate(
        np.array([r["difference"] for r in rest]), np.array([r["quality"] for r in rest])
    )
    return Model(good, bad, slope, bias)


def _with_difference(
    rows: DataFrame, good: bytes, bad: bytes, kept: list[str], text: str = "text"
) -> DataFrame:
    """The ``kept`` columns of ``rows`` and the difference of every whole text."""
    shared = rows.sparkSession.sparkContext.broadcast((good, bad))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = differences(*shared.value, batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).columns, pa.array(found)], [*kept, "difference"]
            )

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    columns = list(dict.fromkeys([*kept, text]))
    return rows.select(*columns).mapInArrow(task, ", ".join([*schema, "difference double"]))


def _chance(model: Model) -> Column:
    logit = F.col("difference") * model.slope + model.bias
    return 1 / (1 + F.exp(-logit))


def score(
    rows: DataFrame,
    model: Model | None,
    threshold: float = 0.5,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``rows`` with difference, score (0 to 1) and predicted (1 from ``threshold`` on).

    Null and empty texts have the difference 0 and the score that belongs to it; without a model
    all scores are 0. Each row is scored on its own, so repeated rows get the same score, and no
    rows give none. Columns that have the results' names are replaced, all others kept; ``keep``
    narrows them.
    """
    names = ["difference", "score", "predicted"]
    kept = [c for c in (keep or rows.columns) if c not in names]
    if model is None:
        found = rows.select(*kept, F.lit(0.0).alias("difference"), F.lit(0.0).alias("score"))
    else:
        found = _with_difference(rows, model.good, model.bad, kept, text)
        found = found.withColumn("score", _chance(model))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
