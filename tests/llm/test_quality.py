"""The compression classifier against brute force, held-out labels and odd rows."""

import math
import random

import numpy as np
import pytest
import zstandard
from conftest import MEDIUM, SMALL

import __spark_entry__ as entry_module
from tempolake.llm import quality

GOOD = "the river and the old town lay under a quiet morning light before people came".split()
BAD = ["buy!!", "###", "$$$win", "click%%%", "now&&&", "FREE!!"]


def _texts(words, n, seed):
    draw = random.Random(seed)
    return [" ".join(draw.choices(words, k=draw.randint(20, 200))) for _ in range(n)]


@pytest.fixture(scope="module")
def tables(spark):
    texts = _texts(GOOD, 60, 1) + _texts(BAD, 60, 2)
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    return documents, labels


def _brute_size(dictionary, raw):
    settings = zstandard.ZstdCompressionParameters.from_level(
        quality.LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    shared = zstandard.ZstdCompressionDict(dictionary)
    pieces = [raw[i : i + quality.PIECE] for i in range(0, len(raw), quality.PIECE)]
    return sum(
        len(zstandard.ZstdCompressor(dict_data=shared, compression_params=settings).compress(p))
        for p in pieces
    )


def test_scores_are_the_calibrated_size_difference(spark, tables):
    model = quality.train(*tables)
    texts = [*_texts(GOOD, 3, 7), *_texts(BAD, 3, 8), "ß€ " * 2000, "x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in quality.score(rows, model).collect()}
    for i, text in enumerate(texts):
        raw = text.encode()
        saved = _brute_size(model.bad, raw) - _brute_size(model.good, raw)
        difference = saved / (len(raw) + quality.PADDING)
        chance = 1 / (1 + math.exp(-(difference * model.slope + model.bias)))
        assert found[i].difference == pytest.approx(difference)
        assert found[i].score == pytest.approx(chance)
        assert found[i].predicted == int(chance >= 0.5)


def test_curve_is_the_best_logistic_fit():
    draw = np.random.default_rng(3)
    x = draw.normal(size=400)
    y = (draw.random(400) < 1 / (1 + np.exp(-(3 * x - 1)))).astype(int)
    slope, bias = quality.calibrate(x, y)
    n, k = len(y), y.sum()
    target = np.where(y == 1, (k + 1) / (k + 2), 1 / (n - k + 2))

    def loss(a, b):
        logit = a * x + b
        return (np.logaddexp(0, logit) - target * logit).sum()

    best = loss(slope, bias)
    assert all(
        best <= loss(slope + a, bias + b) + 1e-9 for a in (-0.01, 0, 0.01) for b in (-0.01, 0, 0.01)
    )


def test_curve_without_spread_or_rows():
    assert quality.calibrate(np.array([]), np.array([])) == (0.0, 0.0)
    slope, bias = quality.calibrate(np.array([0.5, 0.5]), np.array([1, 0]))
    assert slope == 0.0 and bias == 0.0
    slope, bias = quality.calibrate(np.array([0.0, 1.0]), np.array([0, 1]))
    assert math.isfinite(slope) and math.isfinite(bias) and slope > 0


def test_separates_unseen_texts(spark, tables):
    model = quality.train(*tables)
    unseen = [(0, t) for t in _texts(BAD, 20, 31)] + [(1, t) for t in _texts(GOOD, 20, 32)]
    rows = spark.createDataFrame(unseen, "quality int, text string")
    assert all(r.predicted == r.quality for r in quality.score(rows, model).collect())


def test_odd_rows(spark, tables):
    documents, labels = tables
    odd = spark.createDataFrame(
        [(None, None), (None, "text"), (1, None), (500, ""), (501, "lone"), (501, "lone")],
        "doc_id long, text string",
    )
    more = spark.createDataFrame(
        [(None, 1), (500, 0), (2, 0), (3, None), (4, 7)], "doc_id long, quality int"
    )
    model = quality.train(documents.union(odd), labels.union(more).union(labels))
    assert model is not None
    extra = odd.selectExpr("*", "'mine' AS score", "1 AS `a b`", "2 AS _other")
    found = quality.score(extra, model).collect()
    assert len(found) == 6
    assert found[0].asDict().keys() == {
        "doc_id", "text", "a b", "_other", "difference", "score", "predicted"
    }
    empty = {r.score for r in found if not r.text}
    assert len(empty) == 1
    assert len({r.score for r in found if r.text == "lone"}) == 1
    assert all(0 <= r.score <= 1 for r in found)


def test_repeated_rows_teach_once(spark, tables):
    documents, labels = tables
    once = quality.train(documents, labels)
    assert quality.train(documents.union(documents), labels.union(labels)) == once


def test_empty_tables(spark, tables):
    documents, labels = tables
    assert quality.train(documents.limit(0), labels) is None
    assert quality.train(documents, labels.limit(0)) is None
    without = quality.score(documents, None).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in without] == [(0.0, 0)]
    assert quality.score(documents.limit(0), quality.train(*tables)).count() == 0
    good_only = quality.train(documents, labels.filter("quality = 1"))
    assert quality.score(documents, good_only).filter("score > 0.9").count() == 120


def test_very_long_text(spark, tables):
    model = quality.train(*tables)
    long = spark.createDataFrame([(" ".join(GOOD * 40_000),), ("FREE!! " * 400_000,)], "text string")
    good, bad = quality.score(long, model).orderBy("text", ascending=False).collect()
    assert good.predicted == 1 and bad.predicted == 0


def test_query_is_right_on_held_out_labels(spark):
    found = entry_module.queries()["op11_quality"](spark, MEDIUM)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = found.filter("held_out").join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in bad) <= 0.2 * len(bad)
    assert sum(r.predicted for r in good) >= 0.9 * len(good)


def test_query_never_learns_from_held_out_labels(spark, tmp_path):
    """Turning the held-out labels round changes no score."""
    folder = str(tmp_path)
    spark.read.parquet(f"{SMALL}/documents.parquet").write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    held = "crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2"
    labels.selectExpr(
        "doc_id", f"CASE WHEN {held} THEN 1 - quality ELSE quality END AS quality", "toxic"
    ).write.parquet(f"{folder}/labels.parquet")
    query = entry_module.queries()["op11_quality"]
    columns = ["doc_id", "held_out", "score", "predicted"]
    before = sorted(map(tuple, query(spark, SMALL).select(*columns).collect()))
    assert sorted(map(tuple, query(spark, folder).select(*columns).collect())) == before
