"""Hard negatives: products and rows against brute force, odd rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from oracle_compare import assert_same, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tempolake.llm import negatives

COLUMNS = [
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
]


def brute(rows, is_anchor, n_positives=5, n_negatives=5):
    """The contract in plain Python: rows of (vec_id, label, vector)."""
    kept = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in vector):
            continue
        kept[vec_id] = min(kept.get(vec_id, (label, vector)), (label, vector))
    whole = {i: (lab, [math.floor(256 * x) for x in v]) for i, (lab, v) in kept.items()}
    out = []
    for a, (label, v) in whole.items():
        if not is_anchor(a):
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), i, other)
            for i, (other, w) in whole.items()
            if i != a
        ]
        scored.sort()
        for p_score, p, _ in [s for s in scored if s[2] == label][:n_positives]:
            fits = [
                s for s in scored
                if s[2] != label and -80 * p_score <= -100 * s[0] <= -100 * p_score
            ]
            for rank, (n_score, n, _) in enumerate(fits[:n_negatives], 1):
                out.append((a, p, rank, n, -p_score, -n_score))
    return sorted(out)


def mined(spark, rows, is_anchor="vec_id % 10 = 0", **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = negatives.mine(frame, F.expr(is_anchor), **options)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def vectors(n, dims, seed, spread=0.3):
    draw = random.Random(seed)
    return [
        (i, draw.randrange(4), [draw.gauss(0.1, spread) for _ in range(dims)]) for i in range(n)
    ]


@pytest.mark.parametrize("size", [1, 200, 2**20, 2**31, 2**45])
def test_packed_products_are_exact(size):
    draw = random.Random(size)
    rows = [[draw.randint(-size, size) for _ in range(17)] for _ in range(50)]
    anchor = [draw.randint(-size, size) for _ in range(17)]
    kind = np.int64 if size < 2**24 else object
    for own in (rows, [[abs(x) for x in r] for r in rows], [[-abs(x) for x in r] for r in rows]):
        pack = negatives.Packed(np.array(own, kind))
        got = pack.scores(np.array(anchor, kind)).tolist()
        assert got == [sum(x * y for x, y in zip(r, anchor)) for r in own]


def test_fields_never_run_over():
    """All components at their extremes, where the sums fill their fields."""
    for a in (-256, -1, 0, 255, 256):
        for c in (-256, 0, 255, 256):
            pack = negatives.Packed(np.full((9, 64), c, np.int64))
            assert pack.scores(np.full(64, a, np.int64)).tolist() == [64 * a * c] * 9


def test_integers_round_down():
    column = pa.array([[0.1, -0.1, 1 / 256], [-1 / 512], [], [1e20]])
    got = negatives.integers(column, 3).tolist()
    assert got[:3] == [[25, -26, 1], [-1, 0, 0], [0, 0, 0]]
    assert got[3][0] == math.floor(256 * 1e20)


def test_rows_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATES", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "FIELDS", 16)
    rows = vectors(230, 5, 1)
    expected = brute(rows, lambda i: i % 10 == 0)
    assert len(expected) > 50
    assert mined(spark, rows) == expected
    assert mined(spark, rows, n_positives=2, n_negatives=1) == brute(
        rows, lambda i: i % 10 == 0, 2, 1
    )


def test_one_label_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATES", 40)
    rows = [(i, 0 if i % 5 else label, v) for i, label, v in vectors(200, 4, 2)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 3, 3) + [
        (None, 1, [1.0, 1.0, 1.0]), (100, None, [1.0, 1.0, 1.0]), (110, 1, None),
        (120, 1, [nan, 1.0, 1.0]), (130, 1, [1.0, None, 1.0]), (140, 1, [1.0, -inf, 1.0]),
        (150, 1, [1e308, 1.0, 1.0]), (160, 2, []), (170, 1, [1.0]), (180, 1, [1.0, 1.0, 1.0, 1.0]),
        (190, 1, [0.0, 0.0, 0.0]), (201, 9, [1.0, 1.0, 1.0]), (210, 9, [1.0, 1.0, 1.0]),
        (-10, 1, [1.0, 0.5, 0.5]),
    ]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_ties_and_repeated_rows(spark):
    rows = [(i, i % 3, [0.5, 0.25]) for i in range(40)]
    rows += rows[:20] + [(3, 2, [9.0, 9.0]), (4, 0, [0.75, 0.25]), (4, 1, [0.0, 0.25])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_huge_components(spark):
    rows = [(i, i % 2, [1e5 * (i + 1), -3e4 * i, 0.1]) for i in range(30)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="does not fit into 64 bits"):
        mined(spark, [(i, 0, [1e30, 1e30]) for i in range(3)])


def test_empty_tables_and_other_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []
    assert mined(spark, [(10, 1, [1.0])]) == []
    rows = vectors(50, 3, 5)
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    plain = sorted(map(tuple, negatives.mine(frame, F.expr("vec_id % 10 = 0")).collect()))
    extra = frame.selectExpr("*", "1 AS rank", "2 AS tile", "3 AS anchor_id", "4 AS `a b`")
    assert sorted(map(tuple, negatives.mine(extra, F.expr("vec_id % 10 = 0")).collect())) == plain


def test_query_matches_its_sql(spark):
    name = "op13_hard_negatives"
    query, sql = entry_module.queries()[name], entry_module.oracle_sql()[name]
    assert assert_same(query(spark, SMALL), connect(SMALL), sql) > 0
