"""Text and vector similarity against brute force."""

import random
import re

import numpy as np
import pytest

from llm_words import words  # noqa: F401
from pyspark.sql import functions as F

from tempolake.llm import ann, components, jaccard, near_vectors


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n):
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return frozenset()
    if len(found) < n:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_join_equals_brute_force(spark, words, n, percent):
    rng = random.Random(n)
    texts = {i: words(i, rng.randint(3, 60)) for i in range(40)}
    for i in range(40, 160):  # chains of near copies
        copied = texts[rng.randrange(i)].split()
        for _ in range(rng.randint(0, 3)):
            copied[rng.randrange(len(copied))] = f"neu{i}"
        texts[i] = " ".join(copied)
    texts |= {
        200: None, 201: "", 202: " \t\n", 203: "One", 204: "oNE", 205: "one two", 206: "É é",
        207: "é É", 208: texts[0].upper(), 209: (texts[1] + " ") * 400, 210: (texts[1] + " ") * 401,
    }
    rows = [(i, t, "x", 1) for i, t in texts.items()]
    rows += [(None, texts[0], "x", 1), (5, texts[5], "y", 2), (5, texts[5], "y", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string, n int")
    got = jaccard.join(frame, words=n, percent=percent).collect()
    sets = {i: shingles(t, n) for i, t in texts.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b
        and sets[a]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        and sets[b]
    ]
    expected = smallest_reachable(sets, links)
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.n_shingles == len(sets[0])
        else:
            assert row.n_shingles == len(sets[row.doc_id])
            assert row.component_id == expected[row.doc_id]
            near = [b if a == row.doc_id else a for a, b in links if row.doc_id in (a, b)]
            times = {5: 3}
            assert row.n_links == sum(times.get(i, 1) for i in near) + times.get(row.doc_id, 1) - 1


@pytest.mark.parametrize("block", [256, 3])
def test_numbers_of_links_equal_brute_force(spark, monkeypatch, block):
    """Near copies of one text, exact copies, ids that stand for several texts, odd rows."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(17)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words_ = list(base)
        for _ in range(rng.randrange(6)):
            words_[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words_)))
    rows += [(i, rows[i % 7][1].upper()) for i in range(100, 130)]
    rows += [(3, "another text of a few words"), (3, "another text of a few words"), (3, rows[5][1])]
    rows += [(200, ""), (201, None), (202, " "), (None, rows[0][1]), (None, rows[0][1]), (203, "lone")]
    got = jaccard.join(
        spark.createDataFrame(rows, "doc_id long, text string"), words=2, percent=80
    ).collect()
    sets = [shingles(text, 2) for _, text in rows]
    expected = []
    for i, (doc_id, _) in enumerate(rows):
        number = sum(
            100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
            for j in range(len(rows))
            if j != i and doc_id is not None and rows[j][0] is not None and sets[i] and sets[j]
        )
        expected.append((doc_id, len(sets[i]), number))
    assert max(n for _, _, n in expected) > 30
    assert sorted(str((r.doc_id, r.n_shingles, r.n_links)) for r in got) == sorted(map(str, expected))
    without = jaccard.join(
        spark.createDataFrame(rows, "doc_id long, text string"), 2, 80, links=False
    )
    assert without.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(str(tuple(r)) for r in without.collect()) == sorted(str(tuple(r)[:3]) for r in got)


def test_query_counts_all_links(spark):
    from tempolake.llm.queries import op5_ngram_jaccard

    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    sets = {r.doc_id: shingles(r.text, 4) for r in documents}
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    expected = {i: 0 for i in ids}
    for pair in links:
        for i in pair:
            expected[i] += 1
    assert links
    assert {r.doc_id: r.n_links for r in op5_ngram_jaccard(spark, folder).collect()} == expected


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(empty).count() == 0


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 140)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    pairs += [(7, i) for i in range(500, 560)] + [(9, 9)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.component_id for r in components.components(frame).collect()}
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == smallest_reachable(ids, [p for p in pairs if p[0] != p[1]])


def vectors(seed, count, dim=16):
    random_ = np.random.default_rng(seed)
    centres = random_.normal(size=(6, dim))
    near = centres[random_.integers(0, 6, count)] + 0.35 * random_.normal(size=(count, dim))
    near[1] = 3 * near[0]
    near[2] = near[0]
    return near.astype(np.float32)


ODD = [
    (900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15),
    (903, [float("inf")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, []), (906, [1.0, 0.0]),
    (907, [1.0, 0.1]),
]


@pytest.mark.parametrize("block", [4096, 37])
def test_links_equal_brute_force(spark, block):
    data = vectors(1, 200)
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(data)]
    rows += [(i, v, 2) for i, v in ODD] + [(None, rows[0][1], 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = {r.vec_id: r for r in near_vectors.links(frame, 0.9, block=block).collect()}
    assert len(got) == len(rows)
    wide = data.astype(np.float64)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    similar = unit @ unit.T >= 0.9
    np.fill_diagonal(similar, False)
    expected = smallest_reachable(range(200), np.argwhere(similar).tolist())
    for i in range(200):
        assert got[i].n_links == similar[i].sum()
        assert got[i].component_id == expected[i]
        assert got[i].kept == (expected[i] == i)
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[906].n_links == got[907].n_links == 1 and got[907].component_id == 906
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)


def test_links_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert near_vectors.links(empty).count() == 0


def test_error_bounds_hold():
    data = vectors(2, 300)
    codes, scale, missed = near_vectors.quantise(data)
    unit = data.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rough = (codes.astype(np.int64) @ codes.T.astype(np.int64)) * scale[:, None] * scale
    bound = missed[:, None] + missed + missed[:, None] * missed
    assert (np.abs(rough - unit @ unit.T) <= bound + 1e-12).all()


def nearest(ids, data, query, k):
    distance = np.sqrt(((data.astype(np.float64) - data[query].astype(np.float64)) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, distance)) if i != query][:k]
    return [(ids[i], distance[i]) for i in order]


def test_probes_come_in_order_of_cost():
    inside = np.array([0.1, 0.45, 0.8])
    found = ann.probes(inside, 12)
    cost = [
        sum((x if d < 0 else 1 - x) ** 2 for x, d in zip(inside, shift) if d) for shift in found
    ]
    assert cost == sorted(cost) and len({tuple(s) for s in found}) == 12
    assert not found[0].any()


def test_small_tables_return_all(spark):
    data = vectors(3, 8)
    rows = [(i, [float(x) for x in v], 0.0) for i, v in enumerate(data)] + [(i, v, 1.0) for i, v in ODD]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = ann.search(frame, frame.filter("vec_id % 2 = 0"), k=10).collect()
    ids = np.arange(8)
    for query in (0, 2, 4, 6):
        own = sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)
        expected = nearest(ids, data, query, 10)
        assert [r.rank for r in own] == list(range(1, 8))
        assert [r.vec_id for r in own] == [i for i, _ in expected]
        assert [r.score for r in own] == pytest.approx([d for _, d in expected], abs=1e-12)
    assert {r.query_id for r in got} == {0, 2, 4, 6, 906}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(empty, empty).count() == 0


def test_many_equal_vectors(spark):
    one = [1.0, 0.0, 0.5]
    rows = [(i, one) for i in range(60)] + [(100, [1.0, 0.1, 0.5]), (101, [0.0, 1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(frame, frame.filter("vec_id in (0, 40, 100)"), k=10).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 40, 100)}
    assert by == {0: list(range(1, 11)), 40: list(range(10)), 100: list(range(10))}


def test_recall(spark):
    from tempolake.llm.queries import op7_nearest_neighbours

    folder = "/root/testdata/sf0.1"
    stored = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in stored])
    data = np.array([r.embedding for r in stored], np.float32)
    got = op7_nearest_neighbours(spark, folder).collect()
    hits = total = 0
    for query in np.flatnonzero(ids % 100 == 0):
        expected = {i for i, _ in nearest(ids, data, query, 10)}
        found = {r.vec_id for r in got if r.query_id == ids[query]}
        assert len(found) == 10
        hits, total = hits + len(found & expected), total + 10
    assert hits / total >= 0.9


def test_of_vectors_with_one_id_the_least_counts(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 9)] + [(3, [0.5, 1.0]), (3, [7.5, 1.0])]
    rows += [(0, [4.0, 1.0]), (0, [8.0, 1.0]), (0, None)]
    for seed in range(3):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").orderBy(F.rand(seed))
        got = ann.search(frame, frame.filter("vec_id = 0"), k=3).collect()
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [
            (4, 0.0), (5, 1.0), (2, 2.0),
        ]


def broadcast(plan):
    """What lies below each broadcast of a plan, as text."""
    lines = plan.splitlines()
    depth = [len(re.match(r"[\s:+*()\d-]*", line)[0]) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i + 1 : end])


def test_probes_do_not_pass_the_driver(spark, monkeypatch):
    """Probes are 240 times their queries, so files of few queries must not let a plan broadcast them."""
    plans, tables = {}, {}
    written = ann.scratch.written

    def noted(rows, purpose):
        plans[purpose] = rows._jdf.queryExecution().executedPlan().toString()
        tables[purpose] = written(rows, purpose)
        return tables[purpose]

    monkeypatch.setattr(ann.scratch, "written", noted)
    data = vectors(5, 60)
    rows = [(i, [float(x) for x in data[i % 60]]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = ann.search(frame, frame.filter("vec_id % 3 = 0"), k=4)
    plans["result"] = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plans["found"]
    below = [x for plan in plans.values() for x in broadcast(plan)]
    assert below and not [x for x in below if "InArrow" in x]
    assert (tables["queries"].count(), tables["questions"].count()) == (100, 20)
    assert out.count() == 400


def test_a_row_meets_a_query_in_one_cell():
    import pyarrow as pa

    def full(parts):
        columns = {"number": [0] * 3, "bucket": [-4, 5, 9], "dim": [8] * 3, "parts": parts}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in columns.items()})

    parts = ann.Parts(full([3, 1, 7]), full([1, 4, 5]))
    ids = np.arange(200)
    cases = [(0, 9, 7, 5), (0, -4, 3, 1), (0, 5, 1, 4), (0, 7, 1, 1), (1, 9, 1, 1)]
    for number, bucket, rows_in, queries_in in cases:
        keys = np.full(200, bucket)
        sides = []
        for asked in (False, True):
            at, cells = parts.cells(number, 8, keys, ids, asked)
            sides.append([set(cells[at == i].tolist()) for i in ids])
            assert sum(map(len, sides[-1])) == len(at)
        assert all(len(row & query) == 1 for row in sides[0] for query in sides[1])
        assert len(set.union(*sides[0])) == rows_in * queries_in


@pytest.mark.parametrize("kind", ["float", "double"])
def test_full_buckets_are_dealt_over_cells(spark, monkeypatch, kind):
    """Crowded and lone vectors, found by probes or by comparing all, in cells of a few rows."""
    data = vectors(6, 400)
    data[300:] *= np.linspace(4, 90, 100, dtype=np.float32)[:, None]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + ODD
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    asked = frame.filter("vec_id % 2 = 0")

    def found():
        return sorted(tuple(r) for r in ann.search(frame, asked, k=6).collect())

    expected = found()
    assert len(expected) == 6 * 200 + 1
    purposes, counted = [], ann._counted
    monkeypatch.setattr(ann, "_counted", lambda *a: purposes.append(1) or counted(*a))
    monkeypatch.setattr(ann, "_CELL", 2000)
    monkeypatch.setattr(ann, "_ASKED", 7)
    monkeypatch.setattr(ann, "_STEP", 1)
    assert found() == expected and len(purposes) == 2
