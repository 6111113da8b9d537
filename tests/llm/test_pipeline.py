"""The pipeline's stages, each against brute force over its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_similarity import shingles, smallest_reachable

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_stage_names():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_duplicates", "packing"]


def test_language_stage(spark, documents):
    odd = documents.limit(4).withColumn("doc_id", F.col("doc_id") + 10_000)
    foreign = "это совсем другой текст на незнакомом языке и он не похож на другие " * 3
    changed = odd.withColumn(
        "text",
        F.when(F.col("doc_id") % 4 == 0, F.lit(None))
        .when(F.col("doc_id") % 4 == 1, "12 !? 34")
        .when(F.col("doc_id") % 4 == 2, foreign)
        .otherwise(F.col("text")),
    ).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, documents.unionByName(changed), FOLDER)
    assert kept.columns == documents.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids >= {r.doc_id for r in documents.filter(F.col("text").rlike(r"\p{L}")).collect()}
    bad = [r.doc_id for r in changed.filter("doc_id % 4 <> 3").collect()]
    assert not ids & set(bad)
    assert corpus_pipeline.language_id(spark, documents.limit(0), FOLDER).count() == 0


def test_toxic_stage(spark, documents):
    kept = corpus_pipeline.toxic(spark, documents, FOLDER)
    assert kept.columns == documents.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    clean = [i for i, toxic in labels.items() if not toxic]
    bad = [i for i, toxic in labels.items() if toxic]
    assert sum(i in ids for i in clean) >= 0.97 * len(clean)
    assert sum(i in ids for i in bad) <= 0.3 * len(bad)


def test_duplicate_stage(spark, documents):
    again = documents.filter("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 50_000)
    rows = documents.unionByName(again).unionByName(documents.filter("doc_id = 3"))
    rows = rows.unionByName(documents.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    got = corpus_pipeline.near_duplicates(spark, rows, FOLDER).collect()
    sets = {r.doc_id: shingles(r.text, 5) for r in rows.filter("doc_id is not null").collect()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[b]
    ]
    expected = sorted(i for i, least in smallest_reachable(sets, links).items() if i == least)
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == expected
    assert sum(r.doc_id is None for r in got) == 1


def test_run_packs_what_is_left(spark, documents):
    pieces = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert 0.5 * documents.count() < pieces.doc_id.nunique() <= documents.count()
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert pieces.groupby("sequence_id").length.sum().max() <= 1024


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1


def test_rows_that_differ_in_where_a_null_stands_both_stay(spark, documents):
    schema = documents.schema
    text = "one two three four five six seven"
    rows = [
        (1, text, None, "x", 3), (1, text, "x", None, 3), (1, text, "x", None, 3),
        (None, text, None, None, 3), (None, text, None, None, 3), (None, text, None, None, None),
        (2, None, None, None, None), (2, "", None, None, None), (None, None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, schema)
    got = corpus_pipeline.near_duplicates(spark, frame, FOLDER).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, set(rows)))


def test_stages_take_odd_rows(spark, documents):
    schema = documents.schema
    odd = [
        (None, None, None, None, None), (90_001, None, None, None, None), (90_002, "", None, None, 0),
        (90_003, "¿?", None, None, 2), (90_004, "word " * 100_000, "en", "s", 500_000),
        (90_004, "word " * 100_000, "en", "s", 500_000),
    ]
    rows = documents.unionByName(spark.createDataFrame(odd, schema))
    toxic = corpus_pipeline.toxic(spark, rows, FOLDER)
    assert toxic.filter("doc_id > 90000 OR doc_id IS NULL").count() == 6
    packed = corpus_pipeline.pack(spark, spark.createDataFrame(odd, schema), FOLDER)
    totals = packed.filter("doc_id = 90004").agg(F.sum("length"), F.max("doc_tokens")).first()
    assert totals[0] == 2 * totals[1] > 2 * 100_000
    lone = packed.filter("doc_id IN (90001, 90002) OR doc_id IS NULL").collect()
    assert [(r.length, r.doc_tokens) for r in lone] == [(1, 1)] * 3
    for stage in (corpus_pipeline.toxic, corpus_pipeline.near_duplicates, corpus_pipeline.pack):
        assert stage(spark, documents.limit(0), FOLDER).count() == 0


def test_short_foreign_texts_go_and_short_known_ones_stay(spark, documents):
    texts = ["это другой", "другое слово здесь", "the", "of the", "x"]
    rows = [(70_000 + i, t, None, None, len(t)) for i, t in enumerate(texts)]
    more = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    kept = corpus_pipeline.language_id(spark, more, FOLDER).filter("doc_id >= 70000")
    assert {r.doc_id - 70_000 for r in kept.collect()} == {2, 3, 4}
