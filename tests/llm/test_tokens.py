"""Word split, merge replay, decoding and packing against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from llm_words import words  # noqa: F401

from tempolake.llm import bpe, packing, pretoken
from tempolake.llm.queries import vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")

RANKS = vocabulary("byte_bpe_50k.tiktoken")
CASES = [
    "", None, "it's  'the\n\n  x  ", " 's", "''s 're'vell 'LL a'd\t\tb  c 12ab  ", "x　\x1cy",
    "aaaaaaaaaa 🙂🙂 é", "'", "'s", "x'", "  ", "\n", "a\n b", "don't'll", "<|endoftext|> a",
    "Straße naïve 漢字 ١٢٣ ́x", "a" * 3000,
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(RANKS),
        special_tokens={},
    )


def ids_of(texts):
    words = pretoken.WordIds(bpe.MergeReplay(bpe.read_ranks(RANKS)).encode)
    out = []
    for _, flat, counts in pretoken.row_ids(pa.array(texts, pa.string()), words):
        out += [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    return out


def test_encoding_equals_the_library(reference):
    rng = random.Random(1)
    alphabet = "a'sltdrve \n\t é1!🙂A"
    texts = CASES + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert ids_of(texts) == [reference.encode_ordinary(t or "") for t in texts]


def test_long_texts_are_cut_between_words(reference, monkeypatch, words):
    monkeypatch.setattr(pretoken, "LONG", 50)
    text = words(3, 2000) + "'s  \n" + words(4, 500)
    assert ids_of([text, "x"]) == [reference.encode_ordinary(text), reference.encode_ordinary("x")]


def test_words_survive_a_full_cache(reference, words):
    cache = pretoken.WordIds(bpe.MergeReplay(bpe.read_ranks(RANKS)).encode, slots_log2=4, limit=10)
    for seed in range(5):
        text = words(seed, 200)
        (_, flat, _), = pretoken.row_ids(pa.array([text]), cache)
        assert flat.tolist() == reference.encode_ordinary(text)


def test_a_lower_merge_goes_first(reference):
    # Merging at one place can make a pair of a lower rank than the merge at hand.
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdetinors") for _ in range(60)) for _ in range(300)]
    assert ids_of(texts) == [reference.encode_ordinary(t) for t in texts]


def test_encode_and_decode_rows(spark, reference):
    rows = [(i, t, "kept", [9]) for i, t in enumerate(CASES)] + [(None, "b", None, None)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    coded = bpe.decode(bpe.encode(frame.drop("decoded"), RANKS), RANKS).collect()
    assert len(coded) == len(rows)
    for row in coded:
        assert list(row.ids) == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, RANKS), RANKS).count() == 0


def test_query_digests(spark, reference):
    from tempolake.llm.queries import op8_byte_bpe

    documents = {
        r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    }
    rows = op8_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(documents)
    for row in rows:
        text = documents[row.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_differencing_balances():
    windows = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(i for w in windows for i in w) == list(range(5))
    sums = [sum([8, 7, 6, 5, 4][i] for i in w) for w in windows]
    assert abs(sums[0] - sums[1]) <= 2


def test_windows_rise_until_none_is_exceeded():
    assert packing.pack([]) == []
    assert len(packing.pack([700] * 5, 1024)) == 5
    rng = random.Random(2)
    lengths = [rng.randint(1, 256) for _ in range(3000)]
    windows = packing.pack(lengths, 1024)
    assert sorted(i for w in windows for i in w) == list(range(3000))
    assert max(sum(lengths[i] for i in w) for w in windows) <= 1024
    assert len(windows) * 1024 < 1.02 * sum(lengths)


def test_pack_documents(spark, words):
    texts = [*CASES, words(1, 4000), words(2, 900), words(2, 900)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "a", 2, "y"), (3, texts[3], 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length int, bin string")
    path = vocabulary("byte_bpe_50k.json")
    pieces = packing.pack_documents(frame, path, group_pieces=20).toPandas()
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    for doc_id, text, *_ in rows[: len(texts)]:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = pieces[pieces.doc_id == doc_id].drop_duplicates(["start"]).sort_values("start")
        assert own.start.tolist() == (own.length.cumsum() - own.length).tolist()
        assert own.length.sum() == len(ids) and set(own.doc_tokens) == {len(ids)}
        for p in own.itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length]) == p.ids_crc32
    for _, window in pieces.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert window.offset.tolist() == (window.length.cumsum() - window.length).tolist()
        assert window.length.sum() <= 1024
    assert pieces.doc_id.isna().sum() == 1 and (pieces.doc_id == 3).sum() == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(empty, path).count() == 0
