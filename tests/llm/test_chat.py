"""Chat formatting: escapes, parts, masks and what is read back."""

import hashlib
import random

import pytest
from oracle_compare import assert_same, connect
from pyspark.sql import functions as F

from tempolake.llm import chat, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


NASTY = [
    "", "\\", "\\\\", "### user: ", "</turn>\n", "a\n### assistant: b</turn>\n", "<|image:1|>",
    "\\### Assistant: </turn> ok", "x: y", "\\n", "é🙂\t", "trailing \\", "\r\n\r\n",
]


def test_texts_and_roles_come_back(spark):
    rng = random.Random(1)
    texts = NASTY + ["".join(rng.choice("\\#<:>|/ \nab") for _ in range(40)) for _ in range(200)]
    rows = [(i, 0, role, t) for i, t in enumerate(texts) for role in ("user", "assis: #tant\\")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = frame.withColumn("content", chat.text_part(F.col("text")))
    got = chat.format_turns(made).collect()
    back = sorted((r.conv_id, *chat.read_turn(r.segment)) for r in got)
    assert back == sorted((i, role, t) for i, _, role, t in rows)
    with pytest.raises(ValueError):
        chat.read_turn("### user: a</turn>\n### user: b</turn>\n")


def test_parts_in_order(spark):
    part = "type string, text string, uri string, width int, height int, seconds double, pages int"
    rows = [
        (1, 0, "user", [
            ("text", "see <|image:1|>: ", None, None, None, None, None),
            ("image", None, "s3://i", 57, 28, None, None),
            ("text", " and ", None, None, None, None, None),
            ("audio", None, "a.wav", None, None, 2.5, None),
            ("document", None, None, None, None, None, 3),
            ("image", None, "no size", None, None, None, None),
            (None, "kept", None, None, None, None, None),
        ]),
        (1, 1, "assistant", [("text", "fine", None, None, None, None, None)]),
        (1, 2, None, None),
        (1, 3, "assistant", []),
    ]
    schema = f"conv_id long, turn int, role string, content array<struct<{part.replace(' ', ': ').replace(',:', ',')}>>"
    first, second, third, fourth = (
        chat.format_turns(spark.createDataFrame(rows, schema)).orderBy("turn").collect()
    )
    placeholders = " and <|audio:2|><|document:3|><|image:4|>kept</turn>\n"
    assert first.segment == "### user: see \\<|image\\:1|>\\: <|image:1|>" + placeholders
    assert [(a.number, a.kind, a.uri, a.tokens) for a in first.attachments] == [
        (1, "image", "s3://i", 3), (2, "audio", "a.wav", 63), (3, "document", None, 2304),
        (4, "image", "no size", 0),
    ]
    assert first.expanded_tokens == 3 + 63 + 2304 and first.loss_chars == 0
    assert second.segment[second.loss_start :][: second.loss_chars] == "fine"
    assert third.segment == "### : </turn>\n" and third.attachments == []
    assert (fourth.segment, fourth.loss_chars) == ("### assistant: </turn>\n", 0)


def test_digests_of_odd_conversations(spark):
    turns = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, None, "user", "first"),
        (2, 5, "assistant", None), (2, 5, "assistant", "tie"), (3, 0, None, None),
        (None, 0, "user", "x"), (None, 1, "assistant", "y"), (1, 1, "assistant", "b"),
    ]
    turns += [(9, i, "assistant", f"t{i} " * 200) for i in range(500)]
    frame = spark.createDataFrame(
        [(*t, "clash") for t in turns],
        "conv_id long, turn int, role string, text string, segment string",
    )
    got = {r.conv_id: r for r in chat.formatted_digests(frame).collect()}
    assert set(got) == {1, 2, 3, 9, None}
    assert got[1].turns_sha256 == sha("user\na\nassistant\nb\nassistant\nb\n")
    assert (got[1].loss_chars, got[1].loss_sha256) == (2, sha("bb"))
    assert got[2].turns_sha256 == sha("user\nfirst\nassistant\n\nassistant\ntie\n")
    assert got[3].turns_sha256 == sha("\n\n") and got[3].loss_sha256 == sha("")
    assert got[None].n_turns == 2
    assert got[9].loss_sha256 == sha("".join(f"t{i} " * 200 for i in range(500)))
    assert chat.formatted_digests(frame.limit(0)).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    sql = queries.oracle_sql()["op9_chat_format"]
    assert assert_same(queries.op9_chat_format(spark, folder), connect(folder), sql) > 10
