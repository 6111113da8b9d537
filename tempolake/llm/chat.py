"""Chat formatting with typed content parts, a loss mask, and reading back.

A turn's content is a list of typed parts. A visitor with one method per type turns each part
into text of the template: text is escaped, attachments become numbered placeholders and are
recorded with their reference and the number of tokens they expand to.

    ### user: Look at this: <|image:1|></turn>

Every ``\\``, ``#``, ``<`` and ``:`` of a text or a role is written with a backslash before it,
so no text can hold a mark of the template, and taking the backslashes away gives it back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolake.llm import scratch

HEAD, COLON, END = "### ", ": ", "</turn>\n"

#: The columns of a part; attachments have a reference and the sizes of their kind.
PART = (
    "struct<type: string, text: string, uri: string, width: int, height: int, "
    "seconds: double, pages: int>"
)

_ESCAPED = r"([\\#<:])"
_TURN = re.compile(
    r"### (?P<role>(?:[^\\#<:]+|\\.)*): (?P<body>(?:[^\\#<:]+|\\.|<\|\w+:\d+\|>)*)</turn>\n",
    re.DOTALL,
)
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: Column) -> Column:
    """``text`` without marks of the template; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ESCAPED, r"\\$1")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class PartVisitor:
    """What the template makes of each type of part: its text and its expanded tokens."""

    def __init__(self, patch: int = 28, tokens_per_second: int = 25, tokens_per_page: int = 768):
        self.patch, self.rate, self.page = patch, tokens_per_second, tokens_per_page

    def text(self, part: Column, number: Column) -> tuple[Column, Column]:
        return escape(part["text"]), F.lit(0)

    def image(self, part: Column, number: Column) -> tuple[Column, Column]:
        across, down = (F.ceil(part[side] / self.patch) for side in ("width", "height"))
        return self._placeholder("image", number), across * down

    def audio(self, part: Column, number: Column) -> tuple[Column, Column]:
        return self._placeholder("audio", number), F.ceil(part["seconds"] * self.rate)

    def document(self, part: Column, number: Column) -> tuple[Column, Column]:
        return self._placeholder("document", number), part["pages"] * self.page

    @staticmethod
    def _placeholder(kind: str, number: Column) -> Column:
        return F.concat(F.lit(f"<|{kind}:"), number.cast("string"), F.lit("|>"))

    def visit(self, part: Column, number: Column) -> Column:
        """struct(text, kind, uri, tokens); a null or unknown type is taken as text."""

        def made(kind: str, result: tuple[Column, Column]) -> Column:
            text, tokens = result
            return F.struct(
                text.alias("text"),
                F.lit(kind).alias("kind"),
                part["uri"].alias("uri"),
                F.coalesce(tokens.cast("long"), F.lit(0).cast("long")).alias("tokens"),
            )

        out = made("text", self.text(part, number))
        for kind in ("image", "audio", "document"):
            one = made(kind, getattr(self, kind)(part, number))
            out = F.when(part["type"] == kind, one).otherwise(out)
        return out


def text_part(text: Column) -> Column:
    """Content of one text part."""
    nothing = F.from_json(F.lit("{}"), PART)
    part = nothing.withField("type", F.lit("text")).withField("text", text)
    return F.array(part)


def format_turns(turns: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """Formats rows (conv_id, turn, role, content array of ``PART``), one by one.

    Returns conv_id, turn, segment (the turn in the template; a conversation is its segments in
    order), loss_start and loss_chars (the part of the segment that is learned: the content of
    an assistant turn, else nothing), attachments (number, kind, uri, tokens in order) and
    expanded_tokens. Null roles and texts are empty, null content has no parts; attachments are
    numbered from 1 within a turn. Other columns are ignored.
    """
    visitor = visitor or PartVisitor()
    content = F.coalesce(F.col("content"), F.array().cast(f"array<{PART}>"))
    numbered = F.transform(
        "content",
        lambda part, i: F.struct(
            part.alias("part"),
            F.size(
                F.filter(
                    F.slice(F.col("content"), F.lit(1), i + 1),
                    lambda p: F.coalesce(p["type"], F.lit("text")) != "text",
                )
            ).alias("number"),
        ),
    )
    rows = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            content.alias("content"),
        )
        .withColumn("numbered", numbered)
        .withColumn(
            "visited", F.transform("numbered", lambda n: visitor.visit(n["part"], n["number"]))
        )
    )
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(COLON))
    body = F.array_join(F.transform("visited", lambda v: v["text"]), "")
    rows = rows.withColumn("head", head).withColumn("body", body)
    learned = F.col("role") == "assistant"
    attachments = F.filter(
        F.transform(
            "visited",
            lambda v, i: F.struct(
                F.get(F.col("numbered"), i)["number"].alias("number"), v["kind"].alias("kind"),
                v["uri"].alias("uri"), v["tokens"].alias("tokens"),
            ),
        ),
        lambda a: a["kind"] != "text",
    )
    return rows.select(
        "conv_id",
        "turn",
        F.concat("head", "body", F.lit(END)).alias("segment"),
        F.length("head").cast("long").alias("loss_start"),
        F.when(learned, F.length("body")).otherwise(0).cast("long").alias("loss_chars"),
        attachments.alias("attachments"),
        F.aggregate(
            "visited", F.lit(0).cast("long"), lambda total, v: total + v["tokens"]
        ).alias("expanded_tokens"),
    )


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    found = _TURN.fullmatch(segment)
    if not found:
        raise ValueError("not a turn of the template")
    return unescape(found["role"]), unescape(found["body"])


class _Digest:
    """The digests of one conversation, fed turn by turn."""

    def __init__(self, name: int | None):
        self.name, self.turns, self.loss_chars, self.chars = name, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, length: int) -> None:
        role, text = read_turn(segment)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = unescape(segment[start : start + length])
        self.loss.update(learned.encode("utf-8", "surrogatepass"))
        self.turns += 1
        self.loss_chars += len(learned)
        self.chars += len(segment)

    def row(self) -> tuple:
        hashes = self.all.hexdigest(), self.loss.hexdigest()
        return self.name, self.turns, hashes[0], self.loss_chars, hashes[1], self.chars


_DIGESTS = (
    ("conv_id", pa.int64(), "long"),
    ("n_turns", pa.int64(), "long"),
    ("turns_sha256", pa.string(), "string"),
    ("loss_chars", pa.int64(), "long"),
    ("loss_sha256", pa.string(), "string"),
    ("formatted_chars", pa.int64(), "long"),
)


def digests(segments: DataFrame) -> DataFrame:
    """What is read back of each formatted conversation, as counts and digests.

    Turns stand in the order of ``turn`` (null first), equal ones in that of their segments. The
    rows of a conversation stream through one task, as a digest is made front to back; the task
    holds one turn at a time, however long the conversation is. Rows without conv_id are one
    conversation of their own.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[] for _ in _DIGESTS]
            arrays = [pa.array(c, t) for c, (_, t, _) in zip(columns, _DIGESTS, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [n for n, _, _ in _DIGESTS])

        for batch in batches:
            names = ("conv_id", "segment", "loss_start", "loss_chars")
            for name, *turn in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if now is None or now.name != name:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(name)
                now.add(*turn)
            yield out()
            done.clear()
        if now is not None:
            done.append(now.row())
        yield out()

    partitions = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        segments.select("conv_id", "turn", "segment", "loss_start", "loss_chars")
        .repartition(partitions, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "segment")
    )
    return ordered.mapInArrow(task, ", ".join(f"{n} {s}" for n, _, s in _DIGESTS))


def formatted_digests(turns: DataFrame) -> DataFrame:
    """Formats rows (conv_id, turn, role, text), writes them and reads the digests back."""
    content = text_part(F.col("text")).alias("content")
    segments = format_turns(turns.select("conv_id", "turn", "role", content))
    return digests(scratch.written(segments, "formatted"))
