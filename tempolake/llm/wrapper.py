"""Main text of web pages by wrappers inferred from the pages of each host.

A page becomes a stream of container tags and text slots; a slot carries its tag and the region
it lies in (article, boilerplate and so on). Repeats are folded, which makes the stream a
union-free regular expression: tags, slots, optional groups ``?`` and repeated groups ``+``.
The wrapper of a host starts as one page's expression and is aligned with one after another of
the others: what both have is matched, a mismatch becomes an optional group, a group that stands
next to an equal one becomes a repeated group, and texts that differ become text slots.

Every slot of the wrapper carries the least and greatest hash of its texts. Each expression is
then mapped onto its host's wrapper, slot by slot: a slot whose place in the wrapper holds the same
text on all pages of the host, whatever their expressions, is a notice or the like, also inside an
article. Of the regions of a page the one with the most text that varies over the host is the
main one. Class names only raise a suspicion: what they mark is left out as long as the page has
other text that varies. That gives, for each distinct expression of the host, the slots to keep;
pages are then joined with these.
"""

from __future__ import annotations

import hashlib
import html as html_escapes
import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempolake.llm import arrowtext, scratch

#: Repeated groups are found up to this many tokens.
_WIDEST = 16
#: Parts that a host's expressions, and its pages, are dealt into.
_SALTS = 32
#: Expressions or partial wrappers that are aligned in one group, on average.
_MERGED = 16
#: Different pages of a host from which a text that never changes counts as boilerplate, and
#: those it takes inside an article or the like.
_CONSTANT_PAGES, _CONSTANT_INSIDE = 3, 10
#: Pairs of items that are aligned by a whole table; longer sequences are halved first.
_TABLE = 1 << 21

# HTML elements by what they mean for the text.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = "noscript template svg math iframe object canvas".split()
_HEAD = set("meta link base basefont bgsound noscript template html".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul "
    "button textarea".split()
)
_LEAVES = set("p li dt dd h1 h2 h3 h4 h5 h6 td th caption pre blockquote figcaption".split())
_BOILERPLATE = set(
    "nav footer aside form menu dialog button select option optgroup textarea search title".split()
)
_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar toolbar".split()
)
_MARKED = set(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo "
    "promotion banner nav navbar navigation menu topbar sidebar side aside footer header masthead "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments commentlist disqus respond reply replies discussion "
    "social share sharing breadcrumb breadcrumbs related recommended recommendations pagination "
    "pager toolbar widget widgets search copyright".split()
)
_CONTENT = set("article content post entry story articlebody".split())
#: Words that a mark may be compounded with.
_COMPOUND = (
    _MARKED
    | _CONTENT
    | set(
        "site page top bottom global box bar list area links buttons form wrapper container block "
        "section item items articles posts entries stories".split()
    )
)
#: Marks that an article inside does not lift: what they hold often comes as articles.
_NESTED = set(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored sponsors promo "
    "promotion comment comments commentlist disqus respond reply replies discussion related "
    "recommended recommendations widget widgets".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<skip>script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
    r"(?<!/)>.*?(?:</(?P=skip)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_SKIPPED_TAG = re.compile(
    rf"<(?P<close>/?)(?P<tag>{'|'.join(_SKIPPED)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?",
    re.IGNORECASE,
)
_WORD = re.compile(r"[a-z]+")

#: Regions. What only a class name marks is suspect; COMMENTS stay that around articles, too.
ARTICLE, MAIN, CONTENT, OTHER, FORM, BOILER, SUSPECT, COMMENTS = "amcofbsx"


def _skipped_ends(html: str) -> dict[int, int]:
    """Where skipped elements end, by their start; those that are never closed are not skipped."""
    opened: dict[str, list[int]] = {name: [] for name in _SKIPPED}
    ends: dict[int, int] = {}
    for tag in _SKIPPED_TAG.finditer(html):
        starts = opened[tag["tag"].lower()]
        if not tag["close"] and not tag[0].endswith("/>"):
            starts.append(tag.start())
        elif tag["close"] and starts:
            ends[starts.pop()] = tag.end()
    return ends


class Page:
    """The text blocks of a page, their slots and the page's expression.

    ``key`` is a tuple of tags, slots (starting with ``#``) and ("+", key) groups; ``slots``
    holds, for each slot of it in order, the numbers of the blocks that stand there.
    """

    def __init__(self, html: str):
        self.blocks: list[str] = []
        items: list[tuple] = []  # (key, blocks by slot)
        stack: list[tuple[str, str]] = []  # (tag, region inside)
        buffer: list[str] = []

        def region() -> str:
            return stack[-1][1] if stack else OTHER

        def flush() -> None:
            text = " ".join(html_escapes.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                leaf = next((t for t, _ in reversed(stack[-2:]) if t in _LEAVES), "")
                items.append((f"#{region()}{leaf}", [[len(self.blocks)]]))
                self.blocks.append(text)

        at = 0
        head = ""  # "head" or "title" inside of these
        ends: dict[int, int] | None = None
        while token := _TOKEN.search(html, at):
            between = html[at : token.start()]
            at = token.end()
            if head == "head" and between.strip():
                head = ""  # text starts the body
            if not head:
                buffer.append(between)
            tag = token["tag"]
            if tag is None:
                if token["skip"]:
                    buffer.append(" ")
                continue
            tag = tag.lower()
            if tag in _SKIPPED and not token["close"]:
                ends = _skipped_ends(html) if ends is None else ends
                if token.start() in ends:
                    at = ends[token.start()]
                    buffer.append(" ")
                    if head == "head" and tag not in _HEAD:
                        head = ""
                    continue
            if tag == "head" and not token["close"]:
                flush()
                head = "head"
                continue
            if head:
                if tag == "title":
                    head = "head" if token["close"] else "title"
                    continue
                if head == "title" and tag not in ("head", "body"):
                    continue
                if tag not in ("head", "body", "html", "br") if token["close"] else tag in _HEAD:
                    continue
                # The end tag is optional: what can only stand in a body ends the head.
                head = ""
            if tag == "br":
                buffer.append(" ")
                continue
            if tag in _VOID:
                if tag == "hr":
                    flush()
                continue
            if tag not in _BLOCKS and not any(t == tag for t, _ in stack[-8:]):
                marked = self._region(tag, token["attrs"], region())
                if token["close"] or marked == region():
                    continue
            if tag in _BLOCKS:
                flush()
            if token["close"]:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
                if depth >= 0:
                    if tag not in _BLOCKS:
                        flush()
                    del stack[depth:]
                    if tag in _BLOCKS and tag not in _LEAVES:
                        items.append((f"/{tag}", []))
                continue
            if tag in _LEAVES and stack and stack[-1][0] == tag:
                stack.pop()
            elif tag in _BLOCKS and stack and stack[-1][0] == "p":
                stack.pop()
            inside = self._region(tag, token["attrs"], region())
            if tag not in _BLOCKS:
                flush()
            stack.append((tag, inside))
            if tag in _BLOCKS and tag not in _LEAVES:
                items.append((f"{tag}.{inside}", []))
        if head != "title":
            buffer.append(html[at:])
        flush()
        self.key, self.slots = _folded(items)

    @staticmethod
    def _region(tag: str, attributes: str, outer: str) -> str:
        """The region inside an element, given that around it."""
        if outer == BOILER:
            return BOILER
        marks: set[str] = set()
        contents: set[str] = set()
        role = ""
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'").lower()
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    return BOILER
                if name == "role":
                    role = value
                    continue
                for token in value.split():
                    # A mark is a whole name: no-comments and with-sidebar are none.
                    words = set(_WORD.findall(token))
                    if words <= _COMPOUND:
                        marks |= words & _MARKED
                    if not words & _MARKED:
                        contents |= words & _CONTENT
        heading = tag == "header" and outer in (ARTICLE, MAIN)
        if (tag in _BOILERPLATE and tag != "form" or tag == "header" or role in _ROLES) and (
            not heading
        ):
            return BOILER
        if tag == "article" and not marks & _NESTED and outer != COMMENTS:
            return ARTICLE
        if (tag == "main" or role == "main") and outer != COMMENTS:
            return outer if outer == ARTICLE else MAIN
        if outer == COMMENTS or marks & _NESTED and tag not in ("body", "html", "main"):
            return COMMENTS
        if outer in (OTHER, FORM, SUSPECT) and contents:
            return CONTENT
        marked = marks and tag not in ("body", "html") and not heading
        if outer in (ARTICLE, MAIN, CONTENT):
            # There is no doubt here: what is around it is the text.
            return BOILER if tag == "form" or marked else outer
        if marked:
            return SUSPECT
        return FORM if tag == "form" and outer == OTHER else outer


def _folded(items: list[tuple]) -> tuple[tuple, list[list[int]]]:
    """Items with every run of equal neighbouring groups as one repeated group."""
    width = 1
    while width <= min(_WIDEST, len(items) // 2):
        out: list[tuple] = []
        at, found = 0, False
        while at < len(items):
            group = [key for key, _ in items[at : at + width]]
            end = at + width
            repeated = width == 1 and group[0][:1] == ("+",)
            while (
                len(group) == width
                and not repeated
                and [key for key, _ in items[end : end + width]] == group
            ):
                end += width
            if end > at + width:
                slots = [s for _, own in items[at : at + width] for s in own]
                merged = [list(s) for s in slots]
                for copy in range(at + width, end, width):
                    more = [s for _, own in items[copy : copy + width] for s in own]
                    for have, new in zip(merged, more, strict=True):
                        have.extend(new)
                out.append((("+", tuple(group)), merged))
                at, found = end, True
            else:
                out.append(items[at])
                at += 1
        items = out
        width = 1 if found and width > 1 else width + 1
    return tuple(key for key, _ in items), [s for _, own in items for s in own]


# -- wrappers ------------------------------------------------------------------------------


class Slot(str):
    """A slot that carries the least and greatest hash of its texts; it equals its name."""

    def __new__(cls, name: str, low: int, high: int):
        slot = super().__new__(cls, name)
        slot.low, slot.high = low, high
        return slot


def flat(expression: tuple) -> tuple:
    """Tags and slots of an expression in order, those of a group once."""
    out: list[str] = []
    for item in expression:
        out += flat(item[1]) if isinstance(item, tuple) else (item,)
    return tuple(out)


def leaves(expression: tuple) -> list[str]:
    """The slots of an expression in order."""
    return [item for item in flat(expression) if item[0] == "#"]


def _core(item) -> tuple:
    """What an item repeats or makes optional, as a sequence."""
    return item[1] if isinstance(item, tuple) else (item,)


def _codes(items: tuple, numbers: dict) -> np.ndarray:
    """By item, numbers of its core, of the start of a longer group, and of its only text.

    Items that have none get numbers below zero.
    """

    def number(key) -> int:
        return numbers.setdefault(key, len(numbers))

    out = np.full((3, len(items)), -1, np.int64)
    for i, item in enumerate(items):
        core = _core(item)
        out[0, i] = number(core)
        if isinstance(item, tuple) and len(core) > 1:
            out[1, i] = number((core[0], "group"))
        slot = core[0] if len(core) == 1 else None
        if isinstance(slot, Slot) and slot.low == slot.high:
            out[2, i] = number(slot.low)
    return out


def _weights(a: np.ndarray, b: np.ndarray, i: int, one: int, columns=slice(None)):
    """What matching item ``i`` of ``a`` with items of ``b`` is worth: ``one``, more for a text."""
    fits = (b[0, columns] == a[0, i]) | ((b[1, columns] == a[1, i]) & (a[1, i] >= 0))
    same = (b[2, columns] == a[2, i]) & (a[2, i] >= 0)
    return fits * (one + same)


def _last_row(a: np.ndarray, b: np.ndarray, one: int) -> np.ndarray:
    """The best worth of all of ``a`` with each start of ``b``, held row by row."""
    row = np.zeros(b.shape[1] + 1, np.int64)
    for i in range(a.shape[1]):
        best = np.maximum(row[1:], row[:-1] + _weights(a, b, i, one))
        row[1:] = np.maximum.accumulate(best)
    return row


def _pairs(left: tuple, right: tuple) -> list[tuple[int, int]]:
    """A longest common subsequence of items that fit, of these one with most equal texts.

    Items fit when their cores are equal or they are groups that start alike. Memory grows with
    the sum of the lengths: long sequences are halved where the best pairing passes.
    """
    numbers: dict = {}
    a, b = _codes(left, numbers), _codes(right, numbers)
    one = min(len(left), len(right)) + 1
    out: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        i, n, j, m = todo.pop()
        # Ends that agree in all respects need no search.
        while i < n and j < m and (a[:, i] == b[:, j]).all():
            out.append((i, j))
            i, j = i + 1, j + 1
        if i == n or j == m:
            continue
        if n - i > 1 and (n - i) * (m - j) > _TABLE:
            half = (i + n) // 2
            ahead = _last_row(a[:, i:half], b[:, j:m], one)
            behind = _last_row(a[:, half:n][:, ::-1], b[:, j:m][:, ::-1], one)[::-1]
            cut = j + int(np.argmax(ahead + behind))
            todo += [(i, half, j, cut), (half, n, cut, m)]
        else:
            out += [(i + x, j + y) for x, y in _table_pairs(a[:, i:n], b[:, j:m], one)]
    return sorted(out)


def _table_pairs(a: np.ndarray, b: np.ndarray, one: int) -> list[tuple[int, int]]:
    """The pairs of short sequences, read off a whole table."""
    n, m = a.shape[1], b.shape[1]
    best = np.zeros((n + 1, m + 1), np.int64)
    for i in range(n - 1, -1, -1):
        row = np.maximum(best[i + 1, 1:] + _weights(a, b, i, one), best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < n and j < m:
        weight = _weights(a, b, i, one, j)
        if weight and best[i, j] == best[i + 1, j + 1] + weight:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def _optional(items: tuple) -> tuple:
    """Each item by itself as an optional one, so that pages without the group fit as well."""
    return tuple(
        (("*" if x[0] == "+" else x[0]), x[1]) if isinstance(x, tuple) else ("?", (x,))
        for x in items
    )


def _both(left: str, right: str) -> str:
    """One tag or slot for two equal ones, with the texts of both."""
    slots = [x for x in (left, right) if isinstance(x, Slot)]
    if not slots:
        return left
    return Slot(str(left), min(x.low for x in slots), max(x.high for x in slots))


def aligned(left: tuple, right: tuple) -> tuple:
    """The expression that both expressions match; its slots carry the texts of both.

    Equal items stay, items of one side alone become optional, an item that the other side
    repeats becomes repeated. ``*`` is a group that is both optional and repeated.
    """
    out: list = []
    i = j = 0
    for a, b in [*_pairs(left, right), (len(left), len(right))]:
        for alone in (left[i:a], right[j:b]):
            out.extend(_optional(alone))
        if a < len(left):
            x, y = left[a], right[b]
            if not isinstance(x, tuple) and not isinstance(y, tuple):
                out.append(_both(x, y))
            else:
                kinds = {z[0] if isinstance(z, tuple) else "" for z in (x, y)}
                optional, repeated = kinds & {"?", "*"}, kinds & {"+", "*"}
                kind = "*" if optional and repeated else "?" if optional else "+"
                out.append((kind, aligned(_core(x), _core(y))))
        i, j = a + 1, b + 1
    return tuple(out)


def infer(expressions: list[tuple]) -> tuple:
    """The wrapper of expressions, aligned one after another, short ones first."""
    ordered = sorted(expressions, key=lambda e: (len(e), json.dumps(e)))
    wrapper = ordered[0]
    for expression in ordered[1:]:
        wrapper = aligned(wrapper, expression)
    return wrapper


def places(wrapper: tuple, expression: tuple) -> list[int]:
    """For each slot of ``expression`` in order, which slot of its host's wrapper it is.

    A wrapper has all items of the expressions it was inferred from in their order, so each
    slot has a place; -1 would stand for none.
    """
    whole, own = flat(wrapper), flat(expression)
    taken = {b: a for a, b in _pairs(whole, own)}
    number = np.cumsum([item[0] == "#" for item in whole]) - 1
    return [
        int(number[taken[b]]) if b in taken else -1 for b, item in enumerate(own) if item[0] == "#"
    ]


def kept_slots(expression: tuple, constant: dict[int, int], chars: dict[int, int]) -> list[int]:
    """The slots of ``expression`` that hold main text.

    ``constant``: its slots whose place in the host's wrapper holds one text on all pages, and on
    how many different ones (as far as that matters). ``chars``: by slot, the length of its text.

    Of articles, main and content containers the region with the most text that is not constant
    is taken, articles unless another has twice as much; a page without these has the rest of its
    text (that of a form if it has four times as much), else what is suspect.
    """
    regions = [slot[1] for slot in leaves(expression)]
    inside = (ARTICLE, MAIN, CONTENT)

    def varies(slot: int) -> bool:
        least = _CONSTANT_INSIDE if regions[slot] in inside else _CONSTANT_PAGES
        return constant.get(slot, 0) < least

    def of(region: str) -> list[int]:
        return [i for i, r in enumerate(regions) if r == region and varies(i)]

    def fullest(weights: dict[str, int]) -> list[int]:
        sizes = {r: w * sum(chars.get(i, 0) for i in of(r)) for r, w in weights.items()}
        return of(max(sizes, key=sizes.__getitem__))

    if slots := fullest({ARTICLE: 2, MAIN: 1, CONTENT: 1}):
        return slots
    # All of a region may be constant, such as a page that has copies only.
    for region in inside:
        if region in regions:
            return [i for i, r in enumerate(regions) if r == region]
    return fullest({OTHER: 4, FORM: 1}) or fullest({SUSPECT: 1, COMMENTS: 1})


def _with_texts(expression: tuple, texts: Iterator[tuple[int, int]]) -> tuple:
    """``expression`` with slots that carry the next of ``texts`` each."""
    return tuple(
        (x[0], _with_texts(x[1], texts))
        if isinstance(x, tuple)
        else Slot(x, *next(texts)) if x[0] == "#" else x
        for x in expression
    )


def _dumped(expression: tuple) -> str:
    def plain(x):
        if isinstance(x, Slot):
            return f"{x}|{x.low}|{x.high}"
        return [x[0], [plain(y) for y in x[1]]] if isinstance(x, tuple) else x

    return json.dumps([plain(x) for x in expression])


def _loaded(text: str) -> tuple:
    def item(x):
        if isinstance(x, list):
            return x[0], tuple(item(y) for y in x[1])
        if x[0] == "#" and "|" in x:
            name, low, high = x.split("|")
            return Slot(name, int(low), int(high))
        return x

    return tuple(item(x) for x in json.loads(text))


# -- jobs ----------------------------------------------------------------------------------


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _hash(texts: list[str]) -> np.ndarray:
    data, offsets = arrowtext.byte_rows(pa.array(texts, pa.string()))
    return arrowtext.span_hashes(data, offsets[:-1], offsets[1:]).view(np.int64)


def _content(page: Page, hashes: np.ndarray) -> int:
    """A hash of the page's blocks outside boilerplate, in order."""
    slots = zip(leaves(page.key), page.slots, strict=True)
    blocks = sorted(b for slot, own in slots if slot[1] != BOILER for b in own)
    digest = hashlib.blake2b(hashes[blocks].tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _different(pages: str) -> Column:
    """The least page hashes of a group, enough to tell whether there are _CONSTANT_INSIDE.

    Every batch of pages sends that many at most, so a group gathers eight bytes for some
    hundred pages.
    """
    hashes = F.array_sort(F.array_distinct(F.flatten(F.collect_set(pages))))
    return F.slice(hashes, 1, _CONSTANT_INSIDE).alias(pages)


def _shapes(pages: DataFrame) -> DataFrame:
    """(host, shape, slot, low, high, pages, chars): the least and greatest text hash of each slot.

    ``pages`` are hashes of different pages, so that copies of a page count once: the least
    few of them, as no more are asked for. Pages that differ only in boilerplate are the same. ``chars`` is the length of all texts of the slot.

    Each task first combines its own pages, so a host or an expression shared by many pages
    sends a few rows per task. A page without slots has the single slot -1.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "shape", "slot", "low", "high", "pages", "chars"]
        types = [pa.string(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.int64()]
        for batch in batches:
            seen: dict[tuple[str, str], list] = {}
            for url, html in zip(*(batch.column(c).to_pylist() for c in ("url", "html"))):
                page = Page(html or "")
                entry = seen.setdefault((host_of(url), json.dumps(page.key)), [set(), {}])
                hashes = _hash(page.blocks)
                entry[0].add(_content(page, hashes))
                for slot, blocks in enumerate(page.slots):
                    own = hashes[blocks]
                    low, high = int(own.min()), int(own.max())
                    chars = sum(len(page.blocks[b]) for b in blocks)
                    if slot in entry[1]:
                        have = entry[1][slot]
                        low, high = min(low, have[0]), max(high, have[1])
                        chars += have[2]
                    entry[1][slot] = (low, high, chars)
            rows = [
                (host, shape, slot, low, high, sorted(different)[:_CONSTANT_INSIDE], chars)
                for (host, shape), (different, slots) in seen.items()
                for slot, (low, high, chars) in (slots or {-1: (0, 0, 0)}).items()
            ]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return (
        pages.select("url", "html")
        .mapInArrow(
            task,
            "host string, shape string, slot long, low long, high long, pages array<long>, "
            "chars long",
        )
        .groupBy("host", "shape", "slot")
        .agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            _different("pages"),
            F.sum("chars").alias("chars"),
        )
    )


def _by_shape(shapes: DataFrame) -> DataFrame:
    """(host, shape, marked, pages, chars): each expression, and with the texts of its slots."""
    texts = F.sort_array(F.collect_list(F.struct("slot", "low", "high")))
    grouped = shapes.filter("slot >= 0").groupBy("host", "shape").agg(
        texts.alias("texts"),
        F.first("pages").alias("pages"),
        F.map_from_entries(F.collect_list(F.struct("slot", "chars"))).alias("chars"),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("shape").to_pylist(), batch.column("texts").to_pylist())
            marked = [
                _dumped(_with_texts(_loaded(s), ((x["low"], x["high"]) for x in t)))
                for s, t in rows
            ]
            columns = [batch.column("host"), batch.column("shape"), pa.array(marked, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("pages"), batch.column("chars")],
                ["host", "shape", "marked", "pages", "chars"],
            )

    return grouped.mapInArrow(
        task,
        "host string, shape string, marked string, pages array<long>, chars map<long, long>",
    )


def _merged(groups: DataFrame, keys: list[str]) -> DataFrame:
    """One wrapper per group of expressions."""

    def task(rows: pa.Table) -> pa.Table:
        found = infer([_loaded(x) for x in rows.column("wrapper").to_pylist()])
        return pa.table({"host": rows.column("host")[:1], "wrapper": [_dumped(found)]})

    return groups.groupBy(*keys).applyInArrow(task, "host string, wrapper string")


def _dealt(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """``parts`` in as many groups per host as keep these small whatever the host's ``n`` is."""
    groups = F.ceil(F.col("n") / _MERGED)
    return parts.join(counts, "host").withColumn(
        "salt", F.pmod(F.xxhash64("wrapper"), groups)
    )


def wrappers(shapes: DataFrame) -> DataFrame:
    """(host, wrapper): expressions, then partial wrappers, merged in rounds of small groups."""
    parts = shapes.select("host", F.col("marked").alias("wrapper"))
    while True:
        counts = parts.groupBy("host").agg(F.count("*").alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= 1:
            return parts
        merged = _merged(_dealt(parts, counts), ["host", "salt"])
        # Equal ones would stay together in every round.
        parts = scratch.written(merged.distinct(), "wrappers")


def _placed(shapes: DataFrame) -> DataFrame:
    """(host, shape, slot, place, low, high, pages): the slots of expressions in the wrapper."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in ("row", "slot", "place", "low", "high")}
            whole, wrapper = None, ()
            pairs = zip(batch.column("wrapper").to_pylist(), batch.column("marked").to_pylist())
            for number, (text, marked) in enumerate(pairs):
                if text != whole:
                    whole, wrapper = text, _loaded(text)
                expression = _loaded(marked)
                for slot, place in enumerate(places(wrapper, expression)):
                    for name, value in (("row", number), ("slot", slot), ("place", place)):
                        rows[name].append(value)
                rows["low"] += [slot.low for slot in leaves(expression)]
                rows["high"] += [slot.high for slot in leaves(expression)]
            at = pa.array(rows.pop("row"), pa.int64())
            shared = {n: batch.column(n).take(at) for n in ("host", "shape", "pages")}
            own = {n: pa.array(v, pa.int64()) for n, v in rows.items()}
            yield pa.RecordBatch.from_pydict({**shared, **own})

    # Many expressions may share a host: deal them out, and repeat the wrappers.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("shape"), F.lit(_SALTS)).cast("int")
    return (
        shapes.withColumn("salt", salt)
        .join(wrappers(shapes).select("*", salts), ["host", "salt"])
        .select("host", "shape", "marked", "pages", "wrapper")
        .mapInArrow(
            task,
            "host string, shape string, pages array<long>, slot long, place long, low long, "
            "high long",
        )
    )


def _decisions(shapes: DataFrame) -> DataFrame:
    """(host, shape_id, keep): the slots with main text of each expression."""
    by_shape = scratch.written(_by_shape(shapes), "shapes")
    placed = scratch.written(_placed(by_shape.drop("chars")), "places")
    in_place = ["host", "place"]
    same = (
        placed.filter("place >= 0")
        .groupBy(*in_place)
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("low = high")
    )
    constant = (
        placed.select(*in_place, F.explode("pages").alias("page"))
        .distinct()
        .groupBy(*in_place)
        .agg(F.count("*").alias("different"))
        .filter(F.col("different") >= _CONSTANT_PAGES)
        .join(same.select(*in_place), in_place)
    )
    marked = F.when(F.col("different") > 0, F.struct("slot", "different"))
    judged = (
        placed.join(constant, in_place, "left")
        .groupBy("host", "shape")
        .agg(F.map_from_entries(F.collect_list(marked)).alias("constant"))
        .join(by_shape.select("host", "shape", "chars"), ["host", "shape"])
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shape", "constant", "chars"))
            keep = [kept_slots(_loaded(s), dict(c), dict(n)) for s, c, n in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    pa.array(_hash(batch.column("shape").to_pylist())),
                    pa.array(keep, pa.list_(pa.int32())),
                ],
                ["host", "shape_id", "keep"],
            )

    return judged.mapInArrow(task, "host string, shape_id long, keep array<int>")


def _parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, shape_id, blocks, slots): all text blocks and their slots."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                urls = batch.column("url").to_pylist()
                pages_ = [Page(h or "") for h in batch.column("html").to_pylist()]
                slots = []
                for page in pages_:
                    own = np.zeros(len(page.blocks), np.int32)
                    for slot, blocks in enumerate(page.slots):
                        own[blocks] = slot
                    slots.append(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id"),
                        batch.column("url"),
                        pa.array([host_of(u) for u in urls], pa.string()),
                        pa.array(_hash([json.dumps(p.key) for p in pages_])),
                        pa.array([p.blocks for p in pages_], pa.list_(pa.string())),
                        pa.array(slots, pa.list_(pa.int32())),
                    ],
                    ["page_id", "url", "host", "shape_id", "blocks", "slots"],
                )

    return pages.mapInArrow(
        task,
        "page_id long, url string, host string, shape_id long, blocks array<string>, "
        "slots array<int>",
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    The text is the blocks of the main text in page order, joined by a line end; white space
    within a block is one blank. A text that never changes over three different pages of a host
    goes (ten inside an article or the like), but only where it has a slot of its own: in a
    repeated group it stays. The text is empty for null and empty pages and for those without
    main text. Rows without URL share one wrapper. Repeated rows each give a row; an empty table
    gives none; other columns are ignored.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    # Many pages share a host and an expression: deal them out, and repeat the few decisions.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    decisions = _decisions(_shapes(pages)).select("*", salts)
    salt = F.pmod(F.xxhash64("page_id", "url", F.size("blocks")), F.lit(_SALTS)).cast("int")
    joined = _parsed(pages).withColumn("salt", salt).join(
        decisions, ["host", "shape_id", "salt"], "left"
    )
    kept = F.filter(
        F.transform(
            F.arrays_zip("blocks", "slots"),
            lambda x: F.when(F.array_contains("keep", x["slots"]), x["blocks"]),
        ),
        lambda block: block.isNotNull(),
    )
    text = F.coalesce(F.array_join(kept, "\n"), F.lit(""))
    return joined.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
