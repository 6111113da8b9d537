"""Language identification by cross-parsing entropy over suffix automata.

Per language, the automaton of all substrings of a labelled sample is built. A text is parsed
greedily into the longest phrases that occur in a sample; a language that needs few phrases
knows the text well. Phrase counts times the bits that a phrase costs, per letter, are an
estimate of the cross entropy, and the language with the least wins.

Parsing runs in lanes: all texts of a chunk, cut into blocks of a fixed number of letters,
advance together through one table of transitions, by one letter of every block and language
per step.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolake.llm import arrowtext, pretoken

#: Letters sampled per language, the bound of what is collected and broadcast.
SAMPLE_LETTERS = 40_000
#: Different labelled texts per language that the sample is taken from, and how much of a text
#: is taken: a few of them make up the sample, so that no single text decides.
SAMPLE_TEXTS, SAMPLE_TEXT_CHARS = 200, 8_000
#: Symbols for letters, which bound the width of the table. When the samples have more letters,
#: the most common keep a symbol each and the others are spelled with DIGITS symbols of these.
#: Letters in no sample count as one symbol that no sample has.
ALPHABET, DIGITS = 62, 32
#: Letters per block. Phrases end with their block, the same for a text wherever it is parsed.
BLOCK = 1024
#: States placed in the table of transitions at a time.
_STATES = 4096

UNDETERMINED = "und"
_GAP, _RARE = 0, 1


@dataclass(frozen=True)
class Model:
    """Languages in alphabetical order and the table that parses for all of them at once."""

    languages: list[str]
    letters: str
    bits: np.ndarray  # of a phrase, by language
    roots: np.ndarray
    table: np.ndarray  # 4 * (place in the table of the next state) + phrases that end here
    spelled: str = ""  # letters of more than one symbol

    @property
    def width(self) -> int:
        return len(self.letters) + 2 + (DIGITS if self.spelled else 0)

    def symbols(self) -> np.ndarray:
        """The symbol of every code point, or up to four, the first in the lowest byte."""
        table = np.where(pretoken.classes() == pretoken.LETTER, _RARE, _GAP)
        table = table.astype(np.uint32 if self.spelled else np.uint8)
        codes = list(range(2, len(self.letters) + 2))
        digits = 1
        while DIGITS**digits < len(self.spelled):
            digits += 1
        for i in range(len(self.spelled)):
            places = [i // DIGITS**d % DIGITS for d in range(digits)]
            codes.append(sum((len(self.letters) + 2 + x) << 8 * d for d, x in enumerate(places)))
        for letter, code in zip(self.letters + self.spelled, codes, strict=True):
            for form in {letter, letter.upper()}:
                if len(form) == 1:
                    table[ord(form)] = code
        return table


def automaton(sequence: np.ndarray, width: int) -> np.ndarray:
    """Transitions (state, symbol) of the suffix automaton of a sequence; -1 where none."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in sequence.tolist():
        state = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = step[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                twin = len(step)
                step.append(dict(step[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and step[at].get(symbol) == target:
                    step[at][symbol] = twin
                    at = link[at]
                link[target] = link[state] = twin
        last = state
    table = np.full((len(step), width), -1, np.int32)
    for state, steps in enumerate(step):
        for symbol, target in steps.items():
            table[state, symbol] = target
    return table


def _squeezed(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with runs of gaps as one, and the new offsets of the rows."""
    keep = symbols != _GAP
    first = np.zeros(len(symbols) + 1, bool)
    first[bounds] = True
    keep[1:] |= (symbols[:-1] != _GAP) & ~first[1 : len(symbols)]
    places = np.concatenate([[0], np.cumsum(keep)])
    return symbols[keep], places[bounds]


def _spelled(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single symbols instead of packed ones, and the new offsets of the rows."""
    if symbols.dtype == np.uint8:
        return symbols, bounds
    parts = np.ascontiguousarray(symbols, dtype="<u4").view(np.uint8).reshape(-1, 4)
    keep = parts != 0
    keep[:, 0] = True  # a gap is zero
    places = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])
    return parts[keep], places[bounds]


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", letters: int = SAMPLE_LETTERS
) -> Model | None:
    """A model of the languages of ``labelled``, or None without a labelled letter.

    Takes different texts in the order of a hash of text and label, up to ``letters`` letters per
    language: whole ones of at most SAMPLE_TEXT_CHARS characters, then the starts of longer ones.
    Equal texts of a language count once; rows without text or label are left out.
    """
    usable = (
        labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
        .select(
            F.substring("text", 1, SAMPLE_TEXT_CHARS).alias("text"),
            "lang",
            (F.length("text") > SAMPLE_TEXT_CHARS).alias("cut"),
        )
        .withColumn("print", F.xxhash64("text", "lang"))
    )
    # The hashes are ranked first, so that only the texts chosen are moved.
    order = Window.partitionBy("lang").orderBy("cut", "print")
    chosen = (
        usable.groupBy("lang", "print")
        .agg(F.min("cut").alias("cut"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= SAMPLE_TEXTS)
    )
    sample = (
        usable.join(F.broadcast(chosen), ["lang", "print", "cut"])
        .groupBy("lang", "n")
        .agg(F.min("text").alias("text"))
    )
    texts: dict[str, list[str]] = {}
    sizes: Counter = Counter()
    for row in sample.orderBy("lang", "n").toLocalIterator():
        if sizes[row["lang"]] < letters:
            texts.setdefault(row["lang"], []).append(row["text"])
            sizes[row["lang"]] += len(row["text"])
    counts: Counter = Counter()
    for parts in texts.values():
        for part in parts:
            counts.update(c for c in part.lower() if c.isalpha())
    if not counts:
        return None
    ordered = sorted(counts, key=lambda c: (-counts[c], c))
    single = ALPHABET if len(ordered) <= ALPHABET else ALPHABET - DIGITS
    known, spelled = ("".join(sorted(part)) for part in (ordered[:single], ordered[single:]))
    model = Model(sorted(texts), known, np.empty(0), np.empty(0), np.empty(0), spelled)
    symbols, width = model.symbols(), model.width
    sequences = []
    for language in model.languages:
        data = pa.array(texts[language], pa.string())
        _, points, bounds = arrowtext.code_points(*arrowtext.byte_rows(data))
        found = symbols[points]
        found[found == _RARE] = _GAP  # a form without a symbol of its own
        sequences.append(_spelled(*_squeezed(found, bounds))[0])
    bits = [np.log2(max(2, len(sequence))) for sequence in sequences]
    # One automaton at a time, into room for the most states that there can be: pages that are
    # never written take no memory.
    most = sum(2 * max(1, len(sequence)) for sequence in sequences) * width
    full = np.empty(most, np.int32 if 4 * most + 3 < 2**31 else np.int64)
    starts, size = [], 0
    for sequence in sequences:
        starts.append(size)
        size += _placed(automaton(sequence, width), full[size:], size)
    return Model(model.languages, known, np.array(bits), np.array(starts), full[:size], spelled)


def _placed(table: np.ndarray, room: np.ndarray, start: int) -> int:
    """Puts an automaton's table into ``room``, which starts at this place; how much it takes."""
    states, width = table.shape
    placed = room[: table.size].reshape(states, width)
    known_first = table[0] >= 0
    after = np.where(known_first, table[0], 0)  # where a phrase that starts here goes
    for first in range(0, states, _STATES):
        part = table[first : first + _STATES]
        missing = part < 0
        ended = missing & (np.arange(first, first + len(part)) > 0)[:, None]
        phrases = ended.astype(np.int64) + (missing & ~known_first)
        following = np.where(missing, after, part).astype(np.int64)
        placed[first : first + len(part)] = ((following * width + start) << 2) | phrases
    return table.size


def phrases(model: Model, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """By row and language, the number of phrases that the row is parsed into."""
    sizes = np.diff(bounds)
    blocks = -(-sizes // BLOCK)
    row = np.repeat(np.arange(len(sizes)), blocks)
    start = arrowtext.ragged(np.zeros(len(sizes), np.int64), blocks) * BLOCK
    size = np.minimum(BLOCK, sizes[row] - start)
    start += bounds[row]
    order = np.argsort(-size, kind="stable")
    row, start, size = row[order], start[order], size[order]
    lanes, count = len(row), len(model.languages)
    found = np.zeros((count, lanes), np.int64)
    if not lanes:
        return np.zeros((len(sizes), count), np.int64)
    roots = model.roots[:, None]
    state = np.repeat(roots, lanes, axis=1).astype(model.table.dtype)
    active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    ending = np.zeros((count, lanes), np.int32)
    at = np.empty_like(state)
    for t, m in enumerate(active.tolist()):
        np.add(state[:, :m], symbols[start[:m] + t], out=at[:, :m])
        taken = model.table[at[:, :m]]
        ending[:, :m] += taken & 3
        np.right_shift(taken, 2, out=state[:, :m])
    found += ending
    found += state != roots
    sums = np.zeros((len(sizes), count), np.int64)
    np.add.at(sums, row, found.T)
    return sums


def _results(model: Model | None, table: np.ndarray, column: pa.Array) -> Iterator[tuple]:
    """(language, score, bits per letter) arrays of consecutive ranges of rows."""
    data, offsets = arrowtext.byte_rows(column)
    for first, last in arrowtext.row_spans(offsets, 2 * arrowtext.CHUNK_BYTES):
        _, points, bounds = arrowtext.code_points(data, offsets[first : last + 1])
        rows = last - first
        if model is None:
            yield [UNDETERMINED] * rows, np.zeros(rows), np.zeros(rows)
            continue
        symbols, at = _squeezed(table[points], bounds)
        lettered = np.concatenate([[0], np.cumsum(symbols != _GAP)])
        letters = lettered[at[1:]] - lettered[at[:-1]]
        parsed = phrases(model, *_spelled(symbols, at))
        cost = parsed * model.bits / np.maximum(1, np.diff(at))[:, None]
        best = cost.argmin(axis=1)
        least = cost[np.arange(rows), best]
        others = cost.copy()
        others[np.arange(rows), best] = np.inf
        second = others.min(axis=1, initial=np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(np.isinf(second), 1.0, second / (second + least))
        known = letters > 0
        names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        yield names, np.where(known, score, 0.0), np.where(known, least, 0.0)


def identify(
    rows: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``rows`` with lang_pred, score and bits_per_letter of every whole text.

    ``lang_pred`` is a language of the model, or ``und`` (score 0) for a null text, one without
    a letter, or without a model; equal languages go to the first by name. ``score`` is 0.5
    when the two best languages fit equally and nears 1 the worse the second fits;
    ``bits_per_letter`` is the estimated entropy under the best. Each row is judged on its own, so
    repeated rows get the same result, and an empty table gives no rows. Columns that have the
    result's names are replaced, all others kept; ``keep`` narrows them.
    """
    names = ["lang_pred", "score", "bits_per_letter"]
    kept = [c for c in (keep or rows.columns) if c not in names]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns = list(dict.fromkeys([*kept, text]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = own.symbols() if own else np.empty(0, np.uint8)
        for batch in batches:
            at = 0
            for language, score, bits in _results(own, table, batch.column(text)):
                part = batch.slice(at, len(language)).select(kept)
                at += len(language)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(language, pa.string()), pa.array(score), pa.array(bits)],
                    [*kept, *names],
                )

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    results = ["lang_pred string", "score double", "bits_per_letter double"]
    return rows.select(*columns).mapInArrow(task, ", ".join([*schema, *results]))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether a hash of the id puts a row into this fold; false for a null id."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False)
    )
