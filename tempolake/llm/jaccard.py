"""Similarity self-join of texts on the Jaccard similarity of their word n-grams.

The n-grams of each text are put in one global order, rare ones first. Two texts that are
similar enough share an n-gram among the first few of each (the prefix), so candidates come
from an equality join on prefix n-grams; lengths, positions and the split of the sets over hash
ranges rule most of them out before each remaining pair is verified, once, on the whole texts.

Texts with equal sets are one class. First come the components. Each of the first rounds takes,
for each prefix n-gram of a class, the first class that has it and the one before, and verifies
the class with those of them that it meets most often; the last round takes all candidate pairs
of classes whose components still differ. A pair within one component cannot change anything, so
a large group of near copies costs a few pairs per text.

Then come the links, all of which lie within a component. Its classes are dealt into blocks, and
each pair of blocks is a tile: the sets of a tile are compared there, each pair once, and only the
number of links of each class leaves it. So no pair is written, however many there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempolake.llm import arrowtext, components, scratch

#: Counters of the frequency sketch. Fixed: it is the size bound of what is broadcast (1 byte each).
SKETCH = 1 << 24
_SEGMENT = 1 << 16
#: Rounds of few pairs before the last round takes all, and partners per text in these.
LINEAR_ROUNDS, PARTNERS = 2, 3
#: Hash ranges whose counts bound the overlap of two sets.
_RANGES = 16
#: Classes of a component in one block, on average; a tile holds two blocks.
BLOCK = 256
#: Elements of a tile's sets that are multiplied at a time.
_COLUMNS = 4096
#: Buckets of document ids used to leave out texts in no pair: at most so many broadcast rows.
_ID_BUCKETS = 1 << 20

_U64 = np.uint64
_ONE = np.uint32(1)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_rows(
    data: np.ndarray, offsets: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each row, sorted within the row, and where each row's start."""
    raw = data[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    rows, size = len(bounds) - 1, len(raw)
    first = np.zeros(size + 1, bool)
    first[bounds] = True
    inside = ~_WHITE[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:size]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:size]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if not len(start):
        return np.empty(0, np.uint64), np.zeros(rows + 1, np.int64)
    word = arrowtext.span_hashes(_LOWER[raw], start, end)
    before = np.searchsorted(start, bounds)  # words before each row
    count = np.diff(before)
    grams = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    at = arrowtext.ragged(before[:-1], grams)
    row = np.repeat(np.arange(rows), grams)
    length = np.minimum(count, words)[row]
    hashed = length.astype(np.uint64)
    for k in range(words):
        factor = _U64((0x9E3779B97F4A7C15 * (2 * k + 3)) % (1 << 64) | 1)
        part = word[np.minimum(at + k, len(word) - 1)]
        hashed += np.where(k < length, arrowtext.mix(part + _U64(k)) * factor, _U64(0))
    hashed = arrowtext.mix(hashed)
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    row, hashed = row[new], hashed[new]
    return hashed, np.searchsorted(row, np.arange(rows + 1))


def _frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """How common the n-grams of each counter are over all texts, as a rounded logarithm.

    Each task counts the n-grams of its texts in a fixed array, whose segments are summed by
    segment; what the driver gets and broadcasts has the fixed size ``SKETCH``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            data, offsets = arrowtext.byte_rows(batch.column(0))
            for a, b in arrowtext.row_spans(offsets):
                grams, _ = shingle_rows(data, offsets[a : b + 1], words)
                np.add.at(counts, (grams & _U64(SKETCH - 1)).astype(np.int64), _ONE)
        for segment, part in enumerate(counts.reshape(-1, _SEGMENT)):
            if part.any():
                blob = zlib.compress(part.astype("<u4").tobytes(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment], pa.int32()), pa.array([blob], pa.binary())],
                    ["segment", "counts"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = sums.setdefault(segment, np.zeros(_SEGMENT, np.int64))
                total += np.frombuffer(zlib.decompress(blob), "<u4")
        for segment, total in sums.items():
            levels = np.minimum(255, np.round(6 * np.log2(total + 1))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([levels.tobytes()], pa.binary())],
                ["segment", "levels"],
            )

    summed = (
        texts.select("text")
        .mapInArrow(count, "segment int, counts binary")
        .repartition("segment")
        .mapInArrow(add, "segment int, levels binary")
    )
    levels = np.zeros((SKETCH // _SEGMENT, _SEGMENT), np.uint8)
    for row in summed.toLocalIterator():
        levels[row["segment"]] = np.frombuffer(row["levels"], np.uint8)
    return levels.ravel()


def prefix_size(grams: np.ndarray, percent: int) -> np.ndarray:
    """How many n-grams of each set can be the first that it shares with a similar one."""
    return grams - -(-percent * grams // 100) + (grams > 0)


def _fingerprints(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two hashes of each row's set, as two rows of whole numbers."""
    sums = np.zeros((2, len(grams) + 1), np.uint64)
    np.cumsum(arrowtext.mix(grams + _U64(1)), out=sums[0, 1:])
    np.cumsum(arrowtext.mix(grams ^ _U64(0x5851F42D4C957F2D)), out=sums[1, 1:])
    return (sums[:, at[1:]] - sums[:, at[:-1]]).view(np.int64)


def _prefixes(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """Per row: doc_id, n_shingles, two set fingerprints and the prefix in global order."""
    levels = documents.sparkSession.sparkContext.broadcast(_frequencies(documents, words))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = levels.value
        for batch in batches:
            data, offsets = arrowtext.byte_rows(batch.column("text"))
            sizes, prints, prefixes, ends = [], [], [], []
            for a, b in arrowtext.row_spans(offsets):
                grams, at = shingle_rows(data, offsets[a : b + 1], words)
                count = np.diff(at)
                row = np.repeat(np.arange(b - a), count)
                prints.append(_fingerprints(grams, at))
                level = common[(grams & _U64(SKETCH - 1)).astype(np.int64)]
                ordered = grams[np.lexsort((grams, level, row))]
                taken = prefix_size(count, percent)
                prefixes.append(ordered[arrowtext.ragged(at[:-1], taken)].view(np.int64))
                sizes.append(count)
                ends.append(taken)
            stops = np.concatenate([[0], np.cumsum(np.concatenate(ends or [[]]))]).astype(np.int32)
            flat = np.concatenate(prefixes or [np.empty(0, np.int64)])
            both = np.concatenate(prints or [np.empty((2, 0), np.int64)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.concatenate(sizes or [np.empty(0, np.int64)]), pa.int64()),
                    pa.array(both[0]),
                    pa.array(both[1]),
                    pa.ListArray.from_arrays(stops, pa.array(flat, pa.int64())),
                ],
                ["doc_id", "n_shingles", "print_a", "print_b", "prefix"],
            )

    return documents.mapInArrow(
        task,
        "doc_id long, n_shingles long, print_a long, print_b long, prefix array<long>",
    )


def _needed(percent: int, left: Column, right: Column) -> Column:
    """The least overlap of sets of these sizes that makes them similar, as a whole number."""
    return F.ceil(F.lit(percent) * (left + right) / F.lit(100 + percent) - F.lit(1e-9))


def _possible(percent: int, n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Length and positional filter, for a shared n-gram at these positions of the order."""
    rest = F.least(n - pos, m - at)
    return (
        (F.least(n, m) * 100 >= F.greatest(n, m) * percent)
        & (rest >= _needed(percent, n, m))
    )


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, text) of the rows with one of these ids, and of a few more."""
    bucket = F.pmod(F.xxhash64("id"), F.lit(_ID_BUCKETS)).alias("bucket")
    # At most _ID_BUCKETS rows, whatever the input: keeps other texts out of the shuffles.
    used = F.broadcast(ids.select(bucket).distinct())
    return (
        texts.select(F.col("doc_id").alias("id"), "text")
        .withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(_ID_BUCKETS)))
        .join(used, "bucket", "left_semi")
        .drop("bucket")
    )


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    kept = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), texts)
    sides = pairs.join(
        kept.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"
    ).join(kept.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def sets(array: pa.Array) -> list[np.ndarray]:
        data, offsets = arrowtext.byte_rows(array)
        found = []
        for first, last in arrowtext.row_spans(offsets):
            grams, at = shingle_rows(data, offsets[first : last + 1], words)
            found += np.split(grams, at[1:-1])
        return found

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                left, right = sets(batch.column("text_a")), sets(batch.column("text_b"))
                similar = np.zeros(len(batch), bool)
                for i, (x, y) in enumerate(zip(left, right, strict=True)):
                    needed = -(-percent * (len(x) + len(y)) // (100 + percent))
                    # Suffix filter: what two sets share lies in the same range of hashes.
                    edges = np.arange(1, _RANGES, dtype=np.uint64) << _U64(60)
                    split = np.diff(
                        [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]) for s in (x, y)]
                    )
                    if len(x) and len(y) and split.min(axis=0).sum() >= needed:
                        overlap = len(np.intersect1d(x, y, assume_unique=True))
                        similar[i] = overlap >= needed
                keep = pa.array(similar)
                yield batch.select(["a", "b"]).filter(keep)

    return sides.select("a", "b", "text_a", "text_b").mapInArrow(task, "a long, b long")


def _tile_links(
    sets: list[np.ndarray], copies: np.ndarray, block: np.ndarray, across: bool, percent: int
) -> np.ndarray:
    """For each set of a tile, the copies of the sets it links with.

    In a tile of two blocks only pairs ``across`` them count: those within have a tile of their
    own.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(count), sizes)
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    # Elements of one set alone are shared with none.
    row, number = (x[np.bincount(number)[number] > 1] for x in (row, number))
    _, number = np.unique(number, return_inverse=True)
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    shared = np.zeros((count, count), np.int64)
    columns = int(number.max(initial=-1)) + 1
    for first in range(0, columns, _COLUMNS):
        low, high = np.searchsorted(number, [first, first + _COLUMNS])
        held = np.zeros((count, min(_COLUMNS, columns - first)), np.float32)
        held[row[low:high], number[low:high] - first] = 1
        shared += (held @ held.T).astype(np.int64)
    similar = 100 * shared >= percent * (sizes[:, None] + sizes - shared)
    np.fill_diagonal(similar, False)
    if across:
        similar &= block[:, None] != block
    return similar @ copies


def _links(members: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """(print_a, print_b, n_shingles, links): the documents that each class links with.

    ``members``: print_a, print_b, n_shingles, class_id, copies, component_id and ``n``, the
    number of classes of the component.
    """
    key = ["print_a", "print_b", "n_shingles"]
    texts = _texts_of(members.select(F.col("class_id").alias("id")), documents)
    blocks = F.ceil(F.col("n") / BLOCK)
    dealt = members.withColumn("block", F.pmod(F.xxhash64(*key), blocks)).join(
        texts.withColumnRenamed("id", "class_id"), "class_id"
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    tiles = dealt.select("*", other).select(
        "component_id",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        *key,
        "copies",
        "text",
    )
    tile = ["component_id", "i", "j"]

    def counted(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        prints = [table.column(c).to_numpy() for c in key]
        sets, seen, rows = [], set(), []
        text = table.column("text").combine_chunks()
        data, offsets = arrowtext.byte_rows(text)
        for a, b in arrowtext.row_spans(offsets):
            grams, at = shingle_rows(data, offsets[a : b + 1], words)
            found = _fingerprints(grams, at)
            for k, own in enumerate(np.split(grams, at[1:-1])):
                name = tuple(int(p[a + k]) for p in prints)
                # A class is named by an id that other texts may have, too.
                if name not in seen and name == (int(found[0, k]), int(found[1, k]), len(own)):
                    seen.add(name)
                    sets.append(own)
                    rows.append(a + k)
        copies, block = (table.column(c).to_numpy()[rows] for c in ("copies", "block"))
        across = table.column("i")[0] != table.column("j")[0]
        links = np.empty(0, np.int64)
        if sets:
            links = _tile_links(sets, copies, block, across, percent)
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(p[rows][some]) for p in prints), pa.array(links[some])], [*key, "links"]
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in tile])
            edges = np.flatnonzero((np.diff(marks, axis=1) != 0).any(axis=0)) + 1
            edges = [0, *edges.tolist(), len(batch)] if len(batch) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = tuple(marks[:, a].tolist())
                if held and own != name:
                    yield counted(held)
                    held = []
                name = own
                held.append(batch.slice(a, b - a))
        if held:
            yield counted(held)

    found = (
        tiles.repartition(*tile)
        .sortWithinPartitions(*tile)
        .mapInArrow(task, "print_a long, print_b long, n_shingles long, links long")
    )
    return found.groupBy(*key).agg(F.sum("links").alias("links"))


def _few_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components, a few per class and at most two per posting.

    Each list of an n-gram is ordered by component, then size. A class may go with the head of
    the list and with the one before it; of these it takes those that it meets most often.
    """
    listed = Window.partitionBy("gram").orderBy("component_id", "n", "id")
    often = Window.partitionBy("id").orderBy(F.desc("met"), "partner")
    one = F.struct("id", "n", "pos", "component_id")
    return (
        lists.withColumn("head", F.first(one).over(listed))
        .withColumn("previous", F.lag(one).over(listed))
        .filter("previous is not null")
        .select("id", "n", "pos", "component_id", F.explode(F.array("head", "previous")).alias("o"))
        .filter(F.col("component_id") != F.col("o.component_id"))
        .filter(_possible(percent, F.col("n"), F.col("pos"), F.col("o.n"), F.col("o.pos")))
        .groupBy("id", F.col("o.id").alias("partner"))
        .agg(F.count("*").alias("met"))
        .withColumn("order", F.row_number().over(often))
        .filter(F.col("order") <= PARTNERS)
        .select(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b"))
        .distinct()
    )


def _edges(found: DataFrame) -> DataFrame:
    """Each id with its component, as links."""
    pairs = found.filter("id <> component_id")
    return pairs.select(F.col("id").alias("a"), F.col("component_id").alias("b"))


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """The postings of n-grams that still stand in more than one component."""
    labelled = shared.join(found, "id", "left").withColumn(
        "component_id", F.coalesce("component_id", "id")
    )
    group = labelled.groupBy("gram").agg(
        F.min("component_id").alias("low"), F.max("component_id").alias("high")
    )
    return labelled.join(group.filter("low < high"), "gram", "left_semi")


def join(
    documents: DataFrame, words: int = 5, percent: int = 80, links: bool = True
) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, n_links.

    Without ``links`` their numbers are neither computed nor returned.

    Two texts are linked when the Jaccard similarity of their sets of ``words``-grams is at
    least ``percent`` / 100. Words are separated by ASCII white space and A-Z are lower-cased.
    A text of fewer words has its whole sequence as the only element; without words the set is
    empty and links with nothing. component_id is the smallest doc_id reachable by links,
    n_links the number of other rows that the row links with. Rows that repeat a doc_id are
    compared each by its own text. A row without doc_id links with nothing, its component_id is
    null and its n_links 0. An empty table gives no rows; other columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    sets = scratch.written(_prefixes(documents, words, percent), "prefixes")
    key = ["print_a", "print_b", "n_shingles"]
    usable = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = scratch.written(
        usable.groupBy(*key).agg(
            F.min("doc_id").alias("class_id"), F.count("*").alias("copies")
        ),
        "classes",
    )
    chosen = usable.join(
        classes.select(*key, F.col("class_id").alias("doc_id")), [*key, "doc_id"], "left_semi"
    )
    postings = chosen.select(
        "doc_id", F.col("n_shingles").alias("n"), F.posexplode("prefix").alias("pos", "gram")
    )
    listed = Window.partitionBy("gram").orderBy("n", "doc_id")
    shared = scratch.written(
        postings.withColumn("before", F.lag("doc_id").over(listed))
        .withColumn("after", F.lead("doc_id").over(listed))
        .filter("before is not null or after is not null")
        .select("gram", F.col("doc_id").alias("id"), "n", "pos"),
        "shared",
    )
    # Linear rounds: few pairs per class, and the components that their links make.
    found = None
    lists = shared.withColumn("component_id", F.col("id"))
    tried: DataFrame | None = None
    for _ in range(LINEAR_ROUNDS):
        pairs = _few_pairs(lists, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = scratch.written(pairs, "candidates")
        tried = pairs if tried is None else tried.union(pairs)
        similar = _verified(pairs, documents, words, percent)
        if found is not None:
            similar = similar.union(_edges(found))
        found = scratch.written(components.components(similar), "found")
        lists = scratch.written(_apart(shared, found), "lists")

    # The last round: all remaining candidate pairs whose components differ.
    # Sizes of similar sets are in the same or in adjacent bands.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + 1e-9)
    right = lists.select(
        "gram",
        F.explode(F.array(band, band + 1, band - 1)).alias("band"),
        F.col("id").alias("b"),
        F.col("n").alias("m"),
        F.col("pos").alias("at"),
        F.col("component_id").alias("other_component"),
    )
    left = lists.select(
        "gram", band.alias("band"), F.col("id").alias("a"), "n", "pos", "component_id"
    )
    second = (
        left.join(right, ["gram", "band"])
        .filter(F.col("a") < F.col("b"))
        .filter("component_id <> other_component")
        .filter(_possible(percent, F.col("n"), F.col("pos"), F.col("m"), F.col("at")))
        .select("a", "b")
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    second = scratch.written(second, "candidates")
    more = _verified(second, documents, words, percent)
    final = components.components(_edges(found).union(more))
    of_class = scratch.written(
        classes.join(final.withColumnRenamed("id", "class_id"), "class_id", "left").withColumn(
            "component_id", F.coalesce("component_id", "class_id")
        ),
        "of_class",
    )
    numbers = []
    if links:
        sizes = of_class.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1")
        members = of_class.join(sizes, "component_id")
        of_class = of_class.join(_links(members, documents, words, percent), key, "left")
        numbers = [(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")]
    by_class = of_class.select(*key, F.col("component_id").alias("of_class"), *numbers)
    named = F.col("doc_id").isNotNull()
    rows = sets.drop("prefix")
    zero = [F.lit(0).cast("long").alias("n_links")] if links else []
    if links:
        numbers = [F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links")]
    # Rows without words, of which there may be many, have no class to look up.
    wordless = rows.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *zero
    )
    component = F.when(named, F.coalesce("of_class", "doc_id")).alias("component_id")
    return (
        rows.filter("n_shingles > 0")
        .join(by_class, key, "left")
        .select("doc_id", "n_shingles", component, *numbers)
        .union(wordless)
    )
