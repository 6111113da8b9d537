"""Near-duplicate vectors by quantised tile products with rigorous error bounds.

Equal vectors are one class. The classes are dealt into blocks by a hash; every pair of blocks
is one tile. A unit vector x is held as int8 codes q and a scale s; the norm of x - s q is
known, so a product of codes gives the cosine up to a bound of its own for each pair. Pairs
whose interval lies above the threshold are links, those below are none, and only the pairs in
between are computed again from the original vectors in double precision.

A tile returns the number of links of each vector and edges that span its components, never
the pairs: at most two rows per vector, however many pairs are similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolake.llm import components, scratch, vectors

#: Vectors per block, on average; a tile holds two blocks.
BLOCK = 4096
#: Rows of a tile that are multiplied at a time.
_STRIPE = 256
#: More than the rounding errors of a product of codes, its scaling and a double cosine.
_ROUNDING = 1e-5
#: Codes of -127 .. 127: sums of so many products are exact in float32.
_EXACT = (1 << 24) // (127 * 127)


def quantise(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales, and the norms of what the codes miss."""
    wide = block.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    missed = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes.astype(np.int8), scale, missed


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Double precision cosines of corresponding rows."""
    x, y = left.astype(np.float64), right.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.abs(y).max(axis=1, keepdims=True)
    dots = np.einsum("ij,ij->i", x, y)
    return dots / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


class Block:
    """The vectors of one block and their codes."""

    def __init__(self, row: dict, side: str, kind: str):
        def read(name: str, dtype: str) -> np.ndarray:
            return np.frombuffer(row[f"{name}_{side}"], dtype)

        self.ids, self.prints = read("ids", "<i8"), read("prints", "<i8")
        self.copies = read("copies", "<i8")
        size = len(self.ids)
        self.vectors = read("vectors", kind).reshape(size, -1)
        self.codes = read("codes", "i1").reshape(size, -1).astype(np.float32)
        self.scale, self.missed = read("scale", "<f8"), read("missed", "<f8")


def tile_links(
    left: Block, right: Block, same: bool, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the similar vectors of a tile, stripe by stripe."""
    products_of = right.codes.T
    if left.codes.shape[1] > _EXACT:
        products_of = products_of.astype(np.float64)
    scales = right.scale.astype(products_of.dtype)
    most = right.missed.max()
    for at in range(0, len(left.ids), _STRIPE):
        rows = slice(at, at + _STRIPE)
        slack = left.missed[rows] + most + left.missed[rows] * most + _ROUNDING
        products = left.codes[rows].astype(products_of.dtype) @ products_of
        products *= scales
        lowest = ((threshold - slack) / left.scale[rows]).astype(products_of.dtype)
        i, j = np.nonzero(products >= lowest[:, None])
        cosine = products[i, j] * left.scale[rows][i]
        i += at
        if same:
            upper = j > i
            i, j, cosine = i[upper], j[upper], cosine[upper]
        x, y = left.missed[i], right.missed[j]
        bound = x + y + x * y + _ROUNDING
        linked = cosine >= threshold + bound
        unsure = np.flatnonzero(~linked & (cosine >= threshold - bound))
        for part in np.array_split(unsure, len(unsure) // 50_000 + 1):
            exact = cosines(left.vectors[i[part]], right.vectors[j[part]])
            linked[part] = exact >= threshold
        yield i[linked], j[linked]


def _tile(left: Block, right: Block, same: bool, threshold: float) -> pa.RecordBatch:
    """Links of each vector of a tile, and a vector of its component in the tile."""
    size = len(left.ids)
    links = np.zeros(size + (0 if same else len(right.ids)), np.int64)
    labels = np.arange(len(links))
    shift = 0 if same else size
    for i, j in tile_links(left, right, same, threshold):
        np.add.at(links, i, right.copies[j])
        np.add.at(links, j + shift, left.copies[i])
        components.merge_labels(labels, i, j + shift)
    used = np.flatnonzero(links)
    ids = left.ids if same else np.concatenate([left.ids, right.ids])
    prints = left.prints if same else np.concatenate([left.prints, right.prints])
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (ids[used], prints[used], links[used], ids[labels[used]])],
        ["class_id", "print", "links", "near"],
    )


def _blocks(classes: DataFrame, kind: str, blocks: int) -> DataFrame:
    """One row per block of classes: ids, copies, vectors and codes as arrays in binary."""
    columns = ["ids", "prints", "copies", "vectors", "codes", "scale", "missed"]

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        data = vectors.matrix(group.column("embedding").combine_chunks()).astype(kind)
        codes, scale, missed = quantise(data)
        arrays = [
            *(group.column(c).to_numpy().astype("<i8") for c in ("class_id", "print", "copies")),
            *(data, codes, scale.astype("<f8"), missed.astype("<f8")),
        ]
        return pa.table(
            {"dim": group.column("dim")[:1], "block": group.column("block")[:1]}
            | {c: pa.array([np.ascontiguousarray(a).tobytes()]) for c, a in zip(columns, arrays)}
        )

    block = F.pmod(F.col("print"), F.lit(blocks)).alias("block")
    return (
        classes.select("class_id", "print", "copies", "embedding", "dim", block)
        .groupBy("dim", "block")
        .applyInArrow(
            pack, "dim int, block long, " + ", ".join(f"{c} binary" for c in columns)
        )
    )


def links(table: DataFrame, threshold: float = 0.9, block: int = BLOCK) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept.

    n_links counts the other rows with a cosine of at least ``threshold``, component_id is the
    smallest vec_id reachable by links and ``kept`` tells whether it is the row's own. Vectors
    that are null, zero or hold null or non-finite components, and those of another length,
    link with nothing. A row without vec_id takes no part: no links, null component, not kept.
    An empty table gives no rows; other columns are ignored.
    """
    all_rows = vectors.rows(table)
    classes = (
        vectors.usable(all_rows)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
        .select(
            "class_id",
            "copies",
            F.xxhash64("embedding").alias("print"),
            F.size("embedding").alias("dim"),
            "embedding",
        )
    )
    classes = scratch.written(classes, "vectors")
    kind = vectors.dtype(all_rows)
    count = max(1, -(-classes.count() // block))
    packed = scratch.written(_blocks(classes, kind, count), "blocks")
    others = F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>")
    columns = [c for c in packed.columns if c not in ("dim", "block")]
    left = packed.select(
        "dim",
        F.col("block").alias("row"),
        F.explode(F.filter(others, lambda x: x >= F.col("block"))).alias("column"),
        *[F.col(c).alias(f"{c}_left") for c in columns],
    )
    right = packed.select(
        "dim",
        F.explode(F.filter(others, lambda x: x <= F.col("block"))).alias("row"),
        F.col("block").alias("column"),
        *[F.col(c).alias(f"{c}_right") for c in columns],
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                same = row["row"] == row["column"]
                pair = [Block(row, side, kind) for side in ("left", "right")]
                yield _tile(*pair, same, threshold)

    tiles = left.join(right, ["dim", "row", "column"]).mapInArrow(
        task, "class_id long, print long, links long, near long"
    )
    tiles = scratch.written(tiles, "tiles")
    edges = tiles.select(F.col("class_id").alias("a"), F.col("near").alias("b"))
    found = components.components(edges.filter("a <> b").distinct())
    counts = tiles.groupBy("class_id", "print").agg(F.sum("links").alias("links"))
    by_class = (
        classes.join(counts, ["class_id", "print"], "left")
        .join(found.withColumnRenamed("id", "class_id"), "class_id", "left")
        .select(
            "embedding",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
            F.coalesce("component_id", "class_id").alias("of_class"),
        )
    )
    rest = vectors.unusable(all_rows)
    out = (
        vectors.usable(all_rows).join(by_class, "embedding", "left")
        .select("vec_id", "links", "of_class")
        .unionByName(
            rest.select(
                "vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("of_class")
            )
        )
    )
    return out.select(
        "vec_id",
        F.col("links").alias("n_links"),
        F.col("of_class").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("of_class"), F.lit(False)).alias("kept"),
    )
