"""Vectors as numpy blocks: which rows count as vectors, and runs of rows with one key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows(table: DataFrame) -> DataFrame:
    """vec_id and embedding alone; components of other types than float become double."""
    kind = table.schema["embedding"].dataType
    exact = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    embedding = F.col("embedding") if exact else F.col("embedding").cast("array<double>")
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"))


def _is_vector() -> Column:
    def finite(x: Column) -> Column:
        return F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False))

    found = (
        F.col("vec_id").isNotNull()
        & F.forall("embedding", finite)
        & F.exists("embedding", lambda x: x != 0)
    )
    return F.coalesce(found, F.lit(False))


def usable(table: DataFrame) -> DataFrame:
    """The rows with an id and a vector of finite components that are not all zero."""
    return table.filter(_is_vector())


def unusable(table: DataFrame) -> DataFrame:
    """All other rows."""
    return table.filter(~_is_vector())


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are equally long, one vector per row."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def equal_runs(batch: pa.RecordBatch, keys: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of a sorted batch that agree in ``keys``, of at most ``most`` rows."""
    size = len(batch)
    change = np.zeros(size + 1, bool)
    change[[0, size]] = True
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        change[1:size] |= values[1:] != values[:-1]
    edges = np.flatnonzero(change)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        for c in range(a, b, most):
            yield c, min(c + most, b)


def dtype(table: DataFrame) -> str:
    """The numpy type of the components of ``rows(table)``."""
    kind = table.schema["embedding"].dataType.elementType
    return "<f4" if isinstance(kind, T.FloatType) else "<f8"
