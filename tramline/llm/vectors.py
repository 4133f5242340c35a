"""Embeddings as rows of whole numbers, and sums of matrices over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partial matrices that reach the driver at most, for each sum.
FAN_IN = 64


def whole_vectors(rows: DataFrame, vector_col: str, *keep: str, scale: int = 256) -> DataFrame:
    """(keep..., x): the rows whose vector is usable, with each entry as
    floor(scale * entry), a long.

    A vector that is null, empty or holds a null or an entry that is not finite is
    left out; so is one of another length than the most frequent (of equally
    frequent ones the longest), as it lies in another space.
    """
    finite = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))  # noqa: E731  NaN is above infinity
    entry = lambda c: F.floor(c.cast("double") * scale)
    vector = F.col(f"`{vector_col}`")
    good = rows.where(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite))
    good = good.select(*[F.col(f"`{c}`") for c in keep], F.transform(vector, entry).alias("x"))
    usual = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("x") == (usual["d"] if usual else 0))


def matrix_of(column: pa.Array) -> np.ndarray:
    """A matrix of longs of a column of equally long arrays."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``part`` over batches of the rows' ``x``; None without rows.

    Each task gives one matrix and ``FAN_IN`` tasks add those of all, in the order
    of the partitions, so the driver gets at most ``FAN_IN`` matrices and a sum is
    the same in every run over the same partitions.
    """
    def packed(key: int, place: int, m: np.ndarray) -> pa.RecordBatch:
        kind = f"{m.dtype.str}:{','.join(map(str, m.shape))}"
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([place], pa.int32()), pa.array([kind]), pa.array([m.tobytes()], pa.binary())], ["key", "place", "kind", "cells"])

    def opened(kind: str, cells: bytes) -> np.ndarray:
        dtype, _, shape = kind.partition(":")
        return np.frombuffer(cells, dtype).reshape([int(n) for n in shape.split(",")])

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                m = part(matrix_of(batch.column(0)))
                total = m if total is None else total + m
        if total is not None:
            place = TaskContext.get().partitionId()
            yield packed(place % FAN_IN, place, total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for k, kind, cells in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                if k != key and total is not None:
                    yield packed(key, 0, total)
                    total = None
                key, m = k, opened(kind, cells)
                total = m if total is None else total + m
        if total is not None:
            yield packed(key, 0, total)

    schema = "key int, place int, kind string, cells binary"
    each = rows.select("x").mapInArrow(of_task, schema)
    found = each.repartition(FAN_IN, "key").sortWithinPartitions("key", "place").mapInArrow(added, schema).collect()
    parts = [opened(r["kind"], bytes(r["cells"])) for r in sorted(found, key=lambda r: r["key"])]
    return sum(parts[1:], parts[0]) if parts else None
