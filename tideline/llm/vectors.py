"""Vectors of whole numbers, and the meeting of a stated set of questions with shards of vectors.

A vector null, or with a null or non-finite component, takes no part. Components are scaled and floored to whole
numbers; inner products are exact (components too large for that raise an error before any work is done). Vectors
of different lengths are compared as if the shorter one ended in zeros. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import stage

SHARD_ROWS = 65_536      # at most so many rows of a shard meet in one task ...
SHARD_BYTES = 2**25      # ... and at most so many bytes of components
LAST = np.iinfo(np.int64).max  # the place of a null id among equal scores


def complete(embedding: str) -> Column:
    """Is the vector there, with all components finite?"""
    return F.col(embedding).isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


@dataclass(frozen=True)
class Extent:
    rows: int
    dims: int
    shards: int


def extent(rows: DataFrame, scale: int) -> Extent:
    """Size of the table, and into how many shards it goes: as few as memory allows, but enough for all cores."""
    got = rows.agg(
        F.count("*"), F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()
    n, dims, largest = got[0], got[1] or 0, got[2] or 0.0
    if dims * (scale * largest + 1) ** 2 >= 2**53:
        raise ValueError(f"components up to {largest:g} are too large for exact scores at scale {scale}")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    fit = max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * max(dims, 1))))
    return Extent(n, dims, max(1, -(-n // fit), min(2 * cores, -(-n // 1024))))


def matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Whole-number components (held as doubles), one line for each vector, zeros beyond its end."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False)


def ids_back(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == LAST)


def meet(vectors: DataFrame, questions: DataFrame, shards: int, answer: Callable, schema: str) -> DataFrame:
    """Bring each shard's vectors and the questions put to it into one task, and answer them there.

    Both frames carry ``shard``. A task first gathers the vectors of its shard (bounded by the shard's size) and then
    reads questions batch by batch, so any number of them may be put to one shard. ``answer(vectors, batches)`` gets
    one table and an iterator of record batches.
    """
    same = [F.col(f.name) if f.name in questions.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in vectors.schema]
    more = [f for f in questions.schema if f.name not in vectors.columns]
    left = vectors.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in more], F.lit(0).alias("kind"))
    right = questions.select(*same, *[f.name for f in more], F.lit(1).alias("kind"))
    dealt = left.unionByName(right).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("kind")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def asked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds = batch.column("kind").to_numpy()
                cut = int(np.searchsorted(kinds, 1))
                if cut:
                    held.append(batch.slice(0, cut))
                if cut < len(kinds):
                    yield batch.slice(cut)

        questions_of = asked()
        first = next(questions_of, None)
        if first is None or not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()

        def rest() -> Iterator[pa.RecordBatch]:
            yield first
            yield from questions_of

        yield from answer(table, rest())

    return dealt.mapInArrow(task, schema)


def column(table: pa.Table, name: str) -> pa.Array:
    got = table.column(name)
    return got.combine_chunks() if got.num_chunks != 1 else got.chunk(0)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows with a number that tells repeated rows apart, written once so that it stays."""
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), name)


def usable(vectors: DataFrame, vec_id: str, embedding: str, *more: Column) -> DataFrame:
    if not isinstance(vectors.schema[embedding].dataType, T.ArrayType):
        raise TypeError(f"{embedding} is not an array")
    return vectors.where(complete(embedding)).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), *more)
