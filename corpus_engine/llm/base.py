"""What the operators of this subpackage share: their registry, tables, and text helpers."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under its function name."""

    def add(run: Query) -> Query:
        REGISTRY[run.__name__] = Entry(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ASIDE = "columns_aside"


def aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The columns that an operator works with and all others packed into one, and how to unpack them again, so
    that no name that the operator uses inside can be the name of a column it only carries."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    narrow = docs.select(*needed, F.struct(*others or [F.lit(0).alias("none")]).alias(ASIDE))

    def widen(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*(F.col(c) if c in needed else F.col(f"{ASIDE}.`{c}`").alias(c) for c in docs.columns), *more)

    return narrow, widen


def give_back_memory() -> None:
    """Return what a Python worker has freed to the machine: workers live on and take the next stage's tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``most`` bytes of one text column, so that working
    memory follows the bytes and not the row count. A longer single text is a run of its own."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0), dtype=np.int64)
        block = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
