"""Reproducible random order: an md5 of seed and id is the same in every engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_key(seed: int, *ids: str | Column) -> Column:
    """32 hex digits that order rows at random for this seed."""
    parts = [F.col(c) if isinstance(c, str) else c for c in ids]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def key_bucket(key: Column, digits: int = 4) -> Column:
    """The leading hex digits as a number: equal-sized, order-preserving slices of the keys."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")
