"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.session import settled

SLICES = 1 << 20


def per_class(rows: DataFrame, label: str, bound: int, name: str) -> DataFrame:
    """For each value of ``label`` up to ``bound`` rows, those whose ``doc_id`` has the smallest hash.

    A class's count first tells which slice of the hashes holds about twice the bound, so that only
    such rows are ranked, however large the class is. The result is written and bounded.
    """
    counts = settled(rows.groupBy(label).agg(F.count("*").alias("n")), f"{name}-counts")
    slice_of = F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))
    share = F.lit(float(SLICES)) * (2 * bound + 100) / F.col("n")
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    near = rows.join(F.broadcast(counts), label).where(slice_of < share).drop("n")
    ranked = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= bound)
    return settled(ranked.drop("at"), name)
