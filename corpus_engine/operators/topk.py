"""Top-k, shares and dense indexes that do not funnel a table through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.session import settled


def top_n_per_group(
    df: DataFrame, by: str | Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows per group with their 1-based rank.

    Written as ``row_number() <= n`` so that Spark limits each group before the shuffle as well:
    a group that holds a third of the table sends at most ``n`` rows per task.
    """
    groups = [by] if isinstance(by, str) else list(by)
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def signed_extremes(
    df: DataFrame, by: str, value: str, tie: str, n: int = 10
) -> DataFrame:
    """The ``n`` largest and ``n`` smallest values per group, marked in ``side``: ``by, side, rank, tie, value``.

    One pass: a group's values become one array, from which both ends are cut. For groups that fit in a row, as
    the terms of a document do.
    """
    listed = F.collect_list(F.struct(F.col(value).alias("value"), F.col(tie).alias("tie")))
    down = F.array_sort(F.transform("_all", lambda e: F.struct((-e["value"]).alias("back"), e["tie"].alias("tie"))))
    up = F.array_sort("_all")

    def side(name: str, ranked: Column, sign: int, field: str) -> Column:
        return F.transform(
            F.slice(ranked, 1, n),
            lambda e, k: F.struct(F.lit(name).alias("side"), (k + 1).alias("rank"), e["tie"].alias(tie), (sign * e[field]).alias(value)),
        )

    both = F.concat(side("top", down, -1, "back"), side("bottom", up, 1, "value"))
    return df.groupBy(by).agg(listed.alias("_all")).select(by, F.inline(both))


def with_share(df: DataFrame, column: str, name: str = "share", scale: float = 1.0) -> DataFrame:
    """Add each row's part of the column total. The total is a scalar subquery, not a window."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(name, F.lit(scale) * F.col(column) / total)


def take_largest(df: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    """Exactly the ``k`` rows with the largest positive ``value`` (ties by ``tie``), for large ``k``.

    A plain sort-and-limit brings ``k`` rows *per partition* to the last task. Here a histogram of
    the values, eight classes per power of two, gives the class in which the k-th value lies, and
    only rows of that class and above, little more than ``k``, reach the final top-k.
    """
    graded = df.withColumn("_grade", F.floor(F.log2(value) * 8).cast("int"))
    steps = graded.groupBy("_grade").agg(F.count(F.lit(1)).alias("_n"))
    # at most 8 x 63 grades: one small task
    above = Window.orderBy(F.desc("_grade")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        steps.withColumn("_upto", F.sum("_n").over(above))
        .filter(F.col("_upto") >= k)
        .agg(F.max("_grade"))
        .scalar()
    )
    return (
        graded.filter(F.col("_grade") >= F.coalesce(cut, F.lit(-(2**31))))
        .drop("_grade")
        .orderBy(F.desc(value), tie)
        .limit(k)
    )


def with_sorted_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the 0-based position (bigint) in ascending order of a unique column.

    The table is dealt into ranges of ``column`` and sorted inside them; a row's position is its place in its
    range after the rows of all earlier ranges. Ranges are drawn from the values themselves, so no beginning
    that many of them share makes one too long. Places are written with the rows before they are counted.
    """
    ranged = settled(df, "to-index").repartitionByRange(column).sortWithinPartitions(column)
    # the low 33 bits count the rows of a task
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = settled(ranged.withColumns({"_range": F.spark_partition_id(), "_place": place}), "indexed")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    return (
        placed.join(range_offsets(sizes), "_range")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_range", "_place", "_offset")
    )


def range_offsets(sizes: DataFrame) -> DataFrame:
    """``(_range, _offset)``: rows of all earlier ranges, from ``(_range, _n)``; one row per range."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_offset"))
