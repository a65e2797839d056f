"""Exact quantiles of a numeric column, for all rows or per group, by counting.

A number's bits, read as an integer, have the order of the numbers. A first pass counts rows by their
leading bits; the wanted positions fall into a few of those slices, whose rows are counted by the next
bits, and so on until what is left is short enough to be ranked. No buffer grows with the number of
different values: a pass keeps at most one count per slice and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.session import settled

SHIFTS = (44, 24, 8)  # bits that a pass leaves out; the sign and exponent are the leading twelve
RANKED_ROWS = 1_000_000  # rows that are ranked without a further pass


def ordered_bits(x: Column) -> Column:
    """The bits of a double as a bigint of the same order; negative numbers mirror positive ones.

    Powers of two are exact, so exponent and fraction come out of plain arithmetic.
    """
    a = F.abs(x)
    least = F.lit(2.0**-1022)  # below it numbers have no exponent of their own
    near = F.floor(F.log2(a)).cast("int")
    high = F.least(F.greatest(near, F.lit(-1022)), F.lit(1023))
    exponent = high + F.when(F.pow(F.lit(2.0), high) > a, -1).when((high < 1023) & (F.pow(F.lit(2.0), high + 1) <= a), 1).otherwise(0)
    fraction = ((a / F.pow(F.lit(2.0), exponent) - 1.0) * F.lit(2.0**52)).cast("bigint")
    small = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    size = F.when(a < least, small).when(a == float("inf"), F.lit(2047 << 52)).otherwise(
        (exponent + 1023).cast("bigint") * F.lit(1 << 52) + fraction
    )
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -size).otherwise(size)


def quantiles(df: DataFrame, value: Column, shares: Sequence[float], by: str | None = None) -> DataFrame:
    """``([by,] share, quantile)``: exact quantiles with linear interpolation, one row per share and group.

    Nulls do not count; a group without values has no rows. NaN counts as the largest number.
    """
    group = by or "_group"
    kept = F.col(by).alias(group) if by else F.lit(0).alias(group)
    x = value.cast("double")
    # several passes: over group and number, written once
    rows = settled(df.select(kept, x.alias("_x")).filter(F.col("_x").isNotNull()), "numbers")
    rows = rows.withColumn("_bits", ordered_bits(F.col("_x")))
    totals = settled(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")), "group-sizes")
    exact = F.col("share") * (F.col("_n") - 1)
    wanted = totals.select(group, "_n", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")).select(
        group, "share", exact.alias("_at"), F.explode(F.array_distinct(F.array(F.floor(exact), F.ceil(exact)))).alias("_place")
    )
    # a place counts from 0 within its slice
    wanted = settled(wanted.withColumn("_rest", F.col("_place")).withColumn("_slice", F.lit(None).cast("bigint")), "places")
    left = rows.withColumn("_slice", F.lit(None).cast("bigint"))
    for shift in SHIFTS:
        if left.count() <= RANKED_ROWS:
            break
        finer = left.withColumn("_finer", F.shiftright("_bits", shift))
        wanted = settled(_located(finer.groupBy(group, "_slice", "_finer").agg(F.count(F.lit(1)).alias("_c")), wanted, group, "_finer"), "places")
        open_ = wanted.select(F.col(group).alias("_g"), F.col("_slice").alias("_s")).distinct()
        hit = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_finer") == F.col("_s"))
        left = finer.drop("_slice").join(open_, hit).select(group, "_x", "_bits", F.col("_s").alias("_slice"))
    values = left.groupBy(group, "_slice", F.col("_bits").alias("_value")).agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_x"))
    found = _located(values, wanted, group, "_value", "_x")
    low, high = (F.max(F.when(F.col("_place") == side(F.col("_at")), F.col("_x"))) for side in (F.floor, F.ceil))
    out = found.groupBy(group, "share", "_at").agg(low.alias("_low"), high.alias("_high"))
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_at") - F.floor("_at"))
    told = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between)
    return out.select(*([group] if by else []), "share", told.alias("quantile"))


def _located(counts: DataFrame, wanted: DataFrame, group: str, finer: str, *carried: str) -> DataFrame:
    """The wanted places with the finer slice that each falls into, counted from that slice's beginning.

    ``counts`` has the rows ``_c`` of each finer slice of the slices that hold wanted places."""
    order = Window.partitionBy(group, "_slice").orderBy(finer)
    upto = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = counts.withColumn("_upto", upto).select(
        F.col(group).alias("_g"), F.col("_slice").alias("_s"), finer, "_c", "_upto", *carried
    )
    inside = (
        F.col(group).eqNullSafe(F.col("_g")) & F.col("_slice").eqNullSafe(F.col("_s"))
        & (F.col("_rest") < F.col("_upto")) & (F.col("_rest") >= F.col("_upto") - F.col("_c"))
    )
    return wanted.join(spans, inside).select(
        group, "share", "_at", "_place", (F.col("_rest") - F.col("_upto") + F.col("_c")).alias("_rest"), F.col(finer).alias("_slice"), *carried
    )
