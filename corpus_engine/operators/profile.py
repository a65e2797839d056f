"""Corpus profiling: counts, nulls, lengths, distributions, timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine.operators.quantiles import quantiles


def value_counts(df: DataFrame, column: str, normalize: bool = False, digits: int = 1) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out. ``normalize`` adds ``pct``."""
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    if normalize:
        total = counts.agg(F.sum("n")).scalar()
        counts = counts.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / total, digits))
    return counts.orderBy(F.desc("n"), column)


def publication_stats(df: DataFrame) -> DataFrame:
    """Articles and mean content length per outlet, biggest outlet first."""
    return (
        df.groupBy("publication")
        .agg(
            F.count(F.lit(1)).alias("article_count"),
            F.round(F.avg(F.length("content")), 0).alias("avg_content_chars"),
        )
        .orderBy(F.desc("article_count"), "publication")
    )


def null_profile(df: DataFrame, pct: bool = False, digits: int = 1) -> DataFrame:
    """Nulls per column from one pass; with ``pct`` only columns that have some, worst first."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    long = counted.unpivot("_rows", df.columns, "column", "nulls")
    if not pct:
        return long.select("column", "nulls")
    return (
        long.filter(F.col("nulls") > 0)
        .select("column", F.round(100.0 * F.col("nulls") / F.col("_rows"), digits).alias("null_pct"))
        .orderBy(F.desc("null_pct"), "column")
    )


def missing_by(df: DataFrame, column: str, by: str) -> DataFrame:
    """Rows without ``column`` per group, most first."""
    return (
        df.filter(F.col(column).isNull() & F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("missing"))
        .orderBy(F.desc("missing"), by)
    )


def histogram(
    df: DataFrame, value: Column, bins: int = 100, max_value: float | None = None
) -> DataFrame:
    """Equal-width histogram with every bin present; the last bin includes its upper edge.

    ``max_value`` clips the view: larger values are left out before the range is taken.
    """
    values = df.select(value.cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    if max_value is not None:
        values = values.filter(F.col("_x") <= max_value)
    # equal values meet on the map side; both passes below read this smaller table
    values = values.groupBy("_x").agg(F.count(F.lit(1)).alias("_n"))
    span = values.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    # a single value gets a range of one around it
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    filled = (
        values.withColumn(
            "bin", F.least(F.width_bucket("_x", lo, hi, F.lit(bins)), F.lit(bins)).cast("int")
        )
        .groupBy("bin")
        .agg(F.sum("_n").alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    grid = span.select(
        "lo", width.alias("width"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    return grid.join(filled, "bin", "left").select(
        "bin",
        F.round(F.col("lo") + (F.col("bin") - 1) * F.col("width"), 4).alias("lower"),
        F.round(F.col("lo") + F.col("bin") * F.col("width"), 4).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def boxplot_stats(df: DataFrame, by: str, value: Column, clip: float) -> DataFrame:
    """Box-plot figures per group over values up to ``clip``, ordered by the unclipped median.

    Rows are first counted per (group, value), so the exact percentiles hold one entry per distinct
    value and a dominating group is spread over all map tasks.
    """
    counts = (
        df.select(by, value.alias("x"))
        .filter(F.col("x").isNotNull())
        .groupBy(by, "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    shown = F.when(F.col("x") <= clip, F.col("x"))
    quartiles = counts.groupBy(by).agg(
        F.percentile("x", F.lit(0.5), F.col("n")).alias("median_all"),
        F.percentile(shown, F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]), F.col("n")).alias("q"),
    )
    quartiles = quartiles.select(
        by,
        "median_all",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    ).withColumns(
        {
            "lo": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
            "hi": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
        }
    )
    inside = F.col("x").between(F.col("lo"), F.col("hi"))
    return (
        counts.filter(F.col("x") <= clip)
        .join(quartiles, by, "right")
        .groupBy(by, "median_all", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
        .orderBy(F.desc("median_all"), by)
    )


def median_by(df: DataFrame, by: str, value: Column) -> DataFrame:
    """Median per group, largest first; groups without values last."""
    medians = quantiles(df, value, [0.5], by).select(F.col(by).alias("_by"), F.col("quantile").alias("median"))
    groups = df.select(by).distinct()
    return groups.join(medians, F.col(by).eqNullSafe(F.col("_by")), "left").select(by, "median").orderBy(F.desc("median"), by)


def _wide(found: DataFrame, names: Sequence[tuple[float, str]]) -> DataFrame:
    """One row with a column per share."""
    return found.agg(*[F.max(F.when(F.col("share") == share, F.col("quantile"))).alias(name) for share, name in names])


def length_summary(df: DataFrame, column: str = "content") -> DataFrame:
    """Shortest, median and longest text."""
    size = F.length(column)
    ends = df.agg(F.min(size).alias("min_len"), F.max(size).alias("max_len"))
    middle = _wide(quantiles(df, size, [0.5]), [(0.5, "median_len")])
    return ends.join(middle, F.lit(True)).select("min_len", "median_len", "max_len")


def describe_numeric(df: DataFrame, value: Column) -> DataFrame:
    """count, mean, sd (n-1), min, quartiles with linear interpolation, max."""
    sums = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    names = [(0.25, "q25"), (0.5, "q50"), (0.75, "q75")]
    quartiles = _wide(quantiles(df, value, [share for share, _ in names]), names)
    return sums.join(quartiles, F.lit(True)).select("count", "mean", "std", "min", "q25", "q50", "q75", "max")


DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy")


def parse_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits, as a date; null where none does."""
    return F.coalesce(
        value.try_cast("date"), *[F.try_to_date(value, f) for f in formats]
    )


def monthly_counts(df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Rows per calendar month, months without rows included, labelled by the month's last day."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        value = parse_date(value, formats)
    months = (
        df.select(F.trunc(value.cast("date"), "MM").alias("first_day"))
        .filter(F.col("first_day").isNotNull())
        .groupBy("first_day")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = months.agg(F.min("first_day").alias("a"), F.max("first_day").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("first_day")
    )
    return (
        grid.join(months, "first_day", "left")
        .select(F.last_day("first_day").alias("month_end"), F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("month_end")
    )


def corpus_summary(df: DataFrame, min_chars: int = 200) -> DataFrame:
    """One row: size, outlets, dates, median length, stubs, missing author and date."""
    size, date = F.length("content"), F.col("date")
    if isinstance(df.schema["date"].dataType, T.StringType):
        date = parse_date(date)
    date = date.cast("date")
    return df.agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count_distinct("publication").alias("publications"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.median(size).alias("median_length"),
        F.count_if(size < min_chars).alias("short_articles"),
        F.count_if(F.col("author").isNull()).alias("missing_author"),
        F.round(100.0 * F.count_if(F.col("author").isNull()) / F.count(F.lit(1)), 1).alias(
            "missing_author_pct"
        ),
        F.count_if(F.col("date").isNull()).alias("missing_date"),
        F.round(100.0 * F.count_if(F.col("date").isNull()) / F.count(F.lit(1)), 1).alias(
            "missing_date_pct"
        ),
    )


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each distinct key; nulls equal each other."""
    digests = [
        F.sha2(F.col(c), 256).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
        for c in columns
    ]
    groups = df.select(*digests).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Number of classes, biggest and smallest class and their ratio."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("classes"),
        F.max("n").alias("max_count"),
        F.min("n").alias("min_count"),
        F.round(F.max("n") / F.min("n"), 4).alias("imbalance_ratio"),
    )
