"""Data-quality rules: row contract, keys, table expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.functions.text import is_blank

Bounds = tuple[float | None, float | None]


def article_rules(min_content: int = 10) -> dict[str, tuple[Column, str]]:
    """The row contract: rule -> (violated when, message)."""
    return {
        "id_missing": (F.col("id").isNull(), "id must be an integer"),
        "title_blank": (is_blank(F.col("title")), "no title is given"),
        "publication_blank": (is_blank(F.col("publication")), "no outlet is named"),
        "content_short": (
            F.coalesce(F.length("content"), F.lit(0)) < min_content,
            "content too short",
        ),
    }


def validate_articles(df: DataFrame, min_content: int = 10) -> DataFrame:
    """One row ``(id, rule, message)`` per broken rule. Author and date may be null."""
    found = [
        F.when(broken, F.struct(F.lit(rule).alias("rule"), F.lit(message).alias("message")))
        for rule, (broken, message) in article_rules(min_content).items()
    ]
    return df.select("id", F.inline(F.array_compact(F.array(*found))))


def duplicate_keys(df: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """Keys that occur more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """Fail before a join would multiply rows."""
    found = duplicate_keys(df, key).limit(3).collect()
    if found:
        raise ValueError(f"keys occur more than once: {found}")
    return df


def expect(df: DataFrame, observed: Mapping[str, Column], bounds: Mapping[str, Bounds]) -> DataFrame:
    """Check aggregates against closed ranges: ``(check, observed, lo, hi, passed)``."""
    row = df.agg(*[c.cast("double").alias(name) for name, c in observed.items()])
    checks = []
    for name in observed:
        lo, hi = bounds[name]
        low, high = F.lit(lo).cast("double"), F.lit(hi).cast("double")
        value = F.col(f"`{name}`")
        ok = F.coalesce(value >= low, F.lit(lo is None)) & F.coalesce(value <= high, F.lit(hi is None))
        checks.append(
            F.struct(
                F.lit(name).alias("check"),
                value.alias("observed"),
                low.alias("lo"),
                high.alias("hi"),
                ok.alias("passed"),
            )
        )
    return row.select(F.inline(F.array(*checks)))


def assert_met(expectations: DataFrame) -> None:
    """Stop with the names of the checks that are not met; one row per check."""
    failed = [f"{r.check} is {r.observed}" for r in expectations.filter(~F.coalesce("passed", F.lit(False))).collect()]
    if failed:
        raise ValueError("expectations not met: " + ", ".join(sorted(failed)))


def expect_table(df: DataFrame, bounds: Mapping[str, Bounds] | None = None) -> DataFrame:
    """Article-table expectations from one pass; bounds default to the published corpus."""
    limits: dict[str, Bounds] = {
        "row_count": (100_000, 200_000),
        "null_title": (0, 0),
        "null_content": (0, 0),
        "duplicate_content": (0, 0),
        "median_length": (1_000, 10_000),
    }
    limits.update(bounds or {})
    digest = F.coalesce(F.sha2("content", 256), F.lit(""))
    observed = {
        "row_count": F.count(F.lit(1)),
        "null_title": F.count_if(F.col("title").isNull()),
        "null_content": F.count_if(F.col("content").isNull()),
        "duplicate_content": F.count(F.lit(1)) - F.count_distinct(digest),
        "median_length": F.median(F.length("content")),
    }
    return expect(df, observed, limits)


def expect_features(
    features: DataFrame,
    vocab: DataFrame,
    documents: DataFrame,
    bounds: Mapping[str, Bounds] | None = None,
) -> DataFrame:
    """Feature-matrix expectations: rows, columns, sparsity, range of the weights."""
    limits: dict[str, Bounds] = {
        "rows": (100_000, None),
        "features": (50_000, 50_000),
        "sparsity": (0.95, 1.0),
        "min_weight": (0.0, None),
        "max_weight": (None, 1.0),
    }
    limits.update(bounds or {})
    rows = documents.agg(F.count(F.lit(1))).scalar()
    columns = vocab.agg(F.count(F.lit(1))).scalar()
    cells = rows.cast("double") * columns
    observed = {
        "rows": F.coalesce(F.max(rows), rows),
        "features": F.coalesce(F.max(columns), columns),
        "sparsity": F.round(1 - F.try_divide(F.count(F.lit(1)), F.coalesce(F.max(cells), cells)), 6),
        "min_weight": F.round(F.min("tfidf"), 6),
        "max_weight": F.round(F.max("tfidf"), 6),
    }
    return expect(features, observed, limits)


def missing_values(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Expected values that never occur."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], f"{column} string")
    return wanted.join(df.select(column).distinct(), column, "left_anti")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail when a column is missing; otherwise the null count of each."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "nulls")


def is_subset(part: DataFrame, whole: DataFrame, column: str) -> DataFrame:
    """Values of ``part`` that ``whole`` lacks; empty when it is a subset."""
    return part.select(column).distinct().join(whole.select(column).distinct(), column, "left_anti")
