"""Cleaning: null drops, keep-first de-duplication, stub filter, text preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.functions import text as tx
from corpus_engine.functions.stopwords import ENGLISH
from corpus_engine.session import settled


def drop_missing(df: DataFrame, columns: Sequence[str] = ("content", "title")) -> DataFrame:
    """Rows with every listed column present. Author and date stay as they are, null or not."""
    return df.na.drop(subset=list(columns))


# Digests of repeated texts that are sent to every executor: at most this many, some 100 MB.
BROADCAST_DIGESTS = 1_000_000


def dedup_keep_first(
    df: DataFrame, key: str = "content", order: Sequence[str] = ("file_rank", "id")
) -> DataFrame:
    """One row per distinct ``key``: the first in ``order`` (then by a hash of the whole row).

    First pass: digest and order columns only, reduced per digest with map-side combine, so a text
    copied a billion times never meets in one task. The digests that occur more than once are written
    down with their first row's rank. Second pass: one join with that list decides every row; texts
    that it does not name occur once. While the list is small it is broadcast and the texts are not
    shuffled; beyond that they are shuffled by digest. Rows that agree in every column have the same rank;
    only where a first row has such twins, its rows are reduced to one in a further pass.
    Null keys count as equal, as in a data frame's duplicate drop.
    """
    keyed = df.withColumns(
        {
            "_digest": F.coalesce(F.sha2(F.col(key), 256), F.lit("")),
            "_rank": F.struct(
                *order, F.xxhash64(*[F.col(c) for c in df.columns if c != key]).alias("_row")
            ),
        }
    )
    ranked = keyed.groupBy("_digest", "_rank").agg(F.count(F.lit(1)).alias("_n"))
    repeated = settled(
        ranked.groupBy("_digest")
        .agg(F.sum("_n").alias("_all"), F.min(F.struct("_rank", "_n")).alias("_least"))
        .filter("_all > 1")
        .select("_digest", F.col("_least._rank").alias("_first"), (F.col("_least._n") > 1).alias("_twins")),
        "repeated",
    )
    listed, twins = repeated.agg(F.count(F.lit(1)), F.coalesce(F.max("_twins"), F.lit(False))).first()
    if listed <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    first = keyed.join(repeated, "_digest", "left").filter(F.col("_first").isNull() | (F.col("_first") == F.col("_rank")))
    if not twins:
        return first.select(df.columns)
    alone = first.filter(~F.coalesce("_twins", F.lit(False))).select(df.columns)
    return alone.unionByName(first.filter("_twins").dropDuplicates(["_digest"]).select(df.columns))


def clean(df: DataFrame, order: Sequence[str] = ("file_rank", "id")) -> DataFrame:
    """Drop rows without content or title, then repeated contents."""
    return dedup_keep_first(drop_missing(df), "content", order)


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows left and rows removed per cleaning stage, in one aggregate over the raw table."""
    has_content = F.col("content").isNotNull()
    has_both = has_content & F.col("title").isNotNull()
    totals = df.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(has_content).alias("content"),
        F.count_if(has_both).alias("title"),
        F.count_distinct(F.when(has_both, F.sha2("content", 256))).alias("distinct"),
    )
    stages = F.array(
        _stage(1, "raw", F.col("raw"), F.col("raw")),
        _stage(2, "drop null content", F.col("content"), F.col("raw")),
        _stage(3, "drop null title", F.col("title"), F.col("content")),
        _stage(4, "drop duplicates", F.col("distinct"), F.col("title")),
    )
    return totals.select(F.inline(stages))


def _stage(step: int, name: str, left: Column, before: Column) -> Column:
    return F.struct(
        F.lit(step).alias("step"),
        F.lit(name).alias("stage"),
        left.alias("rows"),
        (before - left).alias("removed"),
    )


def drop_short(df: DataFrame, min_chars: int = 200, column: str = "content") -> DataFrame:
    """Drop stubs: rows whose content has fewer than ``min_chars`` code points."""
    return df.filter(F.length(column) >= min_chars)


def short_articles(df: DataFrame, max_chars: int = 200) -> DataFrame:
    """The stubs, with their length."""
    return df.select(
        "id", "title", "publication", F.length("content").alias("content_len"), "content"
    ).filter(F.col("content_len") < max_chars)


def shortest_articles(df: DataFrame, outlets: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` shortest articles of the given outlets."""
    return (
        df.filter(F.col("publication").isin(list(outlets)))
        .select("id", "publication", "title", F.length("content").alias("content_len"))
        .orderBy("content_len", "id")
        .limit(n)
    )


def preprocess(df: DataFrame, stop: Sequence[str] = ENGLISH) -> DataFrame:
    """Add ``text_clean``, the cleaned title and content. A projection: no shuffle."""
    combined = tx.combine_text(F.col("title"), F.col("content"))
    return df.withColumn("text_clean", tx.clean_text(combined, stop))


def preprocess_trace(df: DataFrame, text: str = "content", stop: Sequence[str] = ENGLISH) -> DataFrame:
    """Every stage of the text preparation side by side, and the stopwords that were removed."""
    return (
        df.withColumn("lowercased", tx.lowered(F.col(text)))
        .withColumn("urls_removed", tx.without_urls(F.col("lowercased")))
        .withColumn("alpha_only", tx.letters_only(F.col("urls_removed")))
        .withColumn("squeezed", tx.squeezed(F.col("alpha_only")))
        .withColumn("cleaned", F.array_join(tx.split_words(F.col("squeezed"), stop), " "))
        .withColumn(
            "removed_stopwords",
            F.filter(F.split("squeezed", " "), lambda w: w.isin(list(stop))),
        )
    )


def with_preview(df: DataFrame, column: str, n: int = 200) -> DataFrame:
    """Add ``<column>_preview``."""
    return df.withColumn(f"{column}_preview", tx.preview(F.col(column), n))


def title_overlap(df: DataFrame, n: int = 8, stop: Sequence[str] = ENGLISH) -> DataFrame:
    """Per article, the ``n`` title words that occur most often in its content.

    Words are lower-cased and split at white space only; stopwords and words of up to two letters
    are left out. Works inside the row, so nothing is shuffled.
    """
    spaces = r"(?U)[\s\x1c-\x1f]+"
    words = df.select(
        "id",
        F.array_distinct(F.split(F.lower("title"), spaces)).alias("title_words"),
        F.split(F.lower("content"), spaces).alias("content_words"),
    )
    counted = words.select(
        "id",
        F.transform(
            F.filter("title_words", lambda w: (F.length(w) > 2) & ~w.isin(list(stop))),
            lambda w: F.struct(
                (F.size("content_words") - F.size(F.array_remove("content_words", w))).alias("in_content"),
                w.alias("word"),
            ),
        ).alias("counted"),
    )
    best_first = F.array_sort(
        "counted",
        lambda a, b: F.when(a["in_content"] > b["in_content"], -1)
        .when(a["in_content"] < b["in_content"], 1)
        .when(a["word"] < b["word"], -1)
        .when(a["word"] > b["word"], 1)
        .otherwise(0),
    )
    return counted.select("id", F.inline(F.slice(best_first, 1, n))).select(
        "id", "word", "in_content", (F.col("in_content") + 1).alias("in_combined")
    )
