"""Explanations of a linear topic classifier.

``coef`` has one row per term: ``(term_id, term, weights)`` with ``weights[k]`` for class ``k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.operators.features import BROADCAST_ROWS
from corpus_engine.operators.models import coef_long
from corpus_engine.operators.topk import signed_extremes, top_n_per_group
from corpus_engine.session import settled

# Largest coefficient table (terms x classes) that is sent to every executor: 32 M doubles, 256 MB.
BROADCAST_CELLS = 32_000_000


def topic_word_importance(coef: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` words with the highest coefficient per class: ``(label_idx, rank, word, importance)``."""
    ranked = top_n_per_group(coef_long(coef), "label_idx", [F.desc("weight"), "term"], n)
    return ranked.select(
        "label_idx", "rank", F.col("term").alias("word"), F.col("weight").alias("importance")
    )


def signed_words(coef: DataFrame, towards: int, away: int, n: int = 15) -> DataFrame:
    """The ``n`` words that speak most for one class against another, and the ``n`` that speak most against it:
    ``rank, word, weight, sign``, from the largest weight to the smallest."""
    weight = F.get("weights", F.lit(towards)) - F.get("weights", F.lit(away))
    words = coef.select(F.col("term").alias("word"), weight.alias("weight"))
    sides = []
    for sign, order in (("+", [F.desc("weight"), "word"]), ("-", [F.asc("weight"), F.desc("word")])):
        some = words.filter(F.col("weight") > 0 if sign == "+" else F.col("weight") < 0).orderBy(*order).limit(n)
        sides.append(some.withColumn("sign", F.lit(sign)))
    # 2 n rows
    rank = F.row_number().over(Window.orderBy(F.desc("weight"), "word"))
    return sides[0].unionByName(sides[1]).select(rank.alias("rank"), "word", "weight", "sign")


def importance_of_biggest(
    coef: DataFrame, labelled: DataFrame, info: DataFrame, topics: int = 8, n: int = 12
) -> DataFrame:
    """Chart data: ``n`` words for the most populous topics, with the topic name.

    ``labelled`` has ``(label_idx, topic_id)`` per article.
    """
    biggest = (
        labelled.groupBy("label_idx", "topic_id")
        .agg(F.count(F.lit(1)).alias("articles"))
        .orderBy(F.desc("articles"), "topic_id")
        .limit(topics)
    )
    names = info.select(F.col("topic").alias("topic_id"), "name")
    return (
        topic_word_importance(coef, n)
        .join(biggest, "label_idx")
        .join(names, "topic_id", "left")
        .select(
            "topic_id",
            F.coalesce("name", F.col("topic_id").cast("string")).alias("name"),
            "articles",
            "rank",
            "word",
            "importance",
        )
    )


def contributions(features: DataFrame, coef: DataFrame, preds: DataFrame, key: str = "id") -> DataFrame:
    """``coefficient x weight`` of every term of a document for its predicted class.

    ``preds`` has ``(key, prediction)``. The coefficients are written and their numbers counted: up
    to ``BROADCAST_CELLS`` they are broadcast, and the feature rows stay where they are; above
    that Spark picks the join by size.
    """
    table = settled(coef.select("term_id", "weights"), "coefficients")
    cells = table.agg(F.sum(F.size("weights"))).first()[0] or 0
    if cells <= BROADCAST_CELLS:
        table = F.broadcast(table)
    return (
        features.join(preds.select(key, "prediction"), key)
        .join(table, "term_id")
        .withColumn("weight", F.get("weights", F.col("prediction")))
        .select(
            key,
            "prediction",
            "term_id",
            "term",
            "tfidf",
            "weight",
            (F.col("weight") * F.col("tfidf")).alias("contribution"),
        )
    )


def background_mean(features: DataFrame, background: DataFrame, key: str = "id") -> DataFrame:
    """Mean weight per term over the background documents; absent terms count as 0."""
    size = background.agg(F.count(F.lit(1))).scalar()
    return (
        features.join(background.select(key), key, "left_semi")
        .groupBy("term_id")
        .agg((F.sum("tfidf") / F.max(size)).alias("mean_bg"))
    )


def linear_attribution(
    features: DataFrame,
    coef: DataFrame,
    preds: DataFrame,
    background: DataFrame,
    key: str = "id",
) -> DataFrame:
    """``coef x (value - background mean)`` on the non-zero terms of every document.

    The exact additive attribution of a linear model, for all documents at once.
    """
    # one row per term that the background uses; the feature rows stay where they are
    means = settled(background_mean(features, background, key), "background", BROADCAST_ROWS)
    return (
        contributions(features, coef, preds, key)
        .join(means, "term_id", "left")
        .withColumn("mean_bg", F.coalesce("mean_bg", F.lit(0.0)))
        .withColumn("attribution", F.col("weight") * (F.col("tfidf") - F.col("mean_bg")))
        .drop("contribution")
    )


def attribution_extremes(attributions: DataFrame, n: int = 10, key: str = "id") -> DataFrame:
    """The ``n`` terms that push most towards and away from the predicted class, per document."""
    return signed_extremes(attributions, key, "attribution", "term", n)


def attribution_check(attributions: DataFrame, n: int = 5, key: str = "id") -> DataFrame:
    """Top ``n`` words per document with the attribution recomputed from its parts."""
    top = top_n_per_group(attributions, key, [F.desc("attribution"), "term"], n)
    again = F.col("weight") * F.col("tfidf") - F.col("weight") * F.col("mean_bg")
    return top.select(
        key,
        "rank",
        "term",
        "tfidf",
        "weight",
        "attribution",
        again.alias("recomputed"),
        (F.abs(again - F.col("attribution")) < 1e-9).alias("agrees"),
    )


def attribution_total(
    features: DataFrame, coef: DataFrame, preds: DataFrame, background: DataFrame, key: str = "id"
) -> DataFrame:
    """Per document, the sum of the attributions over *all* terms: score minus mean background score.

    ``score`` and ``base`` leave out the intercept, which cancels.
    """
    long = coef_long(coef)
    means = background_mean(features, background, key)
    # one row per class, written so that the join with all documents is a broadcast by size
    base = settled(
        means.join(long, "term_id")
        .groupBy(F.col("label_idx").alias("prediction"))
        .agg(F.sum(F.col("weight") * F.col("mean_bg")).alias("base")),
        "base",
    )
    score = (
        contributions(features, coef, preds, key=key)
        .groupBy(key, "prediction")
        .agg(F.sum("contribution").alias("score"))
    )
    return score.join(base, "prediction", "left").select(
        key,
        "prediction",
        "score",
        F.coalesce("base", F.lit(0.0)).alias("base"),
        (F.col("score") - F.coalesce("base", F.lit(0.0))).alias("total"),
    )
