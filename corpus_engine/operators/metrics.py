"""Classifier evaluation from a ``(label, prediction)`` table.

The rows are counted per (label, prediction) first; all figures come from those few counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(preds: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(label, prediction, n)`` for the pairs that occur."""
    return preds.groupBy(*extra, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def accuracy(preds: DataFrame) -> DataFrame:
    return preds.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"))


def _ratio(num: Column, den: Column) -> Column:
    """Undefined ratios count as 0."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def class_scores(preds: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class of label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("p"), hit.alias("t")
        ),
        F.struct(
            F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("p"),
            F.lit(0).cast("bigint").alias("t"),
        ),
    )
    totals = (
        confusion_counts(preds, extra)
        .select(*extra, F.inline(sides))
        .groupBy(*extra, "class")
        .agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("tp"))
    )
    return totals.select(
        *extra,
        "class",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "predicted",
        "tp",
    )


def f1(preds: DataFrame) -> DataFrame:
    """Macro F1 (mean over classes) and weighted F1 (mean over rows)."""
    return class_scores(preds).agg(
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def classification_report(preds: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    scores = class_scores(preds)
    per_class = scores.select(
        F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support"
    )
    weight = F.col("support") / F.sum("support")
    totals = scores.agg(
        (F.sum("tp") / F.sum("support")).alias("acc"),
        F.sum("support").alias("rows"),
        *[F.avg(m).alias(f"m_{m}") for m in ("precision", "recall", "f1")],
        *[
            (F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"w_{m}")
            for m in ("precision", "recall", "f1")
        ],
    )
    summary = totals.select(
        F.inline(
            F.array(
                _summary("accuracy", "acc", "acc", "acc"),
                _summary("macro avg", "m_precision", "m_recall", "m_f1"),
                _summary("weighted avg", "w_precision", "w_recall", "w_f1"),
            )
        )
    )
    return per_class.unionByName(summary)


def _summary(name: str, precision: str, recall: str, f1_name: str) -> Column:
    return F.struct(
        F.lit(name).alias("class"),
        F.col(precision).alias("precision"),
        F.col(recall).alias("recall"),
        F.col(f1_name).alias("f1"),
        F.col("rows").alias("support"),
    )


def confusion_matrix(preds: DataFrame, normalize: bool = False) -> DataFrame:
    """Every (label, prediction) cell, zeros included; ``normalize`` adds the share of the row."""
    counts = confusion_counts(preds)
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).distinct()
    # the class list is one small array, so the dense grid needs no cross join
    every = classes.agg(F.collect_list("c")).scalar()
    grid = classes.select(F.col("c").alias("label"), F.explode(every).alias("prediction"))
    dense = grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )
    if not normalize:
        return dense
    support = counts.groupBy("label").agg(F.sum("n").alias("_support"))
    return dense.join(support, "label", "left").select(
        "label", "prediction", "n", _ratio(F.col("n"), F.col("_support")).alias("fraction")
    )


def worst_confusions(preds: DataFrame, n: int = 10) -> DataFrame:
    """The cells off the diagonal that take the largest share of their true class."""
    cells = confusion_matrix(preds, normalize=True).select(
        F.col("label").alias("true_topic"),
        F.col("prediction").alias("predicted_as"),
        F.when(F.col("label") == F.col("prediction"), 0.0).otherwise(F.col("fraction")).alias("fraction"),
    )
    return cells.orderBy(F.desc("fraction"), "true_topic", "predicted_as").limit(n)


def binary_table(preds: DataFrame, topic: object) -> DataFrame:
    """One class against the rest: TP, FP, FN, TN and the scores from them."""
    truth, said = F.col("label") == topic, F.col("prediction") == topic
    cells = preds.agg(
        F.count_if(truth & said).alias("tp"),
        F.count_if(~truth & said).alias("fp"),
        F.count_if(truth & ~said).alias("fn"),
        F.count_if(~truth & ~said).alias("tn"),
    )
    return cells.select(
        "*",
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def hardest_topics(preds: DataFrame, n: int = 5) -> DataFrame:
    """The classes with the lowest F1."""
    return (
        class_scores(preds)
        .select("class", "precision", "recall", "f1", "support")
        .orderBy("f1", "class")
        .limit(n)
    )


def f1_tiers(preds: DataFrame) -> DataFrame:
    """Classes per F1 tier."""
    tier = (
        F.when(F.col("f1") >= 0.9, "excellent")
        .when(F.col("f1") >= 0.8, "good")
        .when(F.col("f1") >= 0.7, "challenging")
        .otherwise("below")
    )
    return (
        class_scores(preds)
        .groupBy(tier.alias("tier"))
        .agg(F.count(F.lit(1)).alias("classes"), F.sum("support").alias("articles"))
    )


def pick_correct(preds: DataFrame, first: object = 0, key: str = "id") -> DataFrame:
    """One correctly classified article, of class ``first`` if there is one."""
    return (
        preds.filter(F.col("label") == F.col("prediction"))
        .orderBy(F.col("label") != first, key)
        .limit(1)
    )


def compare_models(preds: DataFrame, preferred: str) -> DataFrame:
    """Accuracy and macro F1 per ``model``; the higher F1 wins, ``preferred`` wins ties."""
    table = (
        class_scores(preds, ("model",))
        .groupBy("model")
        .agg(
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            F.avg("f1").alias("f1_macro"),
        )
    )
    best = table.agg(
        F.max_by("model", F.struct("f1_macro", F.col("model") == preferred, "model"))
    ).scalar()
    return table.withColumn("winner", F.col("model") == best)
