"""Topic classifiers: label encoding, training, sweep, prediction, persistence."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpus_engine.operators import linear as ln
from corpus_engine.operators import trees as tr
from corpus_engine.operators.linear import LinearModel
from corpus_engine.operators.trees import OneVsRestModel
from corpus_engine.session import settled


ROWS_OF_A_PART = 4_000  # training rows that make a partition worth its cost in every iteration
SWEEPS = 3  # regularisation strengths that are trained at the same time


def label_table(df: DataFrame, label: str) -> DataFrame:
    """``(label_idx, label)``: sorted distinct labels numbered from 0. One row per class."""
    distinct = df.filter(F.col(label).isNotNull()).select(label).distinct()
    index = F.dense_rank().over(Window.orderBy(label)) - 1
    return settled(distinct.select(index.cast("int").alias("label_idx"), label), "labels")


def encode_labels(df: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Add ``label_idx``; rows with an unknown label are dropped."""
    return df.join(labels, label).select(*df.columns, "label_idx")


def decode_labels(df: DataFrame, labels: DataFrame, label: str, index: str = "prediction") -> DataFrame:
    """Add the label a class index stands for."""
    named = labels.select(F.col("label_idx").cast("double").alias("_idx"), label)
    return df.join(named, F.col(index).cast("double") == F.col("_idx"), "left").drop("_idx")


def labelled_features(labels: DataFrame, features: DataFrame, key: str = "id") -> DataFrame:
    """Features of the labelled documents: inner join on the document key."""
    return labels.join(features, key)


def train_logistic(
    df: DataFrame,
    label: str = "label_idx",
    C: float = 5.0,
    max_iter: int = 1000,
    features: str = "features",
) -> LinearModel:
    """Multinomial logistic regression with an L2 penalty of strength ``1 / C``.

    The least sum of the losses and ``|w|^2 / (2 C)``. Features are not standardised, so coefficients belong to the
    TF-IDF weights as they are. An iteration pays for every partition, as each brings a gradient of
    classes x vocabulary numbers, so rows are put together, see ``training_parts``.
    """
    blocks = ln.blocks_of(df, label, features)
    try:
        return _fit(blocks, ln.shape_of(blocks), C, max_iter)
    finally:
        blocks.unpersist()


def _fit(blocks: RDD, shape: tuple[int, int, int], C: float, max_iter: int) -> LinearModel:
    parts = training_parts(shape[0], blocks.getNumPartitions(), blocks.context.defaultParallelism)
    return ln.fit(blocks.coalesce(parts), shape, C, max_iter)


def training_parts(rows: int, given: int, cores: int) -> int:
    """Partitions of a training table: one for each core, fewer where there are few rows. However many rows there
    are, the gradients that an iteration adds up are no more than the cores."""
    return max(1, min(given, cores, -(-rows // ROWS_OF_A_PART)))


def train_boosted(
    df: DataFrame,
    label: str = "label_idx",
    max_iter: int = 100,
    max_depth: int = 4,
    step: float = 0.1,
    subsample: float = 0.8,
    seed: int = 42,
):
    """Boosted-tree challenger on all features, one binary booster per class. Rows cost their non-zero entries."""
    return tr.train_one_vs_rest(df, label, max_iter, max_depth, step, subsample, seed)


def train_forest(df: DataFrame, label: str = "label_idx", trees: int = 20, max_depth: int = 8, seed: int = 42):
    """Tree challenger that handles many classes natively."""
    return tr.train_forest(df, label, trees, max_depth, seed)


def predict(model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` (class index) and, where the model has them, class probabilities."""
    scored = model.transform(df).drop("rawPrediction")
    return scored.withColumn("prediction", F.col("prediction").cast("int"))


def sweep_c(
    train: DataFrame,
    test: DataFrame,
    values: Sequence[float] = (0.01, 0.1, 1, 5, 10, 50),
    label: str = "label_idx",
    max_iter: int = 500,
) -> DataFrame:
    """Training and test accuracy per regularisation strength.

    The strengths are trained at the same time, as an iteration of one leaves cores idle while the driver works,
    and share the blocks of the rows.
    """
    train, test = train.persist(), test.persist()
    blocks = ln.blocks_of(train, label)

    def scored(c: float) -> tuple:
        model = _fit(blocks, shape, float(c), max_iter)
        right = F.avg((F.col("prediction") == F.col(label)).cast("int"))
        return float(c), *(predict(model, side).agg(right).first()[0] for side in (train, test))

    try:
        shape = ln.shape_of(blocks)
        with ThreadPool(min(SWEEPS, len(values))) as pool:
            rows = pool.map(scored, values, chunksize=1)
    finally:
        blocks.unpersist()
        train.unpersist()
        test.unpersist()
    return train.sparkSession.createDataFrame(rows, "C double, train_acc double, test_acc double")


def coef_rows(spark: SparkSession, model: LinearModel) -> DataFrame:
    """Coefficients as rows ``(term_id, weights)``, ``weights[k]`` for class ``k``.

    The matrix (classes x vocabulary) lives on the driver in any case; it leaves as one Arrow table.
    """
    matrix = np.ascontiguousarray(model.coefficientMatrix.toArray().T)
    terms, classes = matrix.shape
    ends = pa.array(np.arange(0, terms * classes + 1, classes, dtype=np.int32))
    columns = [pa.array(np.arange(terms, dtype=np.int32)), pa.ListArray.from_arrays(ends, pa.array(matrix.ravel()))]
    return spark.createDataFrame(pa.table(columns, names=["term_id", "weights"]))


def coef_table(spark: SparkSession, model: LinearModel, vocab: DataFrame) -> DataFrame:
    """Coefficients with their terms ``(term_id, term, weights)``. ``coef_long`` unfolds it."""
    rows = coef_rows(spark, model)
    return rows.join(vocab.select("term_id", "term"), "term_id").select("term_id", "term", "weights")


def coef_long(coef: DataFrame) -> DataFrame:
    """``(label_idx, term_id, term, weight)``."""
    return coef.select("term_id", "term", F.posexplode("weights").alias("label_idx", "weight")).select(
        "label_idx", "term_id", "term", "weight"
    )


def loss_gradient(
    rows: DataFrame, labels: DataFrame, probabilities: DataFrame, coef: DataFrame, C: float = 5.0, key: str = "id"
) -> DataFrame:
    """``(label_idx, largest)``: per class the largest part of the gradient of the penalised loss, from tables alone.

    At the optimum of ``sum(loss) + |w|^2 / (2 C)`` it vanishes. ``rows`` has ``(key, term_id, tfidf)``, ``labels``
    ``(key, label_idx)``, ``probabilities`` ``(key, probability)``, ``coef`` ``(term_id, weights)``. A term that no
    row has counts with its weight alone. The intercepts, which have no penalty, are a part of their own.
    """
    told = probabilities.join(labels, key).select(
        key, F.posexplode("probability").alias("class", "p"), "label_idx"
    ).select(key, F.col("class").alias("label_idx"), (F.col("p") - (F.col("class") == F.col("label_idx")).cast("double")).alias("over"))
    pulls = rows.join(told, key).groupBy("label_idx", "term_id").agg(F.sum(F.col("over") * F.col("tfidf")).alias("pull"))
    weights = coef.select("term_id", F.posexplode("weights").alias("label_idx", "weight"))
    parts = weights.join(pulls, ["label_idx", "term_id"], "left").select(
        "label_idx", F.abs(F.coalesce("pull", F.lit(0.0)) + F.col("weight") / C).alias("part")
    )
    intercepts = told.groupBy("label_idx").agg(F.abs(F.sum("over")).alias("part"))
    return parts.unionByName(intercepts).groupBy("label_idx").agg(F.max("part").alias("largest"))


def save_model(model: LinearModel | OneVsRestModel, labels: DataFrame, path: str) -> None:
    """Store the classifier and its label table, replacing earlier ones."""
    model.write().overwrite().save(f"{path}/model")
    labels.write.mode("overwrite").parquet(f"{path}/labels")


def load_model(
    spark: SparkSession, path: str, kind: type = LinearModel
) -> tuple[LinearModel | OneVsRestModel, DataFrame]:
    """A stored classifier and its labels; ``kind`` is ``OneVsRestModel`` for the boosted trees."""
    try:
        model = kind.load(f"{path}/model")
    except Exception as error:
        raise FileNotFoundError(f"no trained model at {path}: run the training first") from error
    return model, spark.read.parquet(f"{path}/labels")
