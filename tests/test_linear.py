"""The linear classifier on sparse rows: few passes, the optimum, whole blocks."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpus_engine.operators import linear as ln
from corpus_engine.operators import models as md


def wordy(rows=800, features=3000, classes=4):
    """Unit rows in which few features are common, most are rare, and a fifth belong to one class."""
    rng = np.random.default_rng(7)
    often = 1 / np.arange(1, features + 1)
    own = rng.integers(0, 5 * classes, features)
    x, y = np.zeros((rows, features)), rng.integers(0, classes, rows)
    for i in range(rows):
        p = often * np.where(own == y[i], 4.0, np.where(own < classes, 0.5, 1.0))
        x[i, rng.choice(features, 40, replace=False, p=p / p.sum())] = rng.random(40) + 0.5
    return x / np.linalg.norm(x, axis=1, keepdims=True), y


def test_sixty_iterations_reach_the_optimum_of_rows_with_rare_features(spark):
    x, y = wordy()
    data = [(int(k), Vectors.sparse(x.shape[1], [(int(j), float(v[j])) for j in np.flatnonzero(v)])) for v, k in zip(x, y)]
    model = md.train_logistic(spark.createDataFrame(data, ["label_idx", "features"]), C=5.0, max_iter=60)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    p = np.exp(x @ w.T + b)
    over = p / p.sum(axis=1, keepdims=True) - np.eye(4)[y]
    assert np.abs(over.T @ x + w / 5.0).max() < 2e-2 and np.abs(over.sum(axis=0)).max() < 2e-2


def test_blocks_hold_every_entry_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(ln, "ENTRIES", 5)
    vectors = [Vectors.sparse(9, {}), Vectors.dense(range(9)), Vectors.sparse(9, {1: 2.0, 8: 0.0}), Vectors.sparse(9, {0: 3.0, 4: 1.0})] * 3
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vectors)], ["label_idx", "features"]).coalesce(1)
    batch = df.select(F.col("label_idx").alias("label"), ln.storage(F.col("features")).alias("v"), F.lit(9).alias("width"))
    found = [ln._unpacked(type("Row", (tuple,), {"width": 9})(c.as_py() for c in r)) for r in _rows(ln.pack(batch.toArrow().to_batches()))]
    assert max(len(b.size) for b in found) < 12 and len(found) > 3
    assert np.concatenate([b.label for b in found]).tolist() == [i % 3 for i in range(12)]
    assert np.concatenate([b.size for b in found]).tolist() == [0, 8, 1, 2] * 3
    assert np.concatenate([b.value for b in found]).tolist() == [*range(1, 9), 2.0, 3.0, 1.0] * 3


def _rows(batches):
    return [list(b.slice(i, 1).columns[k][0] for k in range(4)) for b in batches for i in range(b.num_rows)]


def test_no_rows_are_an_error(spark):
    some = spark.createDataFrame([(0, Vectors.dense([1.0]))], ["label_idx", "features"])
    with pytest.raises(ValueError, match="no rows"):
        md.train_logistic(some.filter("label_idx > 0"))
