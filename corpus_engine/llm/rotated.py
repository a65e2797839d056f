"""Nearest neighbours by largest inner product on randomly rotated one-bit codes.

A vector is turned by a random rotation into ``CODE_BITS`` dimensions and kept as the signs of its
coordinates, its length, and the inner product of its direction with the sign vector. From the
signs the inner product with a query is estimated, with a bound on the error that holds with high
probability. Only vectors whose upper bound reaches the k-th best lower bound are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.session import settled

CODE_BITS = 256
QUERY_BITS = 4
SPREAD = 1.9  # standard deviations in the error bound
SEED = 20
BASE_BLOCK = 8192  # vectors in a block
QUERY_BLOCK = 1024  # queries in a block


def rotation(dims: int, bits: int = CODE_BITS, seed: int = SEED) -> np.ndarray:
    """``dims`` orthonormal rows in ``bits`` dimensions (at least ``dims``), the same in every task."""
    drawn = np.random.default_rng(seed).normal(size=(max(bits, dims), dims))
    return np.linalg.qr(drawn)[0].T


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits (64 to a word), lengths, and each direction's inner product with its code."""
    lengths = np.linalg.norm(vectors, axis=1)
    turned = (vectors / lengths[:, None]) @ turn
    bits = turned > 0
    width = turned.shape[1]
    fit = np.abs(turned).sum(axis=1) / np.sqrt(width)
    padded = np.zeros((len(bits), -(-width // 64) * 64), dtype=bool)
    padded[:, :width] = bits
    return np.packbits(padded, axis=1).view(np.uint64), lengths, fit


def estimate(
    query: np.ndarray, turn: np.ndarray, codes: np.ndarray, lengths: np.ndarray, fit: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of a query with all coded vectors, and bounds on their errors.

    The turned query is rounded to ``QUERY_BITS`` bits a coordinate, so that its inner product with
    the signs is a weighted count of common bits of its bit planes and the codes.
    """
    size = float(np.linalg.norm(query))
    turned = (query / size) @ turn
    width = len(turned)
    low, high = turned.min(), turned.max()
    step = max((high - low) / ((1 << QUERY_BITS) - 1), 1e-12)
    levels = np.rint((turned - low) / step).astype(np.uint8)
    padded = np.zeros(codes.shape[1] * 64, dtype=np.uint8)
    padded[:width] = levels
    common = np.zeros(len(codes))
    for plane in range(QUERY_BITS):
        mask = np.packbits(padded >> plane & 1).view(np.uint64)
        common += np.bitwise_count(codes & mask).sum(axis=1, dtype=np.int64) << plane
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    rounded = low + step * levels
    signed = 2 * (step * common + low * ones) - rounded.sum()
    scale = lengths * size / fit
    error = SPREAD * np.sqrt(np.maximum(1 - fit**2, 0) / max(width - 1, 1)) + np.linalg.norm(turned - rounded) * fit
    return scale * signed / np.sqrt(width), scale * error


def _search(count: int, bits: int):
    """Best ``count`` of a block of vectors for each query of a block."""

    def run(queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        rows: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(base):
            ids = base["id"].to_numpy()
            for dims, group in queries.groupby("dims", sort=True):
                own = np.flatnonzero(base["dims"].to_numpy() == dims)
                if not len(own):
                    continue
                vectors = np.stack(base["vector"].to_numpy()[own]).astype(np.float64)
                turn = rotation(int(dims), bits)
                codes, lengths, fit = encode(vectors, turn)
                for query_id, query in zip(group["id"], group["vector"], strict=True):
                    query = np.asarray(query, dtype=np.float64)
                    about, error = estimate(query, turn, codes, lengths, fit)
                    others = ids[own] != query_id
                    lower = np.where(others, about - error, -np.inf)
                    k = min(count, len(own))
                    least = np.partition(lower, len(own) - k)[len(own) - k]
                    near = np.flatnonzero(others & (about + error >= least))
                    exact = vectors[near] @ query
                    best = np.lexsort((ids[own][near], -exact))[:count]
                    rows["query_id"] += [query_id] * len(best)
                    rows["vec_id"] += ids[own][near][best].tolist()
                    rows["score"] += exact[best].tolist()
        return pd.DataFrame(rows).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector, dims`` of the vectors that can take part: with an id, finite and not zero."""
    named = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return named.where(
        F.col("id").isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists("vector", lambda x: x != 0)
    ).withColumn("dims", F.size("vector"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    count: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    bits: int = CODE_BITS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` vectors with the largest inner products.

    Vectors that are null, zero, or hold null or non-finite numbers take no part, and vectors of
    other lengths than a query's are not compared with it. A query is not compared with rows of
    its own id; rows that repeat an id and vector count once. Ties go to the smaller id; scores are
    exact. Blocks of queries meet blocks of vectors; each meeting yields at most ``count`` rows a
    query, so nothing grows with the pairs. No rows give no rows.
    """
    base = settled(usable(vectors, id_column, vector_column).dropDuplicates(["id", "vector"]), "vectors")
    asked = settled(usable(queries, id_column, vector_column).dropDuplicates(["id", "vector"]), "vector-queries")
    parts = max(1, -(-base.count() // BASE_BLOCK))
    turns = max(1, -(-asked.count() // QUERY_BLOCK))
    block, turn = F.pmod(F.xxhash64("id"), F.lit(parts)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(turns))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("*", turn.cast("int").alias("turn"), every(parts).alias("block"))
    right = base.select("*", block.cast("int").alias("block"), every(turns).alias("turn"))
    found = left.groupBy("turn", "block").cogroup(right.groupBy("turn", "block")).applyInPandas(
        _search(count, bits), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")
