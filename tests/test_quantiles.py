"""Exact quantiles by counting bits, next to sorting."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_engine.operators import profile as pf
from corpus_engine.operators import quantiles as qt

ODD = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.0000000000000002, 0.9999999999999999, 2.0**52, 2.0**-30, 1e300, 1.7976931348623157e308, float("inf"), 3.0, 8.0, 7.999999999999999]


def bits(x):
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_bits_are_those_of_the_number(spark):
    rng = np.random.default_rng(1)
    xs = [*ODD, *(-x for x in ODD), *(rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500)).tolist(), *(2.0 ** rng.integers(-1070, 1023, 300)).tolist()]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert all(r.b == bits(r.x) for r in df.select("x", qt.ordered_bits(F.col("x")).alias("b")).collect())


@pytest.mark.parametrize("ranked", [1_000_000, 20, 0])
def test_quantiles_equal_those_of_sorted_values(spark, monkeypatch, ranked):
    monkeypatch.setattr(qt, "RANKED_ROWS", ranked)
    rng = np.random.default_rng(2)
    groups = {
        "a": np.concatenate([rng.normal(size=400), np.zeros(300), rng.normal(size=100) * 1e-9]),
        "b": rng.integers(0, 5, 201).astype(float),
        "c": np.array([7.5]),
        None: -np.exp(rng.normal(size=50) * 40),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.77, 1.0]
    got = {(r.g, r.share): r.quantile for r in qt.quantiles(df, F.col("x"), shares, "g").collect()}
    assert set(got) == {(g, s) for g in groups for s in shares}
    for g, xs in groups.items():
        for s in shares:
            assert got[g, s] == pytest.approx(np.quantile(xs, s), rel=1e-12, abs=1e-300)
    whole = {r.share: r.quantile for r in qt.quantiles(df, F.col("x"), [0.5]).collect()}
    assert whole[0.5] == np.median(np.concatenate(list(groups.values())))


def test_empty_tables_and_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "g string, x int")
    assert [(r.g, r["median"]) for r in pf.median_by(df, "g", F.col("x")).collect()] == [("b", 2.0), ("a", None)]
    assert qt.quantiles(df.limit(0), F.col("x"), [0.5]).count() == 0
    none = pf.describe_numeric(df.limit(0), F.col("x")).first()
    assert none["count"] == 0 and none.q50 is None and none["max"] is None
