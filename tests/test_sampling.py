"""Samples and splits: exact sizes, exact quotas, brute force under skew."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus_engine.operators import sampling as sp


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows: one class holds half of them, one has a single row, some have none."""
    label = (
        F.when(F.col("id") < 1000, "hot").when(F.col("id") == 1000, "single").when(F.col("id") < 1100, None)
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 9).cast("string")))
    )
    return spark.range(2000).select("id", label.alias("label")).cache()


def test_sample_n_is_the_hash_order_prefix(spark, skewed):
    for n in (0, 1, 137, 2000, 5000):
        got = {r.id for r in sp.sample_n(skewed, n, 7).collect()}
        assert got == set(sorted(range(2000), key=lambda i: key(7, i))[:n])


def test_stratified_sample_matches_brute_force(spark, skewed):
    rows = {r.id: r.label for r in skewed.collect()}
    counts = Counter(v for v in rows.values() if v is not None)
    taken = set()
    for label, n in counts.items():
        quota = min(n, math.floor(333 * n / 2000))
        members = sorted((i for i, v in rows.items() if v == label), key=lambda i: key(42, i))
        taken |= set(members[:quota])
    rest = sorted((i for i in rows if i not in taken), key=lambda i: key(43, i))
    taken |= set(rest[: 333 - len(taken)])
    assert {r.id for r in sp.stratified_sample(skewed, "label", 333).collect()} == taken


def test_stratified_sample_is_clamped_to_the_table(spark, skewed):
    assert sp.stratified_sample(skewed, "label", 9999).count() == 2000


def test_split_sizes_are_exact_and_classes_keep_their_share(spark, skewed):
    known = skewed.filter("label IS NOT NULL")
    split = sp.stratified_split(known, "label").cache()
    total = known.count()
    assert split.filter("is_test").count() == math.ceil(0.2 * total)
    assert split.count() == total
    for row in sp.split_balance(split, "label").collect():
        share = math.ceil(0.2 * total) / total
        assert abs(row.test_n - share * (row.test_n + row.train_n)) < 1
    again = sp.stratified_split(known.repartition(3), "label")
    assert again.exceptAll(split).count() == 0
    background = sp.background_ids(split, 50)
    assert background.count() == 50 and background.join(split.filter("is_test"), "id").count() == 0


def test_no_task_ranks_a_whole_stratum(skewed, monkeypatch):
    """Ranking happens inside a key slice, never over a stratum; all rows meet small tables only."""
    final = sp.stratified_split(skewed, "label")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in final and "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    monkeypatch.setattr(sp, "settled", lambda df, name, rows=0: df)
    plan = sp.stratified_split(skewed, "label")._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.split("\n") if "row_number()" in line and "label" in line]
    assert ranked and all("_slice" in line or "_rest" in line for line in ranked)


def test_split_is_the_same_without_broadcasts(spark, skewed, monkeypatch):
    known = skewed.filter("label IS NOT NULL")
    usual = sp.stratified_split(known, "label").collect()
    monkeypatch.setattr(sp, "BROADCAST_STRATA", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = sp.stratified_split(known, "label").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, shuffled)) == sorted(map(tuple, usual))


def test_shuffle_keeps_all_rows(skewed):
    ids = [r.id for r in sp.shuffle(skewed).collect()]
    assert sorted(ids) == list(range(2000)) and ids == sorted(range(2000), key=lambda i: key(42, i))
