"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SHUFFLE_PARTS = "spark.sql.shuffle.partitions"


def build_session(
    app: str = "corpus_engine", master: str | None = None, shared: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators rely on (UTC dates, AQE with skew handling).

    ``shared`` names the folder for intermediate tables that all executors can reach.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A session on one machine that names none gets a temporary folder, removed when the program
    ends. On a cluster a local folder would give incomplete results, so a missing name is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corpus-engine-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def settled(df: DataFrame, name: str, broadcast_rows: int = 0, parts: int = 0) -> DataFrame:
    """Write a small derived table to the shared folder now, and go on from the written copy.

    Spark only knows the size of a derived table after the plan is fixed, and by then has shuffled
    the big side of a join with it. A written table has a known size: below Spark's own threshold
    it is broadcast by itself, and up to ``broadcast_rows`` rows (counted) it is marked for it.
    Beyond that the join is a shuffle join. The copy also ends the lineage and is computed once, and
    the shuffle files behind it go as soon as it is written. A table whose way to the copy grows with the input
    names ``parts``: its shuffles have no fewer, however few the session sets.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    given = spark.conf.get(SHUFFLE_PARTS)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    spark.conf.set(SHUFFLE_PARTS, str(max(int(given), parts)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
        spark.conf.set(SHUFFLE_PARTS, given)
    copy = spark.read.parquet(path)
    if broadcast_rows and copy.count() <= broadcast_rows:
        return F.broadcast(copy)
    return copy


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a *scan* on ``key`` when it has fewer splits than the cluster has cores.

    One small file with one row group would otherwise run the whole text work in a single task.
    A large table already has more splits than cores and passes through without a shuffle.
    Call it on scans only: asking a plan with shuffles for its partitions would run them.
    """
    if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(key)
