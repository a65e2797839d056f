"""Stored tables: articles, features, vocabulary, topic dimension, models, run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine.sources.articles import require_path


def write_table(df: DataFrame, path: str, key: str = "id") -> None:
    """Replace a table, range-partitioned and sorted on ``key``.

    Row-group minimum and maximum then let a lookup by ``key`` skip nearly all of the file set.
    """
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def lookup(spark: SparkSession, path: str, key: str, value: object) -> DataFrame:
    """Rows of a stored table with this key; the filter reaches the Parquet footers."""
    return require_path(spark, path).filter(F.col(key) == value)


def write_features(features: DataFrame, path: str, key: str = "id") -> None:
    """Store ``(id, features)`` where ``features`` is the sparse storage struct."""
    features.select(key, "features").write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str, key: str = "id", key_type: str = "bigint") -> DataFrame:
    """Stored feature rows as ML vectors: the declared vector type reads the struct directly."""
    schema = T.StructType(
        [T.StructField(key, T._parse_datatype_string(key_type)), T.StructField("features", VectorUDT())]
    )
    return spark.read.schema(schema).parquet(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    vocab.write.mode("overwrite").parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return require_path(spark, path, "fit the vocabulary first").select(
        "term_id", "term", "df", "corpus_tf", "idf"
    )


def write_csv(df: DataFrame, path: str, array_columns: Sequence[str] = (), sep: str = "|") -> None:
    """CSV sink; array columns are joined to one string first."""
    flat = df.withColumns({c: F.array_join(c, sep) for c in array_columns})
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: str, array_columns: Sequence[str] = (), sep: str = "|"
) -> DataFrame:
    flat = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return flat.withColumns({c: F.split(F.col(c), f"[{sep}]") for c in array_columns})


TOPIC_INFO_CSV = "topic int, count bigint, name string, representation string"


def write_topic_info(info: DataFrame, path: str) -> None:
    """The topic dimension as CSV."""
    write_csv(info.select("topic", "count", "name", "representation"), path, ["representation"])


def read_topic_info(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TOPIC_INFO_CSV, ["representation"])


def append_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    experiment: str,
    run_name: str,
    params: dict[str, object],
    metrics: dict[str, float],
) -> None:
    """Append one run record (parameters and metrics as maps)."""
    row = (
        run_id,
        experiment,
        run_name,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
    )
    schema = (
        "run_id string, experiment string, run_name string, "
        "params map<string,string>, metrics map<string,double>"
    )
    record = spark.createDataFrame([row], schema).withColumn("ts", F.current_timestamp())
    record.write.mode("append").parquet(path)


def list_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    """Logged runs, newest first, with the usual columns pulled out of the maps."""
    runs = require_path(spark, path, "no run was logged yet")
    if experiment is not None:
        runs = runs.filter(F.col("experiment") == experiment)
    return runs.select(
        "run_id",
        "experiment",
        "run_name",
        F.try_element_at("params", F.lit("model")).alias("model"),
        F.try_element_at("metrics", F.lit("accuracy")).alias("accuracy"),
        F.try_element_at("metrics", F.lit("f1_macro")).alias("f1_macro"),
        "params",
        "metrics",
        "ts",
    ).orderBy(F.desc("ts"), "run_id")
