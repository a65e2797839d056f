"""From raw documents to packed training sequences, in five stages.

Every stage takes the table its predecessor kept, as written to the shared folder, and returns what
it keeps; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.llm import langid, packing, pii, repeats, simhash
from corpus_engine.llm.base import aside
from corpus_engine.session import scratch_path


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language go on; those without one (no text, no letter) go. A missing ``lang``
    is filled in with the prediction."""
    narrow, widen = aside(docs, "doc_id", "text", "lang")
    found = langid.identify(narrow, langid.train(narrow), tuple(narrow.columns))
    kept = found.where(F.col("lang_pred") != langid.UNKNOWN)
    return widen(kept.withColumn("lang", F.coalesce("lang", "lang_pred")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: 4-word shingles, up to 4 differing bits."""
    return simhash.keep_one(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur twice are taken out of the texts."""
    return _counted(repeats.remove_repeats(docs))


def pii_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes a mark of its kind."""
    return _counted(pii.redact(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of up to 4096 ids."""
    cut = packing.pieces(docs)
    cut = cut.select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("pii", pii_removal),
    ("best_fit_packing", sequences),
]

#: SQL has neither the trained model nor the tokenizer; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
