"""The registered queries on the operators of this subpackage, one for each over its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.llm import (
    alignment, langid, licenses, negatives, packing, pages, pieces, pii, quality, repeats, rotated, secret_scan, simhash,
)
from corpus_engine.llm import secret_sql
from corpus_engine.llm.base import REGISTRY, Entry, register, table


def load() -> dict[str, Entry]:
    """All queries by name."""
    return REGISTRY


@register()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 4-word shingles, up to 4 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@register()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those whose hashed id is not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~_held_out()))
    return _held(langid.identify(docs, model))


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _held(found: DataFrame) -> DataFrame:
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


@register()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, with a model trained on the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of up to 4096 ids."""
    cut = packing.pieces(table(spark, sf_dir, "documents"))
    cut = cut.select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def _joined(spans):
    """kind:start:end by start and then kind, comma-joined."""
    rank = F.array(*(F.lit(k) for k in pii.KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"], F.array_position(rank, s["kind"]), s["end"],
            F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("written"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["written"]), ",")


@register()
def op9_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: plain patterns and what their contexts discover."""
    found = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"),
    )


@register()
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@register()
def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = pages.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@register()
def op1_rotated_codes_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one, by largest inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return rotated.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@register()
def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, and decoded again to see that every text comes back."""
    docs = table(spark, sf_dir, "documents")
    back = pieces.decode(pieces.encode(docs))
    return back.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


@register()
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without the 200-byte strings that occur twice."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    whole = docs.select(
        "doc_id", repeats.key_of(F.col("text")).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole_sha256"),
    )
    lost = repeats.removals(docs).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha256"))
    return whole.join(lost, "key", "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha256", "whole_sha256").alias("kept_sha256"),
    )


@register(
    """
WITH shown AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
whole AS (SELECT r, vec_id, label, list_transform(x, lambda e: floor(256 * e)) AS v FROM shown
          WHERE len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
pairs AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
          FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.r <> b.r),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place FROM pairs WHERE same)
              WHERE place <= 5),
found AS (SELECT p.anchor_id, p.vec_id AS positive_id,
                 row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
                 n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
          FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT * FROM found WHERE rank <= 3"""
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth vector."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding"
    )
    return negatives.mine(rows, rows.where(F.col("vec_id") % 50 == 0))


@register()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in all documents, with the pairs' counts."""
    found, _ = alignment.align(table(spark, sf_dir, "documents"), whole=False)
    return found.withColumnRenamed("groups", "groups_sha256")


@register(secret_sql.STATEMENT)
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: plain patterns and strings of high entropy."""
    found = secret_scan.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secret_scan.BASE
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(secret_scan.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written(secret_scan.in_order(F.concat("base", "added"))).alias("spans"),
    )


@register(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the whole pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
