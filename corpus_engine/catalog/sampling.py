"""Queries over samples, splits, joins on keys and label encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_engine.catalog.base import (
    ARTICLES,
    DATED,
    articles,
    dated_articles,
    register,
    table,
    tfidf_sql,
    with_sql,
)
from corpus_engine.catalog.text import FULL, weights
from corpus_engine.operators import models as md
from corpus_engine.operators import sampling as sp
from corpus_engine.operators.topk import top_n_per_group
from corpus_engine.session import scratch_path
from corpus_engine.sources import tables as tb

_SAMPLE = """, c AS (SELECT author, count(*) AS n FROM dated GROUP BY 1),
q AS (SELECT author, least(n, floor(300 * n / (SELECT sum(n) FROM c)))::BIGINT AS quota FROM c WHERE author IS NOT NULL),
o AS (SELECT id, author, row_number() OVER (PARTITION BY author ORDER BY md5('42:' || id)) AS rn FROM dated),
picked AS (SELECT o.id FROM o JOIN q USING (author) WHERE rn <= quota),
rest AS (SELECT id FROM dated WHERE id NOT IN (SELECT id FROM picked) ORDER BY md5('43:' || id)
         LIMIT (SELECT 300 - sum(quota) FROM q)),
sample AS (SELECT id, author FROM dated WHERE id IN (SELECT id FROM picked UNION ALL SELECT id FROM rest))"""


def _sample(spark, sf):
    rows = dated_articles(spark, sf).select("id", "author")
    return sp.stratified_sample(rows, "author", 300)


@register("G1 C3", with_sql(DATED, _SAMPLE + " SELECT * FROM sample"))
def fit_sample(spark, sf):
    """Proportional sample by author; articles without author enter through the top-up."""
    return _sample(spark, sf)


@register("C3", with_sql(DATED, _SAMPLE + " SELECT id, author FROM dated ANTI JOIN sample USING (id)"))
def outside_fit_sample(spark, sf):
    rows = dated_articles(spark, sf).select("id", "author")
    return rows.join(_sample(spark, sf).select("id"), "id", "left_anti")


SPLIT = """, c AS (SELECT lang, count(*) AS n FROM articles GROUP BY 1),
t AS (SELECT sum(n) AS total, sum(n) - ceil(0.2::DOUBLE * sum(n)) AS train_total FROM c),
s AS (SELECT lang, n, n / total * train_total AS exact, floor(n / total * train_total) AS base, train_total FROM c, t),
q AS (SELECT lang, n, base + CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, lang)
             <= train_total - sum(base) OVER () THEN 1 ELSE 0 END AS n_train FROM s),
split AS (SELECT id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || id)) <= n - n_train AS is_test
          FROM articles JOIN q USING (lang))"""


def split(spark, sf):
    return sp.stratified_split(articles(spark, sf).select("id", "lang"), "lang")


@register("G2", with_sql(ARTICLES, SPLIT + " SELECT * FROM split"))
def train_test_split(spark, sf):
    """Exact 80/20 split by language."""
    return split(spark, sf)


@register("J9", with_sql(ARTICLES, SPLIT + " SELECT id, lang FROM split WHERE is_test"))
def held_out_articles(spark, sf):
    """The stored split, held-out side."""
    path = scratch_path(spark, "split")
    split(spark, sf).write.parquet(path)
    return sp.test_set(spark.read.parquet(path))


@register(
    "G5 D2",
    with_sql(
        ARTICLES,
        SPLIT
        + """, b AS (SELECT lang, count(*) FILTER (NOT is_test) AS train_n, count(*) FILTER (is_test) AS test_n FROM split GROUP BY 1)
        SELECT *, round(100.0 * train_n / sum(train_n) OVER (), 1) AS train_pct,
               round(100.0 * test_n / sum(test_n) OVER (), 1) AS test_pct FROM b""",
    ),
)
def split_proportions(spark, sf):
    return sp.split_balance(split(spark, sf), "lang")


@register("G3", with_sql(ARTICLES, "SELECT id, title, publication FROM articles ORDER BY md5('7:' || id) LIMIT 250"))
def plain_sample(spark, sf):
    return sp.sample_n(articles(spark, sf).select("id", "title", "publication"), 250, seed=7)


@register(
    "G4",
    with_sql(ARTICLES, SPLIT + " SELECT id FROM split WHERE NOT is_test ORDER BY md5('42:' || id) LIMIT 100"),
)
def background_documents(spark, sf):
    return sp.background_ids(split(spark, sf), 100)


@register("G6", with_sql(ARTICLES, "SELECT id, publication FROM articles ORDER BY md5('42:' || id)"))
def shuffled_articles(spark, sf):
    return sp.shuffle(articles(spark, sf).select("id", "publication"))


@register(
    "I1",
    "SELECT doc_id AS id, source, (dense_rank() OVER (ORDER BY source) - 1)::INTEGER AS label_idx, source AS decoded FROM documents",
)
def encoded_outlets(spark, sf):
    """Labels to consecutive numbers and back."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source")
    labels = md.label_table(docs, "source")
    coded = md.encode_labels(docs, labels, "source")
    back = labels.withColumnRenamed("source", "decoded")
    return md.decode_labels(coded, back, "decoded", "label_idx")


@register(
    "C1",
    with_sql(
        tfidf_sql(**FULL),
        """SELECT f.id, l.quality, f.term_id, round(f.tfidf, 6) AS tfidf
           FROM features f JOIN labels l ON l.doc_id = f.id""",
    ),
)
def labelled_feature_rows(spark, sf):
    """Features of the labelled documents only."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    rows = weights(spark, sf, **FULL)[2].select("id", "term_id", F.round("tfidf", 6).alias("tfidf"))
    return md.labelled_features(labels, rows)


@register(
    "C4",
    with_sql(
        ARTICLES,
        """SELECT id, publication FROM articles SEMI JOIN (
             SELECT publication FROM articles GROUP BY 1 ORDER BY count(*) DESC, publication LIMIT 8) USING (publication)""",
    ),
)
def articles_of_biggest_outlets(spark, sf):
    rows = articles(spark, sf).select("id", "publication")
    biggest = (
        rows.groupBy("publication")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "publication")
        .limit(8)
    )
    return rows.join(biggest, "publication", "left_semi")


@register(
    "A3 A5",
    with_sql(ARTICLES, "SELECT id, title, publication, content, lang FROM articles WHERE id = (SELECT max(doc_id) // 2 FROM documents)"),
)
def article_by_id(spark, sf):
    """Lookup in a table stored in key order; the key filter reaches the file footers."""
    path = scratch_path(spark, "articles")
    tb.write_table(articles(spark, sf), path)
    middle = table(spark, sf, "documents").agg(F.floor(F.max("doc_id") / 2)).scalar()
    return tb.lookup(spark, path, "id", middle)


@register(
    "E2 C2",
    with_sql(
        ARTICLES,
        """, r AS (SELECT publication, lang, count(*) AS n FROM articles GROUP BY 1, 2)
        SELECT publication, lang, n, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY publication ORDER BY n DESC, lang)::INTEGER AS rank FROM r) WHERE rank <= 2""",
    ),
)
def main_languages_of_outlets(spark, sf):
    counts = articles(spark, sf).groupBy("publication", "lang").agg(F.count(F.lit(1)).alias("n"))
    return top_n_per_group(counts, "publication", [F.desc("n"), "lang"], 2)
