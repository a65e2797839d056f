"""Queries over text preparation, vocabulary and TF-IDF features."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_engine.catalog.base import (
    ARTICLES,
    PREPARED,
    STOP_SQL,
    articles,
    normalize_sql,
    prepare,
    prepared,
    register,
    stored,
    table,
    tfidf_sql,
    vocab_sql,
    with_sql,
    words_sql,
)
from corpus_engine.functions import text as tx
from corpus_engine.functions.stopwords import stopwords_df
from corpus_engine.operators import clean as cl
from corpus_engine.operators import features as ft
from corpus_engine.operators import quality as ql
from corpus_engine.session import scratch_path, spread
from corpus_engine.sources import tables as tb

# limits that bind on the given tables
SMALL = {"min_df": 5, "max_df": 0.3, "max_features": 5_000}
FULL = {"min_df": 5, "max_df": 0.95, "max_features": 50_000}


def vocabulary(spark, sf, **limits):
    return ft.fit_vocabulary(prepared(spark, sf).select("id", "text_clean"), **limits)


def stored_vocab(spark, sf, **limits):
    """The fitted vocabulary as a stored table, as scoring and training use it."""
    name = "-".join(["vocab", *(f"{k}{v}" for k, v in sorted(limits.items()))])
    return stored(spark, sf, name, lambda: vocabulary(spark, sf, **limits))


def weights(spark, sf, **limits):
    """Documents, vocabulary and TF-IDF rows of the prepared corpus."""
    docs = prepared(spark, sf).select("id", "text_clean")
    vocab = stored_vocab(spark, sf, **limits)
    return docs, vocab, ft.tfidf(docs, vocab)


# --- text --------------------------------------------------------------------------------------


@register("F1", with_sql(ARTICLES, f"SELECT id, {normalize_sql('content')} AS normalized FROM articles"))
def normalized_text(spark, sf):
    return articles(spark, sf).select("id", tx.normalize_text(F.col("content")).alias("normalized"))


@register("F1", f"SELECT page_id, {normalize_sql('html')} AS normalized FROM pages")
def normalized_pages(spark, sf):
    """Whole raw pages, links included."""
    pages = spread(table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", tx.normalize_text(F.col("html")).alias("normalized"))


@register("F2", with_sql(ARTICLES, f"SELECT id, array_to_string({words_sql(normalize_sql('content'))}, ' ') AS cleaned FROM articles"))
def cleaned_text(spark, sf):
    return articles(spark, sf).select("id", tx.clean_text(F.col("content")).alias("cleaned"))


@register("F3", with_sql(PREPARED, "SELECT id, title, publication, text_clean FROM prepared"))
def prepared_corpus(spark, sf):
    return prepare(spark, sf).select("id", "title", "publication", "text_clean")


# what the trace takes for white space, spelt out because the other engine's class is ASCII only
_SPACES = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

_TRACE = f""", s1 AS (SELECT id, lower(content) AS lowercased FROM articles),
s2 AS (SELECT *, regexp_replace(lowercased, '(http|www)\\S+', ' ', 'g') AS urls_removed FROM s1),
s3 AS (SELECT *, regexp_replace(urls_removed, '[^a-z{_SPACES}]', ' ', 'g') AS alpha_only FROM s2),
s4 AS (SELECT *, trim(regexp_replace(alpha_only, '[{_SPACES}]+', ' ', 'g')) AS squeezed FROM s3)
SELECT *, array_to_string({words_sql('squeezed')}, ' ') AS cleaned,
       array_to_string(list_filter(string_split(squeezed, ' '), lambda w: w IN {STOP_SQL}), ' ') AS removed_stopwords
FROM s4"""


@register("F4", with_sql(ARTICLES, _TRACE))
def preparation_trace(spark, sf):
    """Every stage of the preparation of every article."""
    stages = cl.preprocess_trace(articles(spark, sf).select("id", "content")).drop("content")
    return stages.withColumn("removed_stopwords", F.array_join("removed_stopwords", " "))


@register(
    "F4 F5",
    with_sql(
        ARTICLES,
        f""", w AS (SELECT unnest(string_split({normalize_sql('content')}, ' ')) AS word FROM articles),
        n AS (SELECT word, count(*) AS n FROM w GROUP BY 1)
        SELECT s.word, coalesce(n, 0) AS removed FROM (SELECT unnest([{STOP_SQL[1:-1]}]) AS word) s LEFT JOIN n USING (word)""",
    ),
)
def removed_stopwords(spark, sf):
    """Every stopword of the list and how often it is removed from the corpus."""
    traced = articles(spark, sf).select(
        F.explode(F.split(tx.normalize_text(F.col("content")), " ")).alias("word")
    )
    counts = traced.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return (
        stopwords_df(spark)
        .join(counts, "word", "left")
        .select("word", F.coalesce("n", F.lit(0)).alias("removed"))
        .orderBy("word")
    )


@register(
    "F6",
    with_sql(
        PREPARED,
        """SELECT id, len(words) + greatest(len(words) - 1, 0) AS grams,
             md5(array_to_string(list_concat(words, list_transform(range(1, len(words)),
                 lambda i: words[i] || ' ' || words[i + 1])), '|')) AS digest FROM worded""",
    ),
)
def word_pairs(spark, sf):
    """Words and word pairs of every article, as count and digest of the sequence."""
    words = prepared(spark, sf).select("id", F.filter(F.split("text_clean", " "), lambda w: w != "").alias("w"))
    grams = words.select("id", tx.ngrams(F.col("w"), 1, 2).alias("g"))
    return grams.select(
        "id", F.size("g").cast("bigint").alias("grams"), F.md5(F.array_join("g", "|")).alias("digest")
    )


@register(
    "F13",
    with_sql(
        ARTICLES,
        rf""", w AS (SELECT id, list_distinct(regexp_split_to_array(lower(title), '\s+')) AS tw,
                       regexp_split_to_array(lower(content), '\s+') AS cw FROM articles WHERE title IS NOT NULL),
        t AS (SELECT id, cw, unnest(list_filter(tw, lambda x: length(x) > 2 AND x NOT IN {STOP_SQL})) AS word FROM w),
        c AS (SELECT id, word, len(list_filter(cw, lambda x: x = word))::INTEGER AS in_content FROM t)
        SELECT id, word, in_content, in_content + 1 AS in_combined FROM c
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY in_content DESC, word) <= 8""",
    ),
)
def title_words_in_content(spark, sf):
    return cl.title_overlap(articles(spark, sf).filter(F.col("title").isNotNull()), 8)


# --- vocabulary --------------------------------------------------------------------------------

_VOCAB = "SELECT term_id, term, df, corpus_tf, round(idf, 6) AS idf FROM vocab"


@register("F7", with_sql(vocab_sql(), _VOCAB))
def vocabulary_default(spark, sf):
    return vocabulary(spark, sf).withColumn("idf", F.round("idf", 6))


@register("F7", with_sql(vocab_sql(**SMALL), _VOCAB))
def vocabulary_limited(spark, sf):
    """Document-frequency ceiling and term limit both bind."""
    return vocabulary(spark, sf, **SMALL).withColumn("idf", F.round("idf", 6))


@register("A7", with_sql(vocab_sql(**FULL), _VOCAB))
def stored_vocabulary(spark, sf):
    path = scratch_path(spark, "vocab")
    tb.write_vocab(vocabulary(spark, sf, **FULL), path)
    return tb.read_vocab(spark, path).withColumn("idf", F.round("idf", 6))


@register(
    "F11",
    with_sql(
        vocab_sql(),
        """SELECT count(*) AS terms, count(*) FILTER (strpos(term, ' ') = 0) AS unigrams,
                  count(*) FILTER (strpos(term, ' ') > 0) AS bigrams,
                  round(100.0 * count(*) FILTER (strpos(term, ' ') = 0) / count(*), 2) AS unigram_pct,
                  round(100.0 * count(*) FILTER (strpos(term, ' ') > 0) / count(*), 2) AS bigram_pct FROM vocab""",
    ),
)
def vocabulary_mix(spark, sf):
    return ft.vocab_composition(vocabulary(spark, sf))


@register(
    "F11",
    with_sql(vocab_sql(), "SELECT term FROM vocab WHERE strpos(term, ' ') > 0 ORDER BY md5('42:' || term) LIMIT 20"),
)
def some_word_pairs(spark, sf):
    return ft.sample_bigrams(vocabulary(spark, sf), 20, 42)


_PHRASES = ["und der", "les de", "thand", "white house", "interest rate"]


@register(
    "F12 C8",
    with_sql(
        vocab_sql(),
        f"""SELECT p.phrase, v.term IS NOT NULL AS in_vocabulary, v.df
            FROM (SELECT unnest({_PHRASES!r}) AS phrase) p LEFT JOIN vocab v ON v.term = p.phrase""",
    ),
)
def phrases_in_vocabulary(spark, sf):
    return ft.phrase_lookup(vocabulary(spark, sf), _PHRASES)


# --- weights -----------------------------------------------------------------------------------

_WEIGHTS = "SELECT id, term_id, term, tf, round(tfidf, 6) AS tfidf FROM features"


def _rounded(features):
    return features.withColumn("tfidf", F.round("tfidf", 6))


@register("F8 C8", with_sql(tfidf_sql(), _WEIGHTS))
def tfidf_weights(spark, sf):
    return _rounded(weights(spark, sf)[2])


@register(
    "F15",
    with_sql(tfidf_sql(sublinear=False, min_df=1, max_df=1.0, max_features=1_000_000_000, bigrams=False), _WEIGHTS),
)
def tfidf_plain(spark, sf):
    """Single words, linear counts, no limits on the vocabulary."""
    docs = prepared(spark, sf).select("id", "text_clean")
    vocab = ft.fit_vocabulary(docs, min_df=1, max_df=1.0, max_features=None, ngram_range=(1, 1))
    return _rounded(ft.tfidf(docs, vocab, (1, 1), sublinear=False))


def _new_documents(spark, sf):
    """Conversation turns, as documents the vocabulary has not seen."""
    talks = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    return spread(talks, "id").select("id", tx.clean_text(F.col("text")).alias("text_clean"))


_NEW = f""", new AS (SELECT conv_id * 1000 + turn AS id, {words_sql(normalize_sql('text'))} AS w FROM conversations),
ng AS (SELECT id, unnest(w) AS term FROM new UNION ALL
       SELECT id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM new),
nt AS (SELECT id, term, count(*) AS tf FROM ng GROUP BY 1, 2),
nw AS (SELECT id, term_id, term, tf::INTEGER AS tf, (1 + ln(tf)) * idf AS w FROM nt JOIN vocab USING (term)),
nf AS (SELECT id, term_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS tfidf FROM nw)"""


@register(
    "F9 C8",
    with_sql(
        vocab_sql() + _NEW,
        """SELECT n.id, count(f.term) AS terms, round(coalesce(sum(f.tfidf), 0), 4) AS total
           FROM new n LEFT JOIN nf f ON f.id = n.id GROUP BY n.id""",
    ),
)
def new_documents_profile(spark, sf):
    """Known terms and total weight of every new document, documents without any included."""
    new = _new_documents(spark, sf)
    found = ft.transform_tfidf(new, stored_vocab(spark, sf)).groupBy("id").agg(
        F.count("term_id").alias("terms"), F.round(F.coalesce(F.sum("tfidf"), F.lit(0.0)), 4).alias("total")
    )
    return found


@register("F9", with_sql(vocab_sql() + _NEW, "SELECT n.id, term_id, term, tf, round(tfidf, 6) AS tfidf FROM new n LEFT JOIN nf ON nf.id = n.id"))
def new_documents_weights(spark, sf):
    return _rounded(ft.transform_tfidf(_new_documents(spark, sf), stored_vocab(spark, sf)))


_PROFILE = """, c AS (SELECT (SELECT n FROM size) AS rows, (SELECT count(*) FROM vocab) AS features,
                            (SELECT count(*) FROM features) AS nnz)"""


@register(
    "F10",
    with_sql(
        tfidf_sql() + _PROFILE,
        "SELECT *, round(100.0 * (1 - nnz / (rows::DOUBLE * features)), 4) AS sparsity_pct FROM c",
    ),
)
def feature_matrix_profile(spark, sf):
    docs, vocab, rows = weights(spark, sf)
    return ft.matrix_profile(rows, vocab, docs)


@register(
    "L5 F10",
    with_sql(
        tfidf_sql(**FULL) + _PROFILE + """,
        o AS (SELECT rows::DOUBLE AS r, features::DOUBLE AS f, round(1 - nnz / (rows::DOUBLE * features), 6) AS s,
                     (SELECT round(min(tfidf), 6) FROM features) AS lo, (SELECT round(max(tfidf), 6) FROM features) AS hi FROM c)""",
        """SELECT 'rows' AS "check", r AS observed, 100::DOUBLE AS lo, NULL::DOUBLE AS hi, r >= 100 AS passed FROM o
           UNION ALL SELECT 'features', f, 100, 50000, f BETWEEN 100 AND 50000 FROM o
           UNION ALL SELECT 'sparsity', s, 0.95, 1, s BETWEEN 0.95 AND 1 FROM o
           UNION ALL SELECT 'min_weight', lo, 0, NULL, lo >= 0 FROM o
           UNION ALL SELECT 'max_weight', hi, NULL, 1, hi <= 1 FROM o""",
    ),
)
def feature_expectations(spark, sf):
    docs, vocab, rows = weights(spark, sf, **FULL)
    return ql.expect_features(rows, vocab, docs, {"rows": (100, None), "features": (100, 50_000)})


@register(
    "E5",
    with_sql(
        tfidf_sql(),
        """SELECT id, rank, term, round(round(tfidf, 9), 6) AS tfidf FROM (
             SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(tfidf, 9) DESC, term)::INTEGER AS rank FROM features)
           WHERE rank <= 15""",
    ),
)
def heaviest_terms(spark, sf):
    rows = weights(spark, sf)[2].withColumn("tfidf", F.round("tfidf", 9))
    return _rounded(ft.top_terms(rows, 15))


@register(
    "F16",
    with_sql(
        PREPARED,
        """, g AS (SELECT id, unnest(words) AS term FROM worded), c AS (SELECT DISTINCT count(*) AS n FROM g GROUP BY id, term)
        SELECT n AS "count", n / 100.0::DOUBLE AS linear, round(ln(1 + n), 6) AS damped FROM c""",
    ),
)
def count_damping(spark, sf):
    """Damped weight of every word count that occurs in a document."""
    rows = ft.term_rows(prepared(spark, sf).select("id", "text_clean"), ngram_range=(1, 1))
    return ft.damping_table(rows).withColumn("damped", F.round("damped", 6))


@register(
    "A6",
    with_sql(
        tfidf_sql(**FULL),
        """SELECT p.id, count(f.term_id) AS terms, round(coalesce(sum(f.tfidf), 0), 4) AS total,
                  coalesce(max(f.term_id), -1)::INTEGER AS last_term
           FROM prepared p LEFT JOIN features f ON f.id = p.id GROUP BY p.id""",
    ),
)
def stored_feature_matrix(spark, sf):
    """Feature rows stored as sparse structs and read back as ML vectors."""
    docs, vocab, rows = weights(spark, sf, **FULL)
    path = scratch_path(spark, "features")
    tb.write_features(ft.feature_structs(rows, docs, vocab), path)
    read = tb.read_features(spark, path).select("id", F.unwrap_udt("features").alias("v"))
    return read.select(
        "id",
        F.size("v.indices").cast("bigint").alias("terms"),
        F.round(F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        F.coalesce(F.array_max("v.indices"), F.lit(-1)).alias("last_term"),
    )
