"""Queries over scans, sinks, cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_engine.catalog.base import (
    ARTICLES,
    CLEANED,
    DATED,
    PREPARED,
    articles,
    cleaned,
    dated_articles,
    prepared,
    register,
    table,
    with_sql,
)
from corpus_engine.functions import text as tx
from corpus_engine.operators import clean as cl
from corpus_engine.operators import profile as pf
from corpus_engine.operators import quality as ql
from corpus_engine.operators.quantiles import quantiles
from corpus_engine.operators import topk
from corpus_engine.session import scratch_path
from corpus_engine.sources import articles as src
from corpus_engine.sources import tables as tb


# --- scans and sinks ---------------------------------------------------------------------------


@register("A1 N1", with_sql(DATED, "SELECT id, title, publication, author, date, content, 0 AS file_rank FROM dated"))
def csv_scan(spark, sf):
    """Articles written to CSV and read back through the CSV reader."""
    path = scratch_path(spark, "articles-csv")
    dated_articles(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return src.read_articles_csv(spark, [path])


@register(
    "A2",
    "SELECT doc_id, CASE WHEN lang NOT IN ('es', 'NA') THEN lang END AS lang, "
    "CASE WHEN source NOT IN ('es', 'NA') THEN source END AS source FROM documents",
)
def null_tokens(spark, sf):
    """Chosen cell texts become null."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return src.nullify_tokens(docs, ["lang", "source"], ["es", "NA"])


@register("A3 A5", with_sql(ARTICLES, "SELECT id, title, publication, content, lang FROM articles"))
def stored_articles(spark, sf):
    """Article table written range-sorted by id and read back."""
    path = scratch_path(spark, "articles")
    tb.write_table(articles(spark, sf), path)
    return spark.read.parquet(path)


@register("A4", with_sql(ARTICLES, "SELECT id, title, publication, content FROM articles"))
def projected_scan(spark, sf):
    return articles(spark, sf).select("id", "title", "publication", "content")


@register("A12")
def schema_table(spark, sf):
    return src.describe_schema(dated_articles(spark, sf))


@register(
    "N1",
    """SELECT doc_id AS id, source AS publication, text AS content, 0 AS file_rank FROM documents
       UNION ALL SELECT conv_id, NULL, text, 1 FROM conversations
       UNION ALL SELECT item_id, NULL, text, 2 FROM benchmark""",
)
def union_of_sources(spark, sf):
    """Three sources under one another by column name; a missing column is null."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("publication"), F.col("text").alias("content"),
        F.lit(0).alias("file_rank"),
    )
    talks = table(spark, sf, "conversations").select(
        F.col("text").alias("content"), F.col("conv_id").alias("id"), F.lit(1).alias("file_rank")
    )
    bench = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text").alias("content"), F.lit(2).alias("file_rank")
    )
    return src.union_all([docs, talks, bench])


# --- cleaning ----------------------------------------------------------------------------------


@register(
    "B1 B9",
    with_sql(DATED, "SELECT id, title, publication, author, date, content FROM dated WHERE title IS NOT NULL AND content IS NOT NULL"),
)
def complete_articles(spark, sf):
    """Rows with title and content; author and date may be null."""
    return cl.drop_missing(dated_articles(spark, sf))


@register(
    "E1",
    """WITH whole AS (
         SELECT doc_id AS id, source AS publication, text AS content, 0 AS file_rank FROM documents
         UNION ALL SELECT conv_id * 1000 + turn, NULL, text, 1 FROM conversations)
       SELECT id, publication, content, file_rank FROM (
         SELECT *, row_number() OVER (PARTITION BY content ORDER BY file_rank, id) AS rn FROM whole) WHERE rn = 1""",
)
def first_of_each_text(spark, sf):
    """Keep-first de-duplication over two sources in file order."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("publication"), F.col("text").alias("content"),
        F.lit(0).alias("file_rank"),
    )
    talks = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("content"),
        F.lit(1).alias("file_rank"),
    )
    return cl.dedup_keep_first(src.union_all([docs, talks]))


@register("B1 B2 E1", with_sql(CLEANED, "SELECT id, title, publication, content, lang FROM cleaned"))
def clean_corpus(spark, sf):
    return cleaned(spark, sf)


@register(
    "D15",
    with_sql(
        ARTICLES,
        """, c AS (SELECT count(*) AS raw, count(content) AS content,
                 count(*) FILTER (content IS NOT NULL AND title IS NOT NULL) AS title,
                 count(DISTINCT CASE WHEN title IS NOT NULL THEN content END) AS uniq FROM articles)
        SELECT 1 AS step, 'raw' AS stage, raw AS rows, 0::BIGINT AS removed FROM c
        UNION ALL SELECT 2, 'drop null content', content, raw - content FROM c
        UNION ALL SELECT 3, 'drop null title', title, content - title FROM c
        UNION ALL SELECT 4, 'drop duplicates', uniq, title - uniq FROM c""",
    ),
)
def cleaning_log(spark, sf):
    return cl.cleaning_report(articles(spark, sf))


@register("B2", with_sql(ARTICLES, "SELECT id, title, publication, content, lang FROM articles WHERE length(content) >= 200"))
def without_stubs(spark, sf):
    return cl.drop_short(articles(spark, sf))


@register(
    "B3",
    with_sql(ARTICLES, "SELECT id, title, publication, length(content)::INTEGER AS content_len, content FROM articles WHERE length(content) < 200"),
)
def stub_listing(spark, sf):
    return cl.short_articles(articles(spark, sf))


@register(
    "B4",
    with_sql(ARTICLES, "SELECT id, CASE WHEN coalesce(title, '') = '' THEN content ELSE title || ' ' || content END AS combined FROM articles"),
)
def combined_text(spark, sf):
    return articles(spark, sf).select(
        "id", tx.combine_text(F.col("title"), F.col("content")).alias("combined")
    )


@register(
    "B6 E9",
    with_sql(
        ARTICLES,
        """SELECT id, publication, title, length(content)::INTEGER AS content_len FROM articles
           WHERE publication IN ('src0', 'src7', 'src13') ORDER BY content_len, id LIMIT 5""",
    ),
)
def shortest_of_outlets(spark, sf):
    return cl.shortest_articles(articles(spark, sf), ["src0", "src7", "src13"], 5)


@register(
    "B8",
    with_sql(
        PREPARED,
        """SELECT id,
             CASE WHEN length(content) > 200 THEN left(content, 200) || '...' ELSE content END AS content_preview,
             CASE WHEN length(text_clean) > 80 THEN left(text_clean, 80) || '...' ELSE text_clean END AS text_clean_preview
           FROM prepared""",
    ),
)
def text_previews(spark, sf):
    shown = cl.with_preview(prepared(spark, sf), "content", 200)
    return cl.with_preview(shown, "text_clean", 80).select(
        "id", "content_preview", "text_clean_preview"
    )


# --- profiling ---------------------------------------------------------------------------------


@register("D1 E8", with_sql(ARTICLES, "SELECT publication, count(*) AS n FROM articles WHERE publication IS NOT NULL GROUP BY 1"))
def articles_per_outlet(spark, sf):
    return pf.value_counts(articles(spark, sf), "publication")


@register(
    "D2",
    "SELECT event_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM events GROUP BY 1",
)
def event_shares(spark, sf):
    return pf.value_counts(table(spark, sf, "events"), "event_type", normalize=True)


@register(
    "D3",
    with_sql(ARTICLES, "SELECT publication, count(*) AS article_count, round(avg(length(content)), 0) AS avg_content_chars FROM articles GROUP BY 1"),
)
def outlet_stats(spark, sf):
    return pf.publication_stats(articles(spark, sf))


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM dated"
    for c in ("id", "title", "publication", "author", "date", "content")
)


@register("D4", with_sql(DATED, _NULLS))
def nulls_per_column(spark, sf):
    return pf.null_profile(dated_articles(spark, sf))


@register(
    "D5",
    with_sql(
        DATED,
        f"""SELECT "column", round(100.0 * nulls / (SELECT count(*) FROM dated), 1) AS null_pct
            FROM ({_NULLS}) WHERE nulls > 0""",
    ),
)
def null_percentages(spark, sf):
    return pf.null_profile(dated_articles(spark, sf), pct=True)


@register("D6", with_sql(DATED, "SELECT publication, count(*) AS missing FROM dated WHERE author IS NULL GROUP BY 1"))
def missing_authors(spark, sf):
    return pf.missing_by(dated_articles(spark, sf), "author", "publication")


def _histogram_sql(value: str, source: str, clip: str = "") -> str:
    return f"""
    WITH v AS (SELECT ({value})::DOUBLE AS x FROM {source}{clip}),
    span AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    filled AS (SELECT least(floor(100 * (x - lo) / (hi - lo))::INTEGER + 1, 100) AS bin, count(*) AS n
               FROM v, span WHERE x IS NOT NULL GROUP BY 1)
    SELECT g.bin::INTEGER AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 100), 4) AS lower,
           round(lo + g.bin * ((hi - lo) / 100), 4) AS upper, coalesce(n, 0) AS n
    FROM range(1, 101) g(bin) CROSS JOIN span LEFT JOIN filled f ON f.bin = g.bin"""


@register("D7", _histogram_sql("length(text)", "documents"))
def length_histogram(spark, sf):
    return pf.histogram(articles(spark, sf), F.length("content"))


@register("D7 B7", _histogram_sql("length(text)", "documents", " WHERE length(text) <= 10000"))
def length_histogram_zoomed(spark, sf):
    return pf.histogram(articles(spark, sf), F.length("content"), max_value=10_000)


@register(
    "D8 B7",
    """WITH l AS (SELECT source AS publication, length(text) AS x FROM documents),
    q AS (SELECT publication, quantile_cont(x, 0.5) AS median_all,
                 quantile_cont(x, 0.25) FILTER (x <= 15000) AS q1, quantile_cont(x, 0.5) FILTER (x <= 15000) AS median,
                 quantile_cont(x, 0.75) FILTER (x <= 15000) AS q3 FROM l GROUP BY 1)
    SELECT publication, median_all, q1, median, q3,
           min(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::INTEGER AS whisker_low,
           max(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::INTEGER AS whisker_high,
           count(*) FILTER (x NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM q JOIN l USING (publication) WHERE x <= 15000 GROUP BY 1, 2, 3, 4, 5""",
)
def length_boxplots(spark, sf):
    return pf.boxplot_stats(articles(spark, sf), "publication", F.length("content"), 15_000)


@register("D9", "SELECT source AS publication, median(length(text)) AS median FROM documents GROUP BY 1")
def median_length_by_outlet(spark, sf):
    return pf.median_by(articles(spark, sf), "publication", F.length("content"))


@register(
    "D10",
    "SELECT min(length(text))::INTEGER AS min_len, median(length(text)) AS median_len, max(length(text))::INTEGER AS max_len FROM documents",
)
def length_range(spark, sf):
    return pf.length_summary(articles(spark, sf))


@register(
    "D11",
    """SELECT count(*) AS count, round(avg(length(text)), 4) AS mean, round(stddev_samp(length(text)), 4) AS std,
              min(length(text))::INTEGER AS min, quantile_cont(length(text), 0.25) AS q25,
              quantile_cont(length(text), 0.5) AS q50, quantile_cont(length(text), 0.75) AS q75,
              max(length(text))::INTEGER AS max FROM documents""",
)
def length_description(spark, sf):
    out = pf.describe_numeric(articles(spark, sf), F.length("content"))
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@register(
    "D9 D11",
    """SELECT o_orderpriority, unnest([0.05, 0.5, 0.95]) AS share,
              round(unnest(quantile_cont(o_totalprice, [0.05, 0.5, 0.95])), 4) AS quantile FROM orders GROUP BY 1""",
)
def order_value_quantiles(spark, sf):
    """How order values are spread, per priority: exact quantiles of a column whose values hardly repeat."""
    out = quantiles(table(spark, sf, "orders"), F.col("o_totalprice"), [0.05, 0.5, 0.95], "o_orderpriority")
    return out.select("o_orderpriority", "share", F.round("quantile", 4).alias("quantile"))


@register(
    "D9 D11",
    """SELECT event_type, quantile_cont(value, 0.5) AS median FROM events GROUP BY 1""",
)
def median_event_values(spark, sf):
    out = quantiles(table(spark, sf, "events"), F.col("value"), [0.5], "event_type")
    return out.select("event_type", F.col("quantile").alias("median"))


def _months_sql(source: str, day: str) -> str:
    return f"""m AS (SELECT date_trunc('month', {day})::DATE AS first_day, count(*) AS n FROM {source}
      WHERE {day} IS NOT NULL GROUP BY 1),
    g AS (SELECT unnest(generate_series((SELECT min(first_day) FROM m)::TIMESTAMP,
                 (SELECT max(first_day) FROM m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS first_day)
    SELECT last_day(first_day) AS month_end, coalesce(n, 0) AS n FROM g LEFT JOIN m USING (first_day)"""


_DAY = "coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%Y/%m/%d'))"


@register("D12", with_sql(DATED, ", " + _months_sql("dated", _DAY)))
def articles_per_month(spark, sf):
    """Months between first and last article, empty ones included; dates come in two formats."""
    return pf.monthly_counts(dated_articles(spark, sf), "date")


@register("D12", "WITH " + _months_sql("(SELECT o_orderdate AS d FROM orders)", "d"))
def orders_per_month(spark, sf):
    """All orders."""
    return pf.monthly_counts(table(spark, sf, "orders"), "o_orderdate")


@register(
    "D13 D14 D19 D21",
    with_sql(
        DATED,
        f"""SELECT count(*) AS total_articles, count(DISTINCT publication) AS publications,
             min({_DAY})::DATE AS first_date, max({_DAY})::DATE AS last_date,
             median(length(content)) AS median_length, count(*) FILTER (length(content) < 200) AS short_articles,
             count(*) FILTER (author IS NULL) AS missing_author,
             round(100.0 * count(*) FILTER (author IS NULL) / count(*), 1) AS missing_author_pct,
             count(*) FILTER (date IS NULL) AS missing_date,
             round(100.0 * count(*) FILTER (date IS NULL) / count(*), 1) AS missing_date_pct FROM dated""",
    ),
)
def corpus_overview(spark, sf):
    return pf.corpus_summary(dated_articles(spark, sf))


@register("D16", "SELECT (count(*) - count(DISTINCT text))::BIGINT AS duplicates FROM documents")
def repeated_contents(spark, sf):
    return pf.duplicate_count(articles(spark, sf), ["content"])


@register(
    "D18",
    """SELECT count(*) AS classes, max(n) AS max_count, min(n) AS min_count, round(max(n) / min(n), 4) AS imbalance_ratio
       FROM (SELECT count(*) AS n FROM documents GROUP BY lang)""",
)
def language_balance(spark, sf):
    return pf.class_balance(articles(spark, sf), "lang")


@register(
    "E2",
    """SELECT publication, rank, id, content_len FROM (
         SELECT source AS publication, doc_id AS id, length(text)::INTEGER AS content_len,
                row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id)::INTEGER AS rank
         FROM documents) WHERE rank <= 5""",
)
def longest_per_outlet(spark, sf):
    rows = articles(spark, sf).select("publication", "id", F.length("content").alias("content_len"))
    return topk.top_n_per_group(rows, "publication", [F.desc("content_len"), "id"], 5)


@register(
    "E7 E8",
    """SELECT source AS publication, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct
       FROM documents GROUP BY 1""",
)
def outlet_shares(spark, sf):
    shares = topk.with_share(pf.value_counts(articles(spark, sf), "publication"), "n", "pct", 100.0)
    return shares.withColumn("pct", F.round("pct", 6))


@register("E9", with_sql(ARTICLES, "SELECT id, title, publication FROM articles ORDER BY id LIMIT 20"))
def first_articles(spark, sf):
    return articles(spark, sf).select("id", "title", "publication").orderBy("id").limit(20)


# --- quality -----------------------------------------------------------------------------------


@register(
    "L1",
    with_sql(
        DATED,
        r"""SELECT id, 'title_blank' AS rule, 'no title is given' AS message FROM dated
           WHERE title IS NULL OR NOT regexp_matches(title, '\S')
           UNION ALL SELECT id, 'publication_blank', 'no outlet is named' FROM dated
           WHERE publication IS NULL OR NOT regexp_matches(publication, '\S')
           UNION ALL SELECT id, 'content_short', 'content too short' FROM dated WHERE coalesce(length(content), 0) < 40""",
    ),
)
def contract_violations(spark, sf):
    return ql.validate_articles(dated_articles(spark, sf), min_content=40)


@register("L2", "SELECT conv_id AS id, count(*) AS n FROM conversations GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf):
    talks = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"))
    return ql.duplicate_keys(talks)


@register(
    "L3",
    with_sql(
        ARTICLES,
        """, o AS (SELECT count(*)::DOUBLE AS rows, count(*) FILTER (title IS NULL)::DOUBLE AS nt,
                   count(*) FILTER (content IS NULL)::DOUBLE AS nc, (count(*) - count(DISTINCT content))::DOUBLE AS dup,
                   median(length(content))::DOUBLE AS med FROM articles)
        SELECT 'row_count' AS "check", rows AS observed, 100::DOUBLE AS lo, 1e9::DOUBLE AS hi, rows BETWEEN 100 AND 1e9 AS passed FROM o
        UNION ALL SELECT 'null_title', nt, 0, 0, nt BETWEEN 0 AND 0 FROM o
        UNION ALL SELECT 'null_content', nc, 0, 0, nc BETWEEN 0 AND 0 FROM o
        UNION ALL SELECT 'duplicate_content', dup, 0, 0, dup BETWEEN 0 AND 0 FROM o
        UNION ALL SELECT 'median_length', med, 1000, 10000, med BETWEEN 1000 AND 10000 FROM o""",
    ),
)
def table_expectations(spark, sf):
    return ql.expect_table(articles(spark, sf), {"row_count": (100, 1e9)})


@register(
    "L4 N2 N3",
    """SELECT publication FROM (VALUES ('src0'), ('src5'), ('src19'), ('src20'), ('src99')) e(publication)
       EXCEPT SELECT source FROM documents""",
)
def absent_outlets(spark, sf):
    return ql.missing_values(articles(spark, sf), "publication", ["src0", "src5", "src19", "src20", "src99"])


@register("N3", "SELECT DISTINCT lang FROM documents")
def languages(spark, sf):
    return articles(spark, sf).select("lang").distinct()


@register("N2", "SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels")
def unlabelled_documents(spark, sf):
    """Documents without a label: set difference on the key."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return docs.subtract(table(spark, sf, "labels").select(F.col("doc_id").alias("id")))


@register("N4", "SELECT DISTINCT doc_id AS id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def labels_without_document(spark, sf):
    """Subset test: empty when every label belongs to a document."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return ql.is_subset(table(spark, sf, "labels").select(F.col("doc_id").alias("id")), docs, "id")


@register(
    "L6",
    with_sql(
        PREPARED,
        """SELECT 'text_clean' AS "column", count(*) FILTER (text_clean IS NULL) AS nulls FROM prepared
           UNION ALL SELECT 'title', count(*) FILTER (title IS NULL) FROM prepared""",
    ),
)
def required_columns(spark, sf):
    return ql.require_columns(prepared(spark, sf), ["text_clean", "title"])
