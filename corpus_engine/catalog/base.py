"""Registry of named queries, the article view of the given tables, and shared SQL for the checks.

Articles are made of the given tables: ``documents`` supply id, content and outlet (``source``); a
first line followed by more text is the title; ``labels`` supply an author (null for unlabelled
documents) and ``orders`` a date text in two formats (null for pending orders).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.functions.stopwords import ENGLISH
from corpus_engine.operators.clean import clean, drop_short, preprocess
from corpus_engine.session import scratch_path, spread

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    covers: str


REGISTRY: dict[str, Entry] = {}


def register(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under its function name; ``covers`` lists the inventory rows it exercises."""

    def add(run: Query) -> Query:
        if run.__name__ in REGISTRY:
            raise ValueError(f"query {run.__name__} registered twice")
        REGISTRY[run.__name__] = Entry(run, sql, covers)
        return run

    return add


# --- Spark side -------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, title, publication, content, lang`` of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return spread(docs, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.when(F.instr("text", "\n") > 0, F.substring_index("text", "\n", 1)).alias("title"),
        F.col("source").alias("publication"),
        F.col("text").alias("content"),
        "lang",
    )


def dated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with author and date text, both with nulls."""
    authors = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, "staff").when(F.col("quality") == 0, "wire").alias("author"),
    )
    day = F.col("o_orderdate")
    dates = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy/MM/dd"))
        .alias("date"),
    )
    return (
        articles(spark, sf_dir)
        .join(authors, "id", "left")
        .join(dates, "id", "left")
        .select("id", "title", "publication", "author", "date", "content")
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles without missing parts, repeats and stubs."""
    return drop_short(clean(articles(spark, sf_dir), order=("id",)))


def prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned articles with ``text_clean``."""
    return preprocess(cleaned(spark, sf_dir))


_STORED: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A table that several queries start from: computed once per application and folder, written
    to the shared folder, and read from there."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared corpus as a stored table."""
    return stored(spark, sf_dir, "prepared", lambda: prepare(spark, sf_dir))


# --- DuckDB side ------------------------------------------------------------------------------

def with_sql(ctes: str, body: str) -> str:
    """A statement from CTEs and a body; the body may add CTEs of its own, comma first."""
    body = body.strip()
    glue = "" if body.startswith(",") else "\n"
    return f"WITH {ctes.strip()}{glue}{body}"


STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + ")"


def normalize_sql(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({text}), '(http|www)\\S+', ' ', 'g'), "
        "'[^a-z]+', ' ', 'g'))"
    )


def words_sql(normalized: str) -> str:
    return (
        f"list_filter(string_split({normalized}, ' '), "
        f"lambda w: length(w) > 1 AND w NOT IN {STOP_SQL})"
    )


ARTICLES = """
articles AS (
  SELECT doc_id AS id,
         CASE WHEN strpos(text, chr(10)) > 0 THEN split_part(text, chr(10), 1) END AS title,
         source AS publication, text AS content, lang
  FROM documents)"""

DATED = (
    ARTICLES
    + """,
dated AS (
  SELECT a.id, a.title, a.publication,
         CASE l.quality WHEN 1 THEN 'staff' WHEN 0 THEN 'wire' END AS author,
         CASE o.o_orderstatus WHEN 'F' THEN strftime(o.o_orderdate, '%Y-%m-%d')
                              WHEN 'O' THEN strftime(o.o_orderdate, '%Y/%m/%d') END AS date,
         a.content
  FROM articles a LEFT JOIN labels l ON l.doc_id = a.id LEFT JOIN orders o ON o.o_orderkey = a.id)"""
)

CLEANED = (
    ARTICLES
    + """,
deduped AS (
  SELECT id, title, publication, content, lang FROM (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY id) AS rn
    FROM articles WHERE content IS NOT NULL AND title IS NOT NULL)
  WHERE rn = 1),
cleaned AS (SELECT * FROM deduped WHERE length(content) >= 200)"""
)

PREPARED = (
    CLEANED
    + f""",
worded AS (
  SELECT *, {words_sql(normalize_sql("CASE WHEN title = '' THEN content ELSE title || ' ' || content END"))} AS words
  FROM cleaned),
prepared AS (SELECT *, array_to_string(words, ' ') AS text_clean FROM worded)"""
)


def vocab_sql(
    min_df: int = 5, max_df: float = 0.95, max_features: int = 50_000, bigrams: bool = True
) -> str:
    """CTEs ``tf(id, term, tf)`` and ``vocab``."""
    pairs = (
        """ UNION ALL
  SELECT id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS term
  FROM worded"""
        if bigrams
        else ""
    )
    return (
        PREPARED
        + f""",
grams AS (SELECT id, unnest(words) AS term FROM worded{pairs}),
tf AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY id, term),
size AS (SELECT count(*) AS n FROM prepared),
terms AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS corpus_tf FROM tf GROUP BY term),
kept AS (SELECT term, df, corpus_tf FROM terms
         WHERE df >= {min_df} AND df <= {max_df} * (SELECT n FROM size)
         ORDER BY corpus_tf DESC, term LIMIT {max_features}),
vocab AS (SELECT (row_number() OVER (ORDER BY term) - 1)::INTEGER AS term_id, term, df, corpus_tf,
                 ln((1 + (SELECT n FROM size)) / (1 + df)) + 1 AS idf FROM kept)"""
    )


def tfidf_sql(sublinear: bool = True, **limits) -> str:
    """CTEs down to ``features(id, term_id, term, tf, tfidf)``."""
    tf = "(1 + ln(tf))" if sublinear else "tf"
    return (
        vocab_sql(**limits)
        + f""",
weighted AS (SELECT id, term_id, term, tf, {tf} * idf AS w FROM tf JOIN vocab USING (term)),
features AS (SELECT id, term_id, term, tf::INTEGER AS tf,
                    w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS tfidf FROM weighted)"""
    )
