"""Contracts of the text preparation."""

import pytest
from pyspark.sql import functions as F

from corpus_engine.functions import text as tx
from corpus_engine.functions.stopwords import ENGLISH, stopwords_df
from corpus_engine.operators import clean as cl


def cleaned(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return [r[0] for r in df.orderBy("id").select(tx.clean_text(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("The Harbour CRANE Stopped", "harbour crane stopped"),
        ("Maps at https://maps.test/a?b=1 for the walk", "maps walk"),
        ("see www.example.com/path?x=1 now and later", "see later"),
        ("Ships: 40 docked, twelve left!", "ships docked twelve left"),
        ("the dog is under a table", "dog table"),
        ("x y z green leaf", "green leaf"),
        ("", ""),
        ("the and or but is was", ""),
        ("green    leaf\t\n tree", "green leaf tree"),
        ("don't won't", ""),
        ("one https://a.b/c two", "one two"),
        ("one https://a.b/c\x1ctwo", "one two"),
        ("café zürich", "caf rich"),
    ],
)
def test_clean_text(spark, text, expected):
    assert cleaned(spark, text) == [expected]


def test_null_text_stays_null(spark):
    assert cleaned(spark, None) == [None]


def test_trace_ends_where_clean_text_ends(spark):
    texts = ["The Fed's interest-rate decision, see http://x.y/z!", "", "of the", "ABC 12"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")
    rows = cl.preprocess_trace(df).withColumn("direct", tx.clean_text(F.col("content"))).collect()
    assert all(r.cleaned == r.direct for r in rows)
    assert [r.removed_stopwords for r in rows if r.id == 2] == [["of", "the"]]


def test_combined_text(spark):
    df = spark.createDataFrame([("t", "c"), (None, "c"), ("", "c")], "title string, content string")
    got = [r[0] for r in df.select(tx.combine_text(F.col("title"), F.col("content"))).collect()]
    assert got == ["t c", "c", "c"]


@pytest.mark.parametrize(
    "words,low,high,expected",
    [
        (["x", "y", "z"], 1, 2, ["x", "y", "z", "x y", "y z"]),
        (["x", "y", "z"], 1, 3, ["x", "y", "z", "x y", "y z", "x y z"]),
        (["x", "y", "z"], 2, 2, ["x y", "y z"]),
        (["x"], 1, 2, ["x"]),
        ([], 1, 2, []),
    ],
)
def test_ngrams(spark, words, low, high, expected):
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(tx.ngrams(F.col("w"), low, high)).first()[0] == expected


def test_stopword_table(spark):
    words = [r.word for r in stopwords_df(spark).collect()]
    assert len(words) == len(set(words)) == len(ENGLISH) == 179
    assert words == sorted(words)


def test_preview_and_keywords(spark):
    df = spark.createDataFrame([("abcdef", "3_court_law_judge")], "t string, n string")
    row = df.select(
        tx.preview(F.col("t"), 3).alias("p"),
        tx.preview(F.col("t"), 9).alias("q"),
        tx.keywords_from_name(F.col("n")).alias("k"),
    ).first()
    assert (row.p, row.q, row.k) == ("abc...", "abcdef", "court, law, judge")


def test_title_overlap(spark):
    df = spark.createDataFrame(
        [(1, "Rates rise as the Fed acts", "rates rates rise fed. fed the the as")],
        "id int, title string, content string",
    )
    got = [tuple(r) for r in cl.title_overlap(df).collect()]
    assert got == [(1, "rates", 2, 3), (1, "fed", 1, 2), (1, "rise", 1, 2), (1, "acts", 0, 1)]
