"""Cleaning, profiling and the row contract on planted cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpus_engine.functions.hashing import random_key
from corpus_engine.operators import clean as cl
from corpus_engine.operators import profile as pf
from corpus_engine.operators import quality as ql
from corpus_engine.session import scratch_path
from corpus_engine.sources import articles as src
from corpus_engine.sources import tables as tb

LONG = "Rain fell on the valley for three days and nights."


def articles(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, title string, publication string, author string, date string, content string")


def test_valid_records_pass(spark):
    rows = [(i, f"Article {i}", "NYT", None, None, "x" * 50) for i in range(100)]
    rows.append((101, "Rain in the valley", "Reuters", "Jane", "2017-03-15", LONG))
    assert ql.validate_articles(articles(spark, *rows)).count() == 0


def test_each_broken_rule_is_reported(spark):
    df = articles(
        spark,
        (4, "   ", "CNN", None, None, LONG),
        (5, "Valid title", "CNN", None, None, "Rain."),
        (6, "Valid title", "", None, None, LONG),
        (7, "  ", "CNN", None, None, LONG),
        (None, "t", "p", None, None, LONG),
        (8, None, None, None, None, None),
    )
    got = {(r.id, r.rule) for r in ql.validate_articles(df).collect()}
    assert got == {
        (4, "title_blank"), (5, "content_short"), (6, "publication_blank"), (7, "title_blank"),
        (None, "id_missing"), (8, "title_blank"), (8, "publication_blank"), (8, "content_short"),
    }


def test_duplicate_ids(spark):
    df = articles(spark, (1, "A", "CNN", None, None, LONG), (1, "B", "CNN", None, None, LONG), (2, "C", "CNN", None, None, LONG))
    assert [tuple(r) for r in ql.duplicate_keys(df).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        ql.assert_unique(df)


def test_dedup_keeps_first_in_file_order_and_whole_copies_once(spark):
    rows = [(0, 5, "b", "x"), (1, 1, "a", "x"), (0, 9, "c", "x"), (0, 7, "q", "y"), (1, 8, "z", None), (0, 3, "n", None)]
    rows += [(0, 2, "same", "copy")] * 3
    df = spark.createDataFrame(rows, "file_rank int, id long, title string, content string").repartition(5)
    got = sorted((r.id, r.title, r.content or "") for r in cl.dedup_keep_first(df).collect())
    assert got == [(2, "same", "copy"), (3, "n", ""), (5, "b", "x"), (7, "q", "y")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_dedup_agrees_with_brute_force_under_one_dominating_text(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(cl, "BROADCAST_DIGESTS", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(3000).select(
        "id", F.lit(0).alias("file_rank"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("content")
    )
    try:
        result = cl.dedup_keep_first(df.repartition(6))
        plan = result._jdf.queryExecution().executedPlan().toString()
        got = {(r.id, r.content) for r in result.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin" in plan) != broadcast
    want = {}
    for i in range(3000):
        want.setdefault("hot" if i % 3 == 0 else str(i % 700), i)
    assert got == {(i, c) for c, i in want.items()}


def test_cleaning_report_matches_the_frames(spark):
    df = articles(
        spark, (1, "a", "p", None, None, "x"), (2, None, "p", None, None, "y"), (3, "c", "p", None, None, None),
        (4, "d", "p", None, None, "x"), (5, None, "p", None, None, None),
    ).withColumn("file_rank", F.lit(0))
    report = [(r.rows, r.removed) for r in cl.cleaning_report(df).orderBy("step").collect()]
    assert report == [(5, 0), (3, 2), (2, 1), (1, 1)]
    assert cl.clean(df).count() == 1


def test_csv_reader(spark, tmp_path):
    one, two = tmp_path / "a.csv", tmp_path / "b.csv"
    one.write_text('idx,id,title,publication,author,date,year,month,url,content\n0,1,"A ""quoted"" title",CNN,NA,2017-01-01,2017,1,u,"line one\nline two, with comma"\n1,2,null,CNN,,,,,u,text\n')
    two.write_text("id,title,content\n3,T,\n")
    rows = {r.id: r for r in src.read_articles_csv(spark, [str(one), str(two)]).collect()}
    assert rows[1].title == 'A "quoted" title' and rows[1].content == "line one\nline two, with comma"
    assert rows[1].author is None and rows[1].year == 2017.0
    assert rows[2].title is None and rows[2].date is None
    assert rows[3].publication is None and rows[3].content is None and rows[3].file_rank == 1
    assert "url" not in rows[1].asDict()


def test_text_files(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.txt").write_text(f"first {i}\nsecond")
    rows = src.read_text_documents(spark, str(tmp_path)).collect()
    assert sorted(r.content for r in rows) == [f"first {i}\nsecond" for i in range(4)]


def test_table_round_trip_replaces_and_finds_by_key(spark):
    path = scratch_path(spark, "t")
    tb.write_table(spark.range(10), path)
    tb.write_table(spark.range(100), path)
    assert spark.read.parquet(path).count() == 100
    found = tb.lookup(spark, path, "id", 42)
    assert [r.id for r in found.collect()] == [42]
    assert "EqualTo(id,42)" in found._jdf.queryExecution().executedPlan().toString()


def test_missing_artefact_is_a_clear_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run the step"):
        src.require_path(spark, str(tmp_path / "nothing"))


def test_monthly_counts_fill_gaps_and_skip_bad_dates(spark):
    df = spark.createDataFrame(
        [("2017-01-05",), ("2017/01/20",), ("March 3, 2017",), ("04/15/2017",), ("no date",), (None,), ("2017-13-40",)], "date string"
    )
    got = [tuple(r) for r in pf.monthly_counts(df, "date").collect()]
    assert got == [
        (dt.date(2017, 1, 31), 2), (dt.date(2017, 2, 28), 0), (dt.date(2017, 3, 31), 1), (dt.date(2017, 4, 30), 1),
    ]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 9, 10, 10)], "x double")
    rows = pf.histogram(df, F.col("x"), bins=10).orderBy("bin").collect()
    assert [r.n for r in rows] == [1, 1, 1, 0, 0, 0, 0, 0, 0, 3]
    same = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    rows = pf.histogram(same, F.col("x"), bins=4).orderBy("bin").collect()
    assert (rows[0].lower, rows[-1].upper, sum(r.n for r in rows)) == (3.5, 4.5, 2)


def test_value_counts_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in pf.value_counts(df, "k", normalize=True).collect()] == [("a", 2, 66.7), ("b", 1, 33.3)]
    assert [tuple(r) for r in pf.null_profile(df, pct=True).collect()] == [("k", 25.0)]
    assert pf.duplicate_count(df, ["k"]).first()[0] == 1


def test_expectations_and_required_columns(spark):
    df = articles(spark, (1, "a", "p", None, None, "x" * 20), (2, "b", "p", None, None, "x" * 20))
    rows = {r.check: r for r in ql.expect_table(df).collect()}
    assert not rows["row_count"].passed and rows["null_title"].passed and not rows["duplicate_content"].passed
    assert ql.require_columns(df, ["title"]).first().nulls == 0
    with pytest.raises(ValueError, match="text_clean"):
        ql.require_columns(df, ["text_clean"])
    assert [r[0] for r in ql.missing_values(df, "publication", ["p", "q"]).collect()] == ["q"]


def test_schema_table(spark):
    df = articles(spark, (1, "a", "p", None, None, "x"))
    rows = src.describe_schema(df).orderBy("position").collect()
    assert (rows[0].column, rows[0].type) == ("id", "bigint") and len(rows) == 6


def test_random_key_is_md5(spark):
    import hashlib

    got = spark.range(3).select(random_key(42, "id")).collect()
    assert [r[0] for r in got] == [hashlib.md5(f"42:{i}".encode()).hexdigest() for i in range(3)]
