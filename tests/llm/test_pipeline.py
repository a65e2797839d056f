"""The pipeline on a small table against plain versions of its decisions."""

import corpus_pipeline
from corpus_engine.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i} and the other one" for i in range(80))


def test_stages_follow_each_other(spark, tmp_path):
    shared = "a passage that two documents share and that is long enough to be found as repeated text " * 3
    rows = [
        (1, LONG, "en", "a", 1), (2, LONG, "en", "a", 1), (3, LONG + " end", "en", "b", 1), (4, None, "en", "a", 0),
        (5, "123 !!", "en", "a", 6), (6, f"first start {shared} tail mail me@x.org", "en", "a", 1),
        (7, f"second begin {shared} quite another tail", None, "a", 1),
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{at}")
        docs = spark.read.parquet(f"{tmp_path}/stage{at}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if at < len(corpus_pipeline.STAGES) - 1:
            assert docs.schema == spark.read.parquet(f"{tmp_path}/documents.parquet").schema
    assert set(seen["language_id"]) == {1, 2, 3, 6, 7} and seen["language_id"][7].lang == "en"
    assert {1, 6, 7} <= set(seen["simhash_near_dedup"]) and 2 not in seen["simhash_near_dedup"]
    cut = seen["suffix_array_dedup"]
    assert "share" not in cut[6].text and cut[6].text.startswith("first start") and cut[7].text.endswith("tail")
    assert all(r.n_chars == len(r.text) for r in cut.values())
    assert seen["pii"][6].text.endswith("mail <email>")
    assert set(seen["best_fit_packing"]) == set(seen["pii"])
    rows = queries.load()["pipeline"].run(spark, str(tmp_path)).collect()
    assert len(rows) == len(seen["best_fit_packing"])


def test_all_queries_are_registered():
    names = list(queries.load())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names
