"""Tables whose other columns are called like what operators use inside; empty tables; through every stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from corpus_engine.llm import langid, packing, pii, repeats, simhash

INSIDE = (
    "score lang_pred judged_text kept_id kept_hash kept_text class nameless component_id fp text_hash lost_key lost_kept key kept d h added base "
    "spans row piece start length ids ids_crc32 sequence_id offset its_row its_piece bin block next again columns_aside kept_0 pattern value seed"
).split()
BASE = "doc_id long, text string, lang string, source string, n_chars long"


def rows(spark, extra=()):
    words = {
        "en": "the weather was fine and they went to the river with their dog before it rained again on the hills",
        "de": "das wetter war schön und sie gingen mit ihrem hund an den fluss bevor es wieder auf die hügel regnete",
    }
    made = []
    for i in range(24):
        lang = "en" if i % 2 else "de"
        split = words[lang].split()
        text = " ".join(split[(i + k * (i % 5 + 1)) % len(split)] for k in range(40)) + f" mail me at person{i}@host{i}.org"
        made.append((i, text, lang if i < 16 else None, "s", len(text)))
    made += [(100, made[3][1], None, "s", 3), (101, None, "en", "s", 0), (102, "", None, "s", 0), (103, "12 34", None, "s", 5)]
    docs = spark.createDataFrame(made, BASE)
    for k, name in enumerate(extra):
        docs = docs.withColumn(name, F.lit(f"{name}-{k}"))
    return docs


def test_every_stage_carries_columns_of_any_name(spark):
    plain, wide = rows(spark), rows(spark, INSIDE)
    for name, stage in corpus_pipeline.STAGES:
        a, b = stage(spark, plain, ""), stage(spark, wide, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert b.columns == [*plain.columns, *INSIDE]
            kept = b.collect()
            assert all(r[n] == f"{n}-{k}" for r in kept for k, n in enumerate(INSIDE))
            assert sorted(map(str, b.select(plain.columns).collect())) == sorted(map(str, a.collect()))
            assert kept
            plain = spark.createDataFrame(a.collect(), a.schema)
            wide = spark.createDataFrame(kept, b.schema)
        else:
            assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in b.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in a.collect())


def test_every_stage_takes_an_empty_table(spark):
    empty = rows(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


@pytest.mark.parametrize("name", ["bin", "offset", "its_row", "sequence_id", "columns_aside"])
def test_packing_replaces_or_carries_columns(spark, name):
    parts = spark.createDataFrame([(1, 0, 5, "x"), (2, 0, 7, "y")], f"row long, piece int, length long, {name} string")
    found = packing.pack(parts).collect()
    assert {r.row: r.sequence_id for r in found}[1] == {r.row: r.sequence_id for r in found}[2]
    if name not in ("offset", "sequence_id"):
        assert {r.row: r[name] for r in found} == {1: "x", 2: "y"}


def test_operators_by_themselves(spark):
    wide = rows(spark, INSIDE)
    assert langid.identify(wide, langid.train(wide)).columns == ["doc_id", "lang_pred", "score"]
    assert simhash.keep_one(wide).columns == wide.columns
    assert repeats.remove_repeats(wide).columns == wide.columns
    assert pii.redact(wide).columns == wide.columns
    assert simhash.near_duplicates(wide).count() == wide.count()
    assert pii.find(wide).count() == wide.count()
