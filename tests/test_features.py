"""TF-IDF against a plain Python computation, and the vector hand-off."""

import math
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpus_engine.operators import features as ft
from corpus_engine.operators import topk
from corpus_engine.session import scratch_path
from corpus_engine.sources import tables as tb

CORPUS = [
    "harbour crane cargo tariff dock strike",
    "mayor council ballot district turnout budget",
    "cyclist sprint mountain stage jersey climb",
    "violin opera conductor stage premiere chorus",
    "glacier melt river flood harbour",
    "cargo tariff tariff tariff budget flood",
    "",
]


def docs(spark, texts=CORPUS):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text_clean string")


def grams(text, low=1, high=2):
    words = [w for w in text.split(" ") if len(w) > 1]
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def brute_force(texts, min_df, max_df, k, high=2, sublinear=True):
    counts = [Counter(grams(t, 1, high)) for t in texts]
    df = Counter(t for c in counts for t in c)
    total = Counter()
    for c in counts:
        total.update(c)
    kept = [t for t in df if min_df <= df[t] <= max_df * len(texts)]
    kept = sorted(sorted(kept, key=lambda t: (-total[t], t))[:k])
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    rows = {}
    for i, c in enumerate(counts):
        w = {t: ((1 + math.log(n)) if sublinear else n) * idf[t] for t, n in c.items() if t in idf}
        length = math.sqrt(sum(x * x for x in w.values()))
        rows.update({(i, t): x / length for t, x in w.items()})
    return kept, rows


@pytest.mark.parametrize(
    "min_df,max_df,k,high,sublinear",
    [(1, 1.0, 1000, 2, True), (1, 0.2, 20, 2, True), (2, 1.0, 3, 1, False), (1, 1.0, None, 1, True)],
)
def test_weights_match_brute_force(spark, min_df, max_df, k, high, sublinear):
    kept, want = brute_force(CORPUS, min_df, max_df, k, high, sublinear)
    df = docs(spark)
    vocab = ft.fit_vocabulary(df, min_df, max_df, k, (1, high))
    assert [r.term for r in vocab.orderBy("term_id").collect()] == kept
    assert [r.term_id for r in vocab.orderBy("term_id").collect()] == list(range(len(kept)))
    got = {(r.id, r.term): r.tfidf for r in ft.tfidf(df, vocab, (1, high), sublinear).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_lengths_are_one_and_weights_in_range(spark):
    df = docs(spark)
    rows = ft.tfidf(df, ft.fit_vocabulary(df, 1, 1.0, 100))
    norms = rows.groupBy("id").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("n")).collect()
    assert len(norms) == 6 and all(abs(r.n - 1) < 1e-12 for r in norms)
    assert rows.filter("tfidf < 0 OR tfidf > 1").count() == 0
    best = rows.filter("term = 'cyclist'").collect()
    assert [r.id for r in best] == [2]
    assert rows.filter(F.instr("term", " ") > 0).count() > 0


def test_unseen_words_give_an_empty_vector_of_full_width(spark):
    df = docs(spark)
    vocab = ft.fit_vocabulary(df, 1, 1.0, 100)
    new = docs(spark, ["zzzzunknownword", "stock market glacier crisis", ""])
    vectors = ft.feature_vectors(ft.transform_tfidf(new, vocab), new, vocab).orderBy("id").collect()
    assert [v.features.size for v in vectors] == [vocab.count()] * 3
    assert [v.features.numNonzeros() for v in vectors] == [0, 1, 0]


def test_stored_vectors_equal_computed_ones(spark):
    df = docs(spark)
    vocab = ft.fit_vocabulary(df, 1, 1.0, 100)
    rows = ft.tfidf(df, vocab)
    path = scratch_path(spark, "f")
    tb.write_features(ft.feature_structs(rows, df, vocab), path)
    stored = {r.id: r.features for r in tb.read_features(spark, path).collect()}
    direct = {r.id: r.features for r in ft.feature_vectors(rows, df, vocab).collect()}
    assert stored == direct
    dense = ft.feature_vectors(rows, df, vocab).select("id", F.explode(vector_to_array("features")).alias("x"))
    assert dense.filter("x > 0").count() == rows.count()


def test_result_does_not_depend_on_partitioning(spark):
    df = docs(spark)
    runs = []
    for parts in ("3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        vocab = ft.fit_vocabulary(df.repartition(int(parts)), 1, 1.0, 12)
        runs.append(sorted((r.id, r.term, round(r.tfidf, 12)) for r in ft.tfidf(df, vocab).collect()))
    assert runs[0] == runs[1]


def test_take_largest_is_exact_with_ties(spark):
    values = [(i % 37 + 1, f"t{i:04d}") for i in range(2000)]
    df = spark.createDataFrame(values, "v long, t string")
    for k in (1, 55, 700, 1999, 5000):
        want = sorted(values, key=lambda r: (-r[0], r[1]))[:k]
        assert [tuple(r) for r in topk.take_largest(df, "v", k, "t").collect()] == want


def test_sorted_index(spark):
    words = [f"{a}{b}" for a in "zxyab" for b in range(40)]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(7)
    found = topk.with_sorted_index(df, "w", "i")
    assert found.schema["i"].dataType.simpleString() == "bigint"
    assert {r.w: r.i for r in found.collect()} == {w: i for i, w in enumerate(sorted(words))}


def test_sorted_index_of_terms_that_begin_alike(spark):
    words = [f"the {n:06d}" for n in range(20_000)] + ["a", "zz"]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(9)
    got = {r.w: r.i for r in topk.with_sorted_index(df, "w", "i").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}
    assert topk.with_sorted_index(df.limit(0), "w", "i").count() == 0


def test_positions_go_beyond_32_bits(spark):
    sizes = spark.createDataFrame([(k, 3_000_000_000) for k in (2, 0, 1)], "_range int, _n bigint")
    got = {r._range: r._offset for r in topk.range_offsets(sizes).collect()}
    assert got == {0: 0, 1: 3_000_000_000, 2: 6_000_000_000}


def test_vocabulary_reports(spark):
    vocab = ft.fit_vocabulary(docs(spark), 1, 1.0, 1000)
    mix = ft.vocab_composition(vocab).first()
    assert mix.unigrams + mix.bigrams == mix.terms and mix.bigrams > 0
    found = {r.phrase: r.in_vocabulary for r in ft.phrase_lookup(vocab, ["cargo tariff", "white house"]).collect()}
    assert found == {"cargo tariff": True, "white house": False}
    assert ft.sample_bigrams(vocab, 5).count() == 5


def test_damping_table(spark):
    counts = spark.createDataFrame([(1,), (5,), (5,), (100,)], "tf int")
    rows = {r["count"]: (r.linear, round(r.damped, 3)) for r in ft.damping_table(counts).collect()}
    assert rows == {1: (0.01, 0.693), 5: (0.05, 1.792), 100: (1.0, 4.615)}


def test_no_token_shuffle_for_the_vocabulary(spark):
    """The only wide step before the term totals is the shuffle of per-task term totals."""
    df = docs(spark)
    plan = ft.term_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan
    totals = ft.term_totals(df)._jdf.queryExecution().executedPlan().toString()
    assert totals.count("Exchange") == 1 and "Exchange hashpartitioning(term" in totals and "PythonUDF" not in totals
    weights = ft.tfidf(df, ft.fit_vocabulary(df, 1, 1.0, 100))._jdf.queryExecution().sparkPlan().toString()
    assert "PythonUDF" not in weights


@pytest.mark.parametrize("span", [(1, 1), (1, 2), (2, 2), (1, 3), (2, 3)])
def test_occurrences_and_totals_match_plain_counting(spark, span):
    texts = CORPUS + ["bb", "bb cc", "bb cc bb cc bb"]
    df = docs(spark, texts)
    want = Counter((i, g) for i, t in enumerate(texts) for g in grams(t, *span))
    got = Counter((r.id, r.term) for r in ft.term_occurrences(df, ngram_range=span).collect())
    assert got == want
    rows = {(r.id, r.term): r.tf for r in ft.term_rows(df, ngram_range=span).collect()}
    assert rows == dict(want)
    totals = {r.term: (r.df, r.corpus_tf) for r in ft.term_totals(df, ngram_range=span).collect()}
    by_term = Counter(g for _, g in want)
    assert totals == {g: (n, sum(c for (_, t), c in want.items() if t == g)) for g, n in by_term.items()}
