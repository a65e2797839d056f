"""Classifiers, explanations, scoring, and the jobs from CSV to scored articles."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpus_engine.operators import explain as ex
from corpus_engine.operators import metrics as mt
from corpus_engine.operators import models as md
from corpus_engine.operators import scoring as sc
from corpus_engine.plans import build
from corpus_engine.session import scratch_path
from corpus_engine.sources import tables as tb


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(42)
    rows = [
        (k * 20 + i, k, Vectors.dense(rng.normal(m, 1.0, 20)))
        for k, m in enumerate((3.0, -3.0, 0.0))
        for i in range(20)
    ]
    return spark.createDataFrame(rows, ["id", "label_idx", "features"]).cache()


@pytest.fixture(scope="module")
def linear(separable):
    return md.train_logistic(separable, C=1.0, max_iter=200)


def test_linear_classifier_contract(separable, linear):
    assert linear.numClasses == 3 and linear.coefficientMatrix.toArray().shape == (3, 20)
    rows = md.predict(linear, separable).collect()
    assert {r.prediction for r in rows} <= {0, 1, 2}
    assert all(abs(sum(r.probability) - 1) < 1e-6 for r in rows)
    assert np.mean([r.prediction == r.label_idx for r in rows]) > 0.8


def test_penalty_means_what_c_says(separable):
    """At the optimum the gradient of sum(loss) + |w|^2 / (2 C) vanishes."""
    c = 0.5
    model = md.train_logistic(separable, C=c, max_iter=500)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = separable.collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.eye(3)[[int(r.label_idx) for r in rows]]
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert np.abs((p - y).T @ x + w / c).max() < 1e-2


def test_two_class_toy(spark):
    texts = [
        ("dough oven flour bake crust", 0), ("soup simmer onion garlic broth", 0),
        ("roast pepper oven tray salt", 0), ("cake sugar butter bake frosting", 0),
        ("engine torque gearbox clutch garage", 1), ("tyre wheel brake garage pedal", 1),
        ("diesel engine piston valve fuel", 1), ("steering wheel axle bumper hood", 1),
    ]
    from corpus_engine.operators import features as ft

    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "id long, text_clean string, label_idx int")
    vocab = ft.fit_vocabulary(df, 1, 1.0, None, (1, 1)).cache()
    vectors = ft.feature_vectors(ft.tfidf(df, vocab, (1, 1), False), df, vocab)
    model = md.train_logistic(df.select("id", "label_idx").join(vectors, "id"), C=1.0)
    new = spark.createDataFrame([(1, "the brake and clutch of the engine")], "id long, text_clean string")
    scored = md.predict(model, ft.feature_vectors(ft.tfidf(new, vocab, (1, 1), False), new, vocab)).first()
    assert scored.prediction == 1
    coef = md.coef_long(md.coef_table(spark, model, vocab)).filter("label_idx = 1")
    assert coef.orderBy(F.desc("weight")).first().term in {"engine", "wheel", "garage"}


def test_label_round_trip(spark):
    df = spark.createDataFrame([(1, 7), (2, 0), (3, 12), (4, 7)], "id long, topic_id int")
    labels = md.label_table(df, "topic_id")
    assert [(r.label_idx, r.topic_id) for r in labels.orderBy("label_idx").collect()] == [(0, 0), (1, 7), (2, 12)]
    coded = md.encode_labels(df, labels, "topic_id").drop("topic_id")
    back = md.decode_labels(coded, labels, "topic_id", "label_idx")
    assert {r.id: r.topic_id for r in back.collect()} == {1: 7, 2: 0, 3: 12, 4: 7}


def test_trees_and_sweep(separable):
    booster = md.train_boosted(separable, max_iter=2)
    forest = md.train_forest(separable, trees=5, max_depth=3)
    for model in (booster, forest):
        preds = md.predict(model, separable).select(F.col("label_idx").alias("label"), "prediction")
        assert mt.accuracy(preds).first().accuracy > 0.8
    sweep = md.sweep_c(separable, separable, (0.01, 1), max_iter=50).collect()
    assert [r.C for r in sweep] == [0.01, 1.0] and all(0.5 < r.test_acc <= 1 for r in sweep)


def test_model_round_trip(spark, separable, linear):
    path = scratch_path(spark, "m")
    labels = md.label_table(separable.select(F.col("label_idx").alias("topic_id")), "topic_id")
    md.save_model(linear, labels, path)
    model, stored = md.load_model(spark, path)
    assert np.array_equal(model.coefficientMatrix.toArray(), linear.coefficientMatrix.toArray())
    assert stored.count() == 3
    with pytest.raises(FileNotFoundError, match="training"):
        md.load_model(spark, path + "-none")


def test_top_classes(spark):
    df = spark.createDataFrame([([0.1, 0.4, 0.2, 0.3],)], "p array<double>")
    got = df.select(sc.top_classes(F.col("p"), 3).alias("t")).first().t
    assert [(r.label_idx, r.probability) for r in got] == [(1, 0.4), (3, 0.3), (2, 0.2)]


def test_attributions_add_up_over_all_terms(spark):
    rng = np.random.default_rng(0)
    x = rng.random((12, 6)) * (rng.random((12, 6)) < 0.6)
    w = rng.normal(size=(3, 6))
    features = spark.createDataFrame(
        [(i, j, f"t{j}", float(x[i, j])) for i in range(12) for j in range(6) if x[i, j]], "id long, term_id int, term string, tfidf double"
    )
    coef = spark.createDataFrame([(j, f"t{j}", [float(v) for v in w[:, j]]) for j in range(6)], "term_id int, term string, weights array<double>")
    preds = spark.createDataFrame([(i, i % 3) for i in range(12)], "id long, prediction int")
    background = spark.createDataFrame([(i,) for i in range(8)], "id long")
    mean = x[:8].mean(axis=0)
    for r in ex.attribution_total(features, coef, preds, background).collect():
        assert r.total == pytest.approx(float(w[r.prediction] @ (x[r.id] - mean)))
    att = ex.linear_attribution(features, coef, preds, background)
    for r in att.collect():
        assert r.attribution == pytest.approx(w[r.prediction, r.term_id] * (x[r.id, r.term_id] - mean[r.term_id]))
    assert ex.attribution_check(att).filter("NOT agrees").count() == 0
    sides = ex.attribution_extremes(att, 2).groupBy("id", "side").count().collect()
    assert all(r["count"] <= 2 for r in sides) and {r.side for r in sides} == {"top", "bottom"}
    words = {r.id: r.top_words for r in sc.top_words(ex.contributions(features, coef, preds), 2).collect()}
    assert all(len(v) <= 2 and all(t.score >= 0 for t in v) for v in words.values())


TOPICS = {
    "politics": "president senate congress republican democrat vote election bill law tax".split(),
    "sport": "football game touchdown quarterback season team coach league score playoff".split(),
    "climate": "climate carbon emissions warming energy ocean ice temperature pollution forest".split(),
}


def planted(folder):
    """Two CSV files of 240 articles on three topics, with nulls, repeats and stubs among them."""
    rng = random.Random(1)
    common = "people year time report week city group world".split()
    lines = []
    for i in range(240):
        words = TOPICS[sorted(TOPICS)[i % 3]]
        body = " ".join(rng.choice(words) if rng.random() < 0.75 else rng.choice(common) for _ in range(60))
        lines.append(f'{i},"{rng.choice(words)} {rng.choice(words)}",{["CNN", "Vox", "NPR"][i % 2]},,2017-01-0{i % 9 + 1},2017,1,"{body}"')
    extra = ["900,,CNN,,,,,\"" + "no title " * 40 + '"', "901,\"empty\",CNN,,,,,", '902,"stub",CNN,,,,,"short"', lines[0]]
    head = "id,title,publication,author,date,year,month,content\n"
    one, two = folder / "a.csv", folder / "b.csv"
    one.write_text(head + "\n".join(lines[:120]) + "\n")
    two.write_text(head + "\n".join(lines[120:] + extra) + "\n")
    return [str(one), str(two)]


def test_jobs_from_csv_to_scores(spark, tmp_path):
    store = build.Store(scratch_path(spark, "store"))
    build.build_articles(spark, planted(tmp_path), store)
    assert store.read(spark, "articles").count() == 241
    with pytest.raises(ValueError, match="row_count is 241"):
        build.build_articles(spark, planted(tmp_path), store, expected={})
    with pytest.raises(ValueError, match="features is"):
        build.build_features(spark, store, min_df=3, max_features=500, expected={"rows": (100, None), "sparsity": (0, 1)})
    build.build_features(spark, store, min_df=3, max_features=500)
    assert store.read(spark, "articles_clean").count() == 240
    build.discover_topics(spark, store, sample_size=200, min_topic_size=15, min_pts=6)
    info = tb.read_topic_info(spark, store.path("topic_info")).filter("topic <> -1").collect()
    assert len(info) >= 3
    best = {}
    for r in info:
        hits = {k: sum(w in words for w in r.representation) for k, words in TOPICS.items()}
        best[r.topic] = max(hits, key=hits.get)
    assert set(best.values()) == set(TOPICS)
    comparison = {r.model: r for r in build.train_models(spark, store, max_iter=50, boosted_rounds=1).collect()}
    assert comparison["logistic_regression"].accuracy > 0.8
    status = store.read(spark, "label_status").first()
    assert status.total == 240 and status.labelled + status.outliers == 240
    tables = build.evaluate_models(spark, store)
    assert store.read(spark, "confusions").count() > 0 and store.read(spark, "attributions").count() > 0
    assert tables["report"].count() == len(info) + 3
    assert tables["importance"].filter("rank = 1").count() == len(info)
    assert tables["attributions"].count() > 0
    runs = tb.list_runs(spark, store.path("runs"), "topic-classification")
    assert {r.model for r in runs.collect()} == set(comparison)
    new = spark.createDataFrame(
        [(1, None, "A senate vote sent the tax bill to the president this week."),
         (2, "Game day", "One late touchdown decided the game for the quarterback and the season."),
         (3, "", "zzzz")],
        "id long, title string, content string",
    )
    rows = {r.id: r for r in build.score_articles(spark, store, new).collect()}
    assert best[rows[1].topic_id] == "politics" and best[rows[2].topic_id] == "sport"
    assert all(abs(sum(r.probability) - 1) < 1e-6 and 0 < r.confidence <= 1 for r in rows.values())
    assert rows[3].top_words == [] and rows[1].top_words[0].score > 0
    assert rows[1].topic_label.startswith(f"{rows[1].topic_id}_")
    placed = {r.id: r.topic_id for r in build.assign_to_topics(spark, store, new).collect()}
    assert placed[3] == -1 and placed[1] in (-1, rows[1].topic_id) and placed[2] in (-1, rows[2].topic_id)
    assert store.read(spark, "cleaning_log").count() == 4 and store.read(spark, "feature_expectations").count() == 5
    boosted, _ = md.load_model(spark, store.path("boosted_classifier"), md.OneVsRestModel)
    assert len(boosted.models) == len(info)
    folder = tmp_path / "texts"
    folder.mkdir()
    (folder / "a.txt").write_text("The ocean warms as carbon emissions grow, and so does the climate.")
    scored = build.score_text_files(spark, store, str(folder)).collect()
    assert len(scored) == 1 and best[scored[0].topic_id] == "climate"
