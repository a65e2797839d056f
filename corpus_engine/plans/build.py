"""End-to-end jobs. Each reads stored tables and writes stored tables below one folder.

    corpus:  CSVs -> articles -> articles_clean -> vocab, features
    topics:  articles_clean, features -> articles_with_topics, topic_info
    models:  features, articles_with_topics -> split, classifier, run log
    reports: split, classifier -> word importance and evaluation tables
    scores:  new articles -> topic, confidence, explaining words
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.operators import clean as cl
from corpus_engine.operators import explain as ex
from corpus_engine.operators import features as ft
from corpus_engine.operators import metrics as mt
from corpus_engine.operators import models as md
from corpus_engine.operators import quality as ql
from corpus_engine.operators import sampling as sp
from corpus_engine.operators import scoring as sc
from corpus_engine.operators import topics as tp
from corpus_engine.operators.density import density_clusters
from corpus_engine.sources import articles as src
from corpus_engine.sources import tables as tb


@dataclass(frozen=True)
class Store:
    """Where the tables of one corpus live."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str, hint: str = "run the step that writes it first") -> DataFrame:
        return src.require_path(spark, self.path(name), hint)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(self.path(name))


def build_articles(
    spark: SparkSession, csv_paths: Sequence[str], store: Store, expected: Mapping[str, ql.Bounds] | None = None
) -> None:
    """Read the CSVs once, clean, store; with the cleaning log and the broken rules next to it.

    Ids that occur more than once are an error: later steps join on them. With bounds ``expected`` (by check, see
    ``quality.expect_table``) a check that is not met stops the build, after its table is written.
    """
    store.write(src.read_articles_csv(spark, csv_paths), "raw")
    raw = store.read(spark, "raw")
    store.write(cl.cleaning_report(raw), "cleaning_log")
    store.write(cl.clean(raw).drop("file_rank"), "cleaned")
    cleaned = store.read(spark, "cleaned")
    ql.assert_unique(cleaned)
    tb.write_table(cleaned, store.path("articles"))
    articles = src.read_articles(spark, store.path("articles"))
    store.write(ql.validate_articles(articles), "broken_rules")
    store.write(ql.expect_table(articles, expected), "table_expectations")
    if expected is not None:
        ql.assert_met(store.read(spark, "table_expectations"))


def build_features(
    spark: SparkSession,
    store: Store,
    min_chars: int = 200,
    min_df: float = 5,
    max_df: float = 0.95,
    max_features: int = 50_000,
    fit_on: DataFrame | None = None,
    expected: Mapping[str, ql.Bounds] | None = None,
) -> None:
    """Prepare the text, fit the vocabulary, weigh the terms; every step reads the stored one before.

    The vocabulary is fitted on all articles; ``fit_on`` (a frame of ids, such as the training
    side of a split) keeps held-out articles out of it. Bounds ``expected`` stop the build as in
    ``build_articles``, see ``quality.expect_features``.
    """
    articles = src.read_articles(spark, store.path("articles"))
    prepared = cl.preprocess(cl.drop_short(articles, min_chars))
    tb.write_table(prepared, store.path("articles_clean"))
    docs = store.read(spark, "articles_clean").select("id", "text_clean")
    ql.assert_unique(docs)
    fitted = docs if fit_on is None else docs.join(fit_on.select("id"), "id", "left_semi")
    tb.write_vocab(ft.fit_vocabulary(fitted, min_df, max_df, max_features), store.path("vocab"))
    vocab = tb.read_vocab(spark, store.path("vocab"))
    entries = ft.entry_structs(ft.document_entries(docs, vocab), vocab)
    store.write(entries, "features")
    store.write(ql.expect_features(feature_rows(spark, store), vocab, docs, expected), "feature_expectations")
    if expected is not None:
        ql.assert_met(store.read(spark, "feature_expectations"))


def feature_rows(spark: SparkSession, store: Store) -> DataFrame:
    """The stored features in long form ``(id, term_id, term, tfidf)``."""
    return store.read(spark, "features").select("id", F.inline("entries"))


def discover_topics(
    spark: SparkSession,
    store: Store,
    sample_size: int = 20_000,
    min_topic_size: int = 50,
    embeddings: DataFrame | None = None,
    dims: int = 5,
    min_pts: int = 15,
    keep: float = 0.95,
    seed: int = 42,
) -> None:
    """Cluster a stratified sample, assign every article to the nearest topic, name the topics.

    ``embeddings`` ``(id, embedding)`` replaces the built-in document vectors. Articles without a
    vector (no known term) are outliers. The reducer, and the centroids with their radii and final
    numbers, are stored, so that new articles can be assigned (``assign_to_topics``).
    """
    articles = store.read(spark, "articles_clean")
    if embeddings is None:
        embeddings = tp.embed_documents(feature_rows(spark, store))
    store.write(embeddings, "embeddings")
    vectors = store.read(spark, "embeddings")
    ids = sp.stratified_sample(articles.select("id", "publication"), "publication", sample_size, seed)
    sample = vectors.join(ids.select("id"), "id", "left_semi")
    reducer = tp.fit_reducer(sample, k=dims)
    reducer.write().overwrite().save(store.path("reducer"))
    store.write(tp.reduce_with(reducer, sample), "fit_vectors")
    fit = store.read(spark, "fit_vectors")
    store.write(density_clusters(fit, min_topic_size, min_pts), "fit_topics")
    fit_topics = store.read(spark, "fit_topics")
    placed = fit.join(fit_topics, "id")
    store.write(tp.topic_centroids(placed), "centres")
    centres = store.read(spark, "centres")
    # a new article belongs to a topic when it lies as near as nearly all of the topic's members
    members = tp.assign_topics(fit, centres, metric="euclidean").withColumnRenamed("topic_id", "nearest")
    inside = members.join(fit_topics, "id").filter(F.col("topic_id") == F.col("nearest"))
    radii = inside.groupBy("topic_id").agg(F.percentile_approx("distance", keep, 10_000).alias("radius"))
    # a topic none of whose members is nearest to its centre takes none
    store.write(
        centres.join(radii, "topic_id", "left").withColumn("radius", F.coalesce("radius", F.lit(-1.0))), "radii"
    )
    bounded = store.read(spark, "radii")
    placed_all = tp.assign_topics(tp.reduce_with(reducer, vectors), bounded, metric="euclidean").select("id", "topic_id")
    assigned = articles.select("id").join(placed_all, "id", "left").withColumn(
        "topic_id", F.coalesce("topic_id", F.lit(tp.OUTLIER))
    )
    store.write(assigned, "assigned")
    assigned = store.read(spark, "assigned")
    numbers = tp.topic_numbers(assigned)
    store.write(bounded.join(numbers, "topic_id").select(F.col("number").alias("topic_id"), "centroid", "radius"), "centroids")
    in_sample = fit_topics.select("id", F.lit(True).alias("_fit"))
    numbered = tp.renumber_topics(assigned).join(in_sample, "id", "left").withColumn(
        "in_fit", F.coalesce("_fit", F.lit(False))
    )
    store.write(numbered.select("id", "topic_id", "in_fit"), "topics")
    store.write(tp.label_status(store.read(spark, "topics")), "label_status")
    topics = articles.join(store.read(spark, "topics"), "id")
    info = tp.topic_info(topics, tp.class_tfidf(topics, "topic_id", 10), fit_flag="in_fit")
    store.write(info, "topic_info_table")
    info = store.read(spark, "topic_info_table")
    tb.write_topic_info(info, store.path("topic_info"))
    tb.write_table(tp.label_articles(topics.drop("in_fit"), info), store.path("articles_with_topics"))


def assign_to_topics(
    spark: SparkSession, store: Store, articles: DataFrame, embeddings: DataFrame | None = None
) -> DataFrame:
    """``(id, topic_id)`` of new articles ``(id, title, content)`` under the discovered topics.

    ``embeddings`` ``(id, embedding)`` is needed where the topics were discovered with given ones.
    """
    if embeddings is None:
        prepared = cl.preprocess(articles).select("id", "text_clean")
        entries = ft.document_entries(prepared, tb.read_vocab(spark, store.path("vocab")))
        embeddings = tp.embed_documents(entries.select("id", F.inline("entries")))
    reducer = tp.load_reducer(store.path("reducer"))
    centroids = store.read(spark, "centroids", "discover topics first")
    found = tp.assign_topics(tp.reduce_with(reducer, embeddings), centroids, metric="euclidean")
    return articles.select("id").join(found.select("id", "topic_id"), "id", "left").withColumn(
        "topic_id", F.coalesce("topic_id", F.lit(tp.OUTLIER))
    )


def train_models(
    spark: SparkSession,
    store: Store,
    C: float = 5.0,
    max_iter: int = 1000,
    boosted_rounds: int = 100,
    test_size: float = 0.2,
    experiment: str = "topic-classification",
) -> DataFrame:
    """Split, train both classifiers, log and keep them; returns the comparison."""
    labelled = store.read(spark, "articles_with_topics").select("id", "topic_id")
    ql.assert_unique(labelled)
    labels = md.label_table(labelled, "topic_id")
    coded = md.encode_labels(labelled, labels, "topic_id")
    store.write(sp.stratified_split(coded, "label_idx", test_size), "split")
    data = md.labelled_features(store.read(spark, "split"), tb.read_features(spark, store.path("features")))
    train, test = data.filter("NOT is_test"), data.filter("is_test")
    logistic = md.train_logistic(train, C=C, max_iter=max_iter)
    md.save_model(logistic, labels, store.path("classifier"))
    vocab = tb.read_vocab(spark, store.path("vocab"))
    store.write(md.coef_table(spark, logistic, vocab), "coef")
    models = {"logistic_regression": logistic}
    if boosted_rounds:
        models["boosted_trees"] = md.train_boosted(train, max_iter=boosted_rounds)
        md.save_model(models["boosted_trees"], labels, store.path("boosted_classifier"))
    sides = [
        md.predict(model, test).select(
            "id", F.lit(name).alias("model"), F.col("label_idx").alias("label"), "prediction"
        )
        for name, model in models.items()
    ]
    store.write(src.union_all(sides), "predictions")
    comparison = mt.compare_models(store.read(spark, "predictions"), "logistic_regression")
    sizes = store.read(spark, "split").agg(
        F.count_if(~F.col("is_test")).alias("train_size"), F.count_if("is_test").alias("test_size")
    ).first()
    for row in comparison.collect():
        tb.append_run(
            spark,
            store.path("runs"),
            f"{row.model}-C{C}-{boosted_rounds}",
            experiment,
            row.model,
            {"model": row.model, "C": C, "max_iter": max_iter, "rounds": boosted_rounds, "solver": "lbfgs",
             "train_size": sizes.train_size, "test_size": sizes.test_size,
             "n_classes": logistic.numClasses, "n_features": logistic.numFeatures},
            {"accuracy": row.accuracy, "f1_macro": row.f1_macro},
        )
    return comparison


def evaluate_models(
    spark: SparkSession, store: Store, words: int = 15, experiment: str = "topic-classification"
) -> dict[str, DataFrame]:
    """The evaluation tables of the linear classifier on the held-out articles; logs the run and
    stores the class report, the confusion table and the attributions."""
    preds = store.read(spark, "predictions").filter("model = 'logistic_regression'").drop("model")
    coef = store.read(spark, "coef")
    _, labels = md.load_model(spark, store.path("classifier"))
    info = store.read(spark, "topic_info_table")
    rows, split = feature_rows(spark, store), store.read(spark, "split")
    importance = ex.topic_word_importance(coef, words).join(labels, "label_idx").select(
        "topic_id", "rank", "word", "importance"
    )
    tb.write_csv(importance, store.path("topic_word_importance"))
    attributions = ex.linear_attribution(rows, coef, preds, sp.background_ids(split))
    store.write(mt.classification_report(preds), "class_report")
    store.write(mt.confusion_matrix(preds, normalize=True), "confusions")
    store.write(ex.attribution_extremes(attributions), "attributions")
    scores = mt.f1(preds).first()
    tb.append_run(
        spark, store.path("runs"), "evaluation", experiment, "logistic_regression_eval",
        {"model": "logistic_regression"},
        {"accuracy": mt.accuracy(preds).first()[0], "f1_macro": scores[0], "f1_weighted": scores[1]},
    )
    return {
        "accuracy": mt.accuracy(preds),
        "f1": mt.f1(preds),
        "report": store.read(spark, "class_report"),
        "confusion": store.read(spark, "confusions"),
        "worst_confusions": mt.worst_confusions(preds),
        "hardest": mt.hardest_topics(preds),
        "importance": importance,
        "importance_of_biggest": ex.importance_of_biggest(coef, split, info),
        "attributions": store.read(spark, "attributions"),
    }


def score_articles(spark: SparkSession, store: Store, articles: DataFrame) -> DataFrame:
    """Score ``(id, title, content)`` with the stored classifier."""
    model, labels = md.load_model(spark, store.path("classifier"))
    return sc.score(
        articles,
        model,
        tb.read_vocab(spark, store.path("vocab")),
        labels,
        store.read(spark, "topic_info_table"),
    )


def score_text_files(spark: SparkSession, store: Store, path: str) -> DataFrame:
    """Score every plain-text file of a folder or glob; the file path is the id."""
    files = src.read_text_documents(spark, path).select(
        F.col("path").alias("id"), F.lit(None).cast("string").alias("title"), "content"
    )
    return score_articles(spark, store, files)
