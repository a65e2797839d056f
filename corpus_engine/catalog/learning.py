"""Queries over classifiers, explanations and scoring.

Explanations are checked with coefficients made from the corpus (class word weights, centred per
term); the trained models have their own queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_engine.catalog.base import PREPARED, articles, prepared, register, table, tfidf_sql, with_sql
from corpus_engine.catalog.evaluation import LANGS
from corpus_engine.catalog.text import FULL, stored_vocab
from corpus_engine.catalog.topics import class_weights_sql
from corpus_engine.operators import explain as ex
from corpus_engine.operators import features as ft
from corpus_engine.operators import metrics as mt
from corpus_engine.operators import models as md
from corpus_engine.operators import sampling as sp
from corpus_engine.operators import scoring as sc
from corpus_engine.operators import topics as tp
from corpus_engine.session import scratch_path, settled
from corpus_engine.sources import articles as src
from corpus_engine.sources import tables as tb

# --- explanations with given coefficients --------------------------------------------------------


def given(spark, sf, only=None):
    """Features, coefficients and predictions (the true language) of the prepared corpus; features of the ids in
    ``only``, where a query needs no others."""
    docs = prepared(spark, sf).select("id", "lang", "text_clean")
    vocab = stored_vocab(spark, sf, **FULL)
    wanted = docs if only is None else docs.join(F.broadcast(only), "id", "left_semi")
    rows = ft.tfidf(wanted, vocab).withColumn("tfidf", F.round("tfidf", 6))
    per_class = tp.class_term_weights(docs, "lang")
    arrays = per_class.groupBy("term").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == k, F.col("weight"))), F.lit(0.0)) for k in LANGS]).alias("w")
    )
    mean = F.aggregate("w", F.lit(0.0), lambda a, x: a + x) / len(LANGS)
    coef = vocab.select("term_id", "term").join(arrays, "term").select(
        "term_id", "term", F.transform("w", lambda x: F.round(1000 * (x - mean), 6)).alias("weights")
    )
    number = F.array_position(F.array(*[F.lit(k) for k in LANGS]), F.col("lang")) - 1
    preds = docs.select("id", number.cast("int").alias("prediction"))
    return rows, coef, preds


GIVEN = (
    tfidf_sql(**FULL)
    + ","
    + class_weights_sql("worded", "lang")
    + """,
f AS (SELECT id, term_id, term, round(tfidf, 6) AS tfidf FROM features),
names AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS lang, unnest([0, 1, 2, 3])::INTEGER AS label_idx),
sums AS (SELECT term, sum(weight) / 4 AS mean FROM cw GROUP BY 1),
coef AS (SELECT v.term_id, v.term, n.label_idx, round(1000 * (coalesce(c.weight, 0) - s.mean), 6) AS weight
         FROM vocab v JOIN sums s USING (term) CROSS JOIN names n LEFT JOIN cw c ON c.term = v.term AND c.class = n.lang),
preds AS (SELECT id, label_idx AS prediction FROM prepared JOIN names USING (lang)),
contrib AS (SELECT f.id, p.prediction, f.term_id, f.term, f.tfidf, c.weight, c.weight * f.tfidf AS contribution
            FROM f JOIN preds p USING (id) JOIN coef c ON c.term_id = f.term_id AND c.label_idx = p.prediction)"""
)


@register(
    "K3 C7",
    with_sql(GIVEN, "SELECT id, prediction, term_id, term, tfidf, weight, round(contribution, 6) AS contribution FROM contrib"),
)
def term_contributions(spark, sf):
    rows, coef, preds = given(spark, sf)
    return ex.contributions(rows, coef, preds).withColumn(
        "contribution", F.round("contribution", 6)
    )


@register(
    "E3 K3",
    with_sql(
        GIVEN,
        """, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY contribution DESC, term) AS rank FROM contrib WHERE contribution > 0)
        SELECT id, string_agg(term, ' ' ORDER BY rank) AS words, round(sum(round(contribution, 4)), 4) AS total
        FROM r WHERE rank <= 8 GROUP BY id""",
    ),
)
def explaining_words(spark, sf):
    rows, coef, preds = given(spark, sf)
    best = sc.top_words(ex.contributions(rows, coef, preds))
    return best.select(
        "id",
        F.array_join("top_words.word", " ").alias("words"),
        F.round(F.aggregate("top_words.score", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )


_WORDS = """SELECT label_idx, rank, term AS word, weight AS importance FROM (
  SELECT *, row_number() OVER (PARTITION BY label_idx ORDER BY weight DESC, term)::INTEGER AS rank FROM coef) WHERE rank <= 15"""


@register("K1 E2 I6", with_sql(GIVEN, _WORDS))
def important_words(spark, sf):
    return ex.topic_word_importance(given(spark, sf)[1], 15)


@register("A10", with_sql(GIVEN, _WORDS))
def stored_important_words(spark, sf):
    path = scratch_path(spark, "importance")
    tb.write_csv(ex.topic_word_importance(given(spark, sf)[1], 15), path)
    return tb.read_csv(spark, path, "label_idx int, rank int, word string, importance double")


@register(
    "K1 C4 C2",
    with_sql(
        GIVEN,
        """, big AS (SELECT prediction, count(*) AS articles FROM preds GROUP BY 1 ORDER BY articles DESC, prediction LIMIT 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY label_idx ORDER BY weight DESC, term)::INTEGER AS rank FROM coef)
        SELECT label_idx AS topic_id, label_idx::VARCHAR AS name, articles, rank, term AS word, weight AS importance
        FROM r JOIN big ON prediction = label_idx WHERE rank <= 12""",
    ),
)
def important_words_of_biggest(spark, sf):
    """Twelve words of the two biggest topics; topics without a name show their number."""
    _, coef, preds = given(spark, sf)
    labelled = preds.select(F.col("prediction").alias("label_idx"), F.col("prediction").alias("topic_id"))
    none = spark.createDataFrame([], "topic int, name string")
    return ex.importance_of_biggest(coef, labelled, none, topics=2, n=12)


@register(
    "I9 I6",
    with_sql(
        GIVEN,
        """, two AS (SELECT e.term AS word, e.weight - f.weight AS weight FROM coef e JOIN coef f USING (term_id) WHERE e.label_idx = 1 AND f.label_idx = 3),
        sides AS ((SELECT *, '+' AS sign FROM two WHERE weight > 0 ORDER BY weight DESC, word LIMIT 15) UNION ALL
                  (SELECT *, '-' FROM two WHERE weight < 0 ORDER BY weight, word DESC LIMIT 15))
        SELECT row_number() OVER (ORDER BY weight DESC, word)::INTEGER AS rank, word, round(weight, 6) AS weight, sign FROM sides""",
    ),
)
def words_for_english_or_french(spark, sf):
    """Two classes: the words that speak for English against French and the other way round, with signs."""
    found = ex.signed_words(given(spark, sf)[1], LANGS.index("en"), LANGS.index("fr"))
    return found.withColumn("weight", F.round("weight", 6))


BACKGROUND = """,
bg AS (SELECT id FROM prepared ORDER BY md5('42:' || id) LIMIT 100),
means AS (SELECT term_id, sum(tfidf) / 100 AS mean_bg FROM f WHERE id IN (SELECT id FROM bg) GROUP BY 1)"""


def _background(spark, sf):
    return sp.sample_n(prepared(spark, sf).select("id"), 100)


@register("D20", with_sql(GIVEN, BACKGROUND + " SELECT term_id, round(mean_bg, 8) AS mean_bg FROM means"))
def background_means(spark, sf):
    chosen = settled(_background(spark, sf), "background-ids")
    means = ex.background_mean(given(spark, sf, chosen)[0], chosen)
    return means.withColumn("mean_bg", F.round("mean_bg", 8))


ATTRIBUTIONS = BACKGROUND + """,
att AS (SELECT c.*, coalesce(mean_bg, 0) AS mean_bg, weight * (tfidf - coalesce(mean_bg, 0)) AS attribution
        FROM contrib c LEFT JOIN means USING (term_id))"""


def _attributions(spark, sf):
    rows, coef, preds = given(spark, sf)
    return ex.linear_attribution(rows, coef, preds, _background(spark, sf))


@register("K2", with_sql(GIVEN, ATTRIBUTIONS + " SELECT id, prediction, term_id, term, tfidf, weight, round(mean_bg, 8) AS mean_bg, round(attribution, 6) AS attribution FROM att"))
def word_attributions(spark, sf):
    """Every term of every article: how far it pushes towards the predicted class."""
    return _attributions(spark, sf).withColumns(
        {"mean_bg": F.round("mean_bg", 8), "attribution": F.round("attribution", 6)}
    ).select("id", "prediction", "term_id", "term", "tfidf", "weight", "mean_bg", "attribution")


@register(
    "E6 K2",
    with_sql(
        GIVEN,
        ATTRIBUTIONS
        + """, r AS (SELECT id, term, round(attribution, 9) AS attribution FROM att),
        t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY attribution DESC, term)::INTEGER AS up,
                        row_number() OVER (PARTITION BY id ORDER BY attribution, term)::INTEGER AS down FROM r)
        SELECT id, 'top' AS side, up AS rank, term, round(attribution, 6) AS attribution FROM t WHERE up <= 10
        UNION ALL SELECT id, 'bottom', down, term, round(attribution, 6) FROM t WHERE down <= 10""",
    ),
)
def strongest_attributions(spark, sf):
    rounded = _attributions(spark, sf).withColumn("attribution", F.round("attribution", 9))
    return ex.attribution_extremes(rounded).withColumn("attribution", F.round("attribution", 6))


@register(
    "K4",
    with_sql(
        GIVEN,
        ATTRIBUTIONS
        + """ SELECT id, count(*) AS words, true AS agrees FROM (
             SELECT id, row_number() OVER (PARTITION BY id ORDER BY attribution DESC, term) AS rank FROM att)
           WHERE rank <= 5 GROUP BY id""",
    ),
)
def attribution_agreement(spark, sf):
    """The top five attributions of every article recomputed from their parts."""
    checked = ex.attribution_check(_attributions(spark, sf))
    return checked.groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.bool_and("agrees").alias("agrees"))


@register(
    "K4",
    with_sql(
        GIVEN,
        BACKGROUND
        + """, base AS (SELECT label_idx AS prediction, sum(weight * mean_bg) AS base FROM means JOIN coef USING (term_id) GROUP BY 1)
        SELECT c.id, c.prediction, round(sum(contribution), 5) AS score, round(any_value(base), 5) AS base,
               round(sum(contribution) - any_value(base), 5) AS total
        FROM contrib c JOIN base USING (prediction) GROUP BY 1, 2""",
    ),
)
def attribution_totals(spark, sf):
    """The attributions over all terms add up to score minus background score."""
    rows, coef, preds = given(spark, sf)
    out = ex.attribution_total(rows, coef, preds, _background(spark, sf))
    return out.withColumns({c: F.round(c, 5) for c in ("score", "base", "total")})


SCORED = GIVEN + """,
raw AS (SELECT p.id, n.label_idx, coalesce(sum(c.weight * f.tfidf), 0) AS score
        FROM prepared p CROSS JOIN names n LEFT JOIN f ON f.id = p.id LEFT JOIN coef c ON c.term_id = f.term_id AND c.label_idx = n.label_idx
        GROUP BY 1, 2),
e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY id)) AS e FROM raw),
proba AS (SELECT id, label_idx, score, e / sum(e) OVER (PARTITION BY id) AS p,
                 row_number() OVER (PARTITION BY id ORDER BY score DESC, label_idx)::INTEGER AS rank FROM e)"""


def scored_rows(spark, sf):
    """All prepared articles scored with the given coefficients."""
    rows, coef, _ = given(spark, sf)
    return sc.score_rows(rows, coef, [0.0] * len(LANGS), prepared(spark, sf).select("id"))


@register("I5 M1", with_sql(SCORED, "SELECT id, label_idx, round(p, 9) AS probability FROM proba"))
def probabilities_given(spark, sf):
    """The probability of every class for every article."""
    scored = scored_rows(spark, sf)
    return scored.select("id", F.posexplode("probability").alias("label_idx", "p")).select(
        "id", "label_idx", F.round("p", 9).alias("probability")
    )


@register(
    "M1 I5 E3",
    with_sql(
        SCORED,
        """, top AS (SELECT id, label_idx, p FROM proba WHERE rank = 1),
        words AS (SELECT f.id, f.term, c.weight * f.tfidf AS worth, row_number() OVER (PARTITION BY f.id ORDER BY c.weight * f.tfidf DESC, f.term) AS rank
                  FROM f JOIN top USING (id) JOIN coef c ON c.term_id = f.term_id AND c.label_idx = top.label_idx WHERE c.weight * f.tfidf > 0),
        best AS (SELECT id, string_agg(term, ' ' ORDER BY rank) AS words, round(sum(round(worth, 4)), 4) AS total FROM words WHERE rank <= 8 GROUP BY 1)
        SELECT top.id, lang AS topic, round(p, 4) AS confidence, coalesce(words, '') AS words, coalesce(total, 0) AS total
        FROM top JOIN names USING (label_idx) LEFT JOIN best ON best.id = top.id""",
    ),
)
def scored_given(spark, sf):
    """Topic, confidence and explaining words of every article, as a sparse product with given coefficients."""
    return scored_rows(spark, sf).select(
        "id",
        F.get(F.array(*[F.lit(k) for k in LANGS]), F.col("prediction")).alias("topic"),
        F.round(F.array_max("probability"), 4).alias("confidence"),
        F.array_join("top_words.word", " ").alias("words"),
        F.round(F.aggregate("top_words.score", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )


@register(
    "M2 E4",
    with_sql(SCORED, "SELECT id, rank, label_idx AS topic_id, lang AS topic_label, round(p, 4) AS probability FROM proba JOIN names USING (label_idx) WHERE rank <= 3"),
)
def runner_ups_given(spark, sf):
    """The three most probable topics of every article, with name and probability."""
    labels = spark.createDataFrame([(i, i) for i in range(len(LANGS))], "label_idx int, topic_id int")
    info = spark.createDataFrame(list(enumerate(LANGS)), "topic int, name string")
    return sc.runners_up(scored_rows(spark, sf), labels, info, n=3)


# --- trained models ------------------------------------------------------------------------------


class Trained:
    """Vocabulary, stored vectors, split, labels and classifier for the language of an article."""

    def __init__(self, spark, sf):
        folder = scratch_path(spark, "trained")
        self.docs = prepared(spark, sf).select("id", "lang", "text_clean")
        self.vocab = stored_vocab(spark, sf, **FULL)
        tb.write_features(ft.document_features(self.docs.select("id", "text_clean"), self.vocab), f"{folder}/features")
        self.vectors = tb.read_features(spark, f"{folder}/features")
        self.labels = md.label_table(self.docs, "lang")
        coded = md.encode_labels(self.docs.select("id", "lang"), self.labels, "lang")
        sp.stratified_split(coded, "lang").write.parquet(f"{folder}/split")
        self.split = spark.read.parquet(f"{folder}/split")
        self.data = md.labelled_features(self.split, self.vectors)
        self.train = self.data.filter("NOT is_test")
        self.test = self.data.filter("is_test")


#: Parts of the gradient are sums over all training rows, to each of which a row adds 1 at most.
GRADIENT = 0.001

_TRAINED: dict[tuple[str, str], Trained] = {}


def trained(spark, sf) -> Trained:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = Trained(spark, sf)
    return _TRAINED[key]


def classifier(spark, sf):
    t = trained(spark, sf)
    if not hasattr(t, "model"):
        t.model = md.train_logistic(t.train)
        t.coef = md.coef_table(spark, t.model, t.vocab)
        t.info = settled(
            tp.topic_info(
                t.split.withColumnRenamed("label_idx", "topic_id"),
                tp.class_tfidf(t.docs.join(t.labels, "lang"), "label_idx", 10).withColumnRenamed("label_idx", "topic_id"),
            ),
            "topic-info",
        )
    return t


@register("I2 I5 J2")
def logistic_scores(spark, sf):
    """Held-out accuracy and F1 of the linear classifier."""
    t = classifier(spark, sf)
    preds = md.predict(t.model, t.test).select(F.col("label_idx").alias("label"), "prediction")
    return mt.classification_report(preds)


@register("I5")
def class_probabilities(spark, sf):
    t = classifier(spark, sf)
    return md.predict(t.model, t.test).select("id", "label_idx", "prediction", "probability")


@register("M1 I5", with_sql(PREPARED, "SELECT id, true AS agrees FROM prepared"))
def scores_as_the_model_predicts(spark, sf):
    """The sparse product next to the trained model's own prediction, for every article."""
    t = classifier(spark, sf)
    own = md.predict(t.model, t.vectors).select("id", F.col("prediction").alias("p"), F.col("probability").alias("q"))
    rows = ft.tfidf(t.docs.select("id", "text_clean"), t.vocab)
    scored = sc.score_rows(rows, t.coef, t.model.interceptVector.toArray().tolist(), t.docs)
    far = F.array_max(F.zip_with("probability", "q", lambda a, b: F.abs(a - b)))
    return t.docs.select("id").join(scored, "id", "left").join(own, "id", "left").select(
        "id", ((F.col("prediction") == F.col("p")) & (far < 1e-9)).alias("agrees")
    )


@register("I3 I7")
def boosted_scores(spark, sf):
    """Boosted trees against the linear classifier."""
    t = classifier(spark, sf)
    booster = md.train_boosted(t.train)
    sides = [
        md.predict(m, t.test).select(F.lit(name).alias("model"), F.col("label_idx").alias("label"), "prediction")
        for name, m in (("logistic_regression", t.model), ("boosted_trees", booster))
    ]
    return mt.compare_models(sides[0].unionByName(sides[1]), "logistic_regression")


@register("I3")
def forest_scores(spark, sf):
    t = trained(spark, sf)
    forest = md.train_forest(t.train)
    preds = md.predict(forest, t.test).select(F.col("label_idx").alias("label"), "prediction")
    return mt.f1(preds)


@register("I4")
def regularisation_sweep(spark, sf):
    t = trained(spark, sf)
    return md.sweep_c(t.train, t.test)


@register("I6 I9")
def class_coefficients(spark, sf):
    return md.coef_long(classifier(spark, sf).coef)


def _gradients(spark, t, model, C):
    """``label_idx, at_optimum`` on the training rows: no part of the gradient is more than ``GRADIENT`` for each row."""
    ids = t.split.filter("NOT is_test").select("id", "label_idx")
    docs = t.docs.join(ids, "id", "left_semi").select("id", "text_clean")
    rows = settled(ft.tfidf(docs, t.vocab), "training-rows")
    coef = md.coef_rows(spark, model).withColumn("term", F.lit(""))
    scored = sc.score_rows(rows, coef, model.interceptVector.toArray().tolist(), docs)
    found = md.loss_gradient(rows, ids, scored.select("id", "probability"), coef, C)
    return found.select("label_idx", (F.col("largest") < GRADIENT * ids.count()).alias("at_optimum"))


@register("I2", "SELECT unnest([0, 1, 2, 3])::INTEGER AS label_idx, true AS at_optimum")
def logistic_conditions(spark, sf):
    """Is the classifier at the optimum of its penalised loss? The gradient, from stored tables, nearly vanishes."""
    t = classifier(spark, sf)
    return _gradients(spark, t, t.model, 5.0)


@register("A8", with_sql(PREPARED, "SELECT id, true AS same FROM prepared"))
def stored_classifier_predicts_alike(spark, sf):
    """Every article's prediction by the classifier as trained and as stored and opened again."""
    t = classifier(spark, sf)
    path = scratch_path(spark, "classifier")
    md.save_model(t.model, t.labels, path)
    model, _ = md.load_model(spark, path)
    fresh = md.predict(t.model, t.vectors).select("id", F.col("prediction").alias("a"), F.col("probability").alias("p"))
    stored = md.predict(model, t.vectors).select("id", F.col("prediction").alias("b"), F.col("probability").alias("q"))
    return fresh.join(stored, "id").select("id", ((F.col("a") == F.col("b")) & (F.col("p") == F.col("q"))).alias("same"))


@register("A8")
def stored_classifier(spark, sf):
    """Predictions of the classifier after a round trip through storage."""
    t = classifier(spark, sf)
    path = scratch_path(spark, "classifier")
    md.save_model(t.model, t.labels, path)
    model, labels = md.load_model(spark, path)
    return md.decode_labels(md.predict(model, t.test).select("id", "prediction"), labels, "lang")


@register("I8")
def logged_runs(spark, sf):
    """Two runs logged with parameters and metrics, and listed."""
    t = classifier(spark, sf)
    preds = md.predict(t.model, t.test).select(F.col("label_idx").alias("label"), "prediction")
    scores = mt.f1(preds).first()
    path = scratch_path(spark, "runs")
    common = {"model": "LogisticRegression", "C": 5.0, "n_classes": t.model.numClasses, "n_features": t.model.numFeatures}
    tb.append_run(spark, path, "r1", "topics", "logistic_regression", common, {"accuracy": mt.accuracy(preds).first()[0], "f1_macro": scores[0]})
    tb.append_run(spark, path, "r2", "topics", "logistic_regression_eval", common, {"f1_macro": scores[0], "f1_weighted": scores[1]})
    return tb.list_runs(spark, path, "topics").select("run_id", "experiment", "run_name", "model", "accuracy", "f1_macro")


@register("M1")
def scored_articles(spark, sf):
    """Every document scored: topic, name, confidence, explaining words."""
    t = classifier(spark, sf)
    labels = t.labels.select("label_idx", F.col("label_idx").alias("topic_id"))
    new = articles(spark, sf).select("id", "title", "content")
    return sc.score(new, t.model, t.vocab, labels, t.info).drop("probability")


@register("M2 E4")
def runner_up_topics(spark, sf):
    """The five most probable topics of every conversation turn."""
    t = classifier(spark, sf)
    labels = t.labels.select("label_idx", F.col("label_idx").alias("topic_id"))
    talks = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit(None).cast("string").alias("title"),
        F.col("text").alias("content"),
    )
    scored = sc.score(talks, t.model, t.vocab, labels, t.info)
    return sc.runners_up(scored, labels, t.info)


@register("M3 A11")
def scored_text_files(spark, sf):
    """The benchmark passages as plain-text files, read back and scored."""
    t = classifier(spark, sf)
    path = scratch_path(spark, "passages")
    items = table(spark, sf, "benchmark").select("item_id", "text")
    items.repartition("item_id").write.partitionBy("item_id").text(path)
    files = src.read_text_documents(spark, f"{path}/*/*.txt").select(
        F.regexp_extract("path", r"item_id=(\d+)", 1).cast("bigint").alias("id"),
        F.lit(None).cast("string").alias("title"),
        "content",
    )
    labels = t.labels.select("label_idx", F.col("label_idx").alias("topic_id"))
    return sc.score(files, t.model, t.vocab, labels, t.info).drop("probability")
