"""Queries over classifier evaluation.

The predictions come from the documents themselves: each language votes with the number of its
typical short words in the text, and the language with most votes is predicted.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_engine.catalog.base import ARTICLES, articles, normalize_sql, register, with_sql
from corpus_engine.functions.text import normalize_text
from corpus_engine.operators import metrics as mt
from corpus_engine.operators.quality import is_subset
from corpus_engine.session import scratch_path
from corpus_engine.sources import tables as tb

LANGS = ("de", "en", "es", "fr")
TYPICAL = {
    "de": ("der", "die", "und", "sch"),
    "en": ("the", "and", "of", "to"),
    "es": ("el", "los", "de", "con"),
    "fr": ("le", "les", "et", "de"),
}


def _count_of(words):
    return F.size(F.filter("w", lambda x: x.isin(list(words))))


def predictions(spark, sf):
    """``(id, label, prediction)`` of every document."""
    words = articles(spark, sf).select(
        "id", "lang", F.split(normalize_text(F.col("content")), " ").alias("w")
    )
    votes = words.select(
        "id",
        "lang",
        *[_count_of(ws).alias(f"v_{k}") for k, ws in TYPICAL.items()],
    )
    most = F.greatest(*[F.col(f"v_{k}") for k in LANGS])
    said = F.coalesce(*[F.when(F.col(f"v_{k}") == most, i) for i, k in enumerate(LANGS)])
    truth = F.array_position(F.array(*[F.lit(k) for k in LANGS]), F.col("lang")) - 1
    return votes.select("id", truth.cast("int").alias("label"), said.cast("int").alias("prediction"))


def _votes_sql() -> str:
    counts = ", ".join(
        f"len(list_filter(w, lambda x: x IN {ws!r})) AS v_{k}" for k, ws in TYPICAL.items()
    )
    said = " ".join(f"WHEN v_{k} = greatest({', '.join('v_' + x for x in LANGS)}) THEN {i}" for i, k in enumerate(LANGS))
    truth = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(LANGS))
    return (
        ARTICLES
        + f""",
split_words AS (SELECT id, lang, string_split({normalize_sql('content')}, ' ') AS w FROM articles),
votes AS (SELECT id, lang, {counts} FROM split_words),
preds AS (SELECT id, CASE lang {truth} END AS label, CASE {said} END AS prediction FROM votes)"""
    )


PREDS = _votes_sql()
SCORES = (
    PREDS
    + """,
classes AS (SELECT label AS class FROM preds UNION SELECT prediction FROM preds),
scores AS (
  SELECT class, tp, support, predicted,
         coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
         coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1
  FROM (SELECT class, (SELECT count(*) FROM preds WHERE label = class AND prediction = class) AS tp,
               (SELECT count(*) FROM preds WHERE label = class) AS support,
               (SELECT count(*) FROM preds WHERE prediction = class) AS predicted FROM classes))"""
)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@register("J1", with_sql(PREDS, "SELECT round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy FROM preds"))
def vote_accuracy(spark, sf):
    return _rounded(mt.accuracy(predictions(spark, sf)), "accuracy")


@register(
    "J2",
    with_sql(SCORES, "SELECT round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM scores"),
)
def vote_f1(spark, sf):
    return _rounded(mt.f1(predictions(spark, sf)), "f1_macro", "f1_weighted")


@register(
    "J3",
    with_sql(
        SCORES,
        """SELECT class::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores
        UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM scores
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM scores
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                         round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM scores""",
    ),
)
def vote_report(spark, sf):
    return _rounded(mt.classification_report(predictions(spark, sf)), "precision", "recall", "f1")


_GRID = """, grid AS (SELECT a.class AS label, b.class AS prediction FROM classes a CROSS JOIN classes b),
cells AS (SELECT g.label, g.prediction, count(p.id) AS n FROM grid g LEFT JOIN preds p USING (label, prediction) GROUP BY 1, 2),
fractions AS (SELECT *, coalesce(n / nullif(sum(n) OVER (PARTITION BY label), 0), 0) AS fraction FROM cells)"""


@register("J4 C5", with_sql(SCORES, _GRID + " SELECT * FROM cells"))
def vote_confusions(spark, sf):
    return mt.confusion_matrix(predictions(spark, sf))


@register("J5 C5", with_sql(SCORES, _GRID + " SELECT label, prediction, n, round(fraction, 6) AS fraction FROM fractions"))
def vote_confusion_shares(spark, sf):
    return _rounded(mt.confusion_matrix(predictions(spark, sf), normalize=True), "fraction")


@register(
    "J6",
    with_sql(
        SCORES,
        _GRID
        + """ SELECT label AS true_topic, prediction AS predicted_as,
                round(CASE WHEN label = prediction THEN 0 ELSE fraction END, 6) AS fraction FROM fractions
              ORDER BY CASE WHEN label = prediction THEN 0 ELSE fraction END DESC, label, prediction LIMIT 5""",
    ),
)
def worst_votes(spark, sf):
    return _rounded(mt.worst_confusions(predictions(spark, sf), 5), "fraction")


@register(
    "J7",
    with_sql(
        PREDS,
        """, b AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label <> 1 AND prediction = 1) AS fp,
                  count(*) FILTER (label = 1 AND prediction <> 1) AS fn, count(*) FILTER (label <> 1 AND prediction <> 1) AS tn FROM preds)
        SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
               round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM b""",
    ),
)
def one_language_against_rest(spark, sf):
    return _rounded(mt.binary_table(predictions(spark, sf), 1), "precision", "recall", "f1")


@register(
    "J8 E9",
    with_sql(
        SCORES,
        """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
           FROM scores ORDER BY scores.f1, class LIMIT 2""",
    ),
)
def hardest_languages(spark, sf):
    return _rounded(mt.hardest_topics(predictions(spark, sf), 2), "precision", "recall", "f1")


@register("J10", with_sql(PREDS, "SELECT * FROM preds WHERE label = prediction ORDER BY label <> 0, id LIMIT 1"))
def a_correct_article(spark, sf):
    return mt.pick_correct(predictions(spark, sf))


@register(
    "J11",
    with_sql(
        SCORES,
        """SELECT CASE WHEN f1 >= 0.9 THEN 'excellent' WHEN f1 >= 0.8 THEN 'good' WHEN f1 >= 0.7 THEN 'challenging' ELSE 'below' END AS tier,
                  count(*) AS classes, sum(support)::BIGINT AS articles FROM scores GROUP BY 1""",
    ),
)
def f1_tier_counts(spark, sf):
    return mt.f1_tiers(predictions(spark, sf))


@register(
    "I7",
    with_sql(
        PREDS,
        """, runs AS (SELECT 'votes' AS model, label, prediction FROM preds UNION ALL SELECT 'majority', label, 1 FROM preds),
        cl AS (SELECT DISTINCT model, unnest([label, prediction]) AS class FROM runs),
        sc AS (SELECT c.model, class,
                 (SELECT count(*) FROM runs b WHERE b.model = c.model AND b.label = class AND b.prediction = class) AS tp,
                 (SELECT count(*) FROM runs b WHERE b.model = c.model AND b.label = class) AS s,
                 (SELECT count(*) FROM runs b WHERE b.model = c.model AND b.prediction = class) AS p FROM cl c),
        m AS (SELECT model, sum(tp) / sum(s) AS accuracy, avg(2 * tp / (s + p)) AS f1_macro FROM sc GROUP BY 1)
        SELECT model, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro,
               row_number() OVER (ORDER BY m.f1_macro DESC, model = 'votes' DESC) = 1 AS winner FROM m""",
    ),
)
def model_comparison(spark, sf):
    """Word votes against always naming the biggest class."""
    votes = predictions(spark, sf)
    both = votes.withColumn("model", F.lit("votes")).unionByName(
        votes.withColumn("model", F.lit("majority")).withColumn("prediction", F.lit(1))
    )
    return _rounded(mt.compare_models(both, "votes"), "accuracy", "f1_macro")


@register("N4 N3", with_sql(PREDS, "SELECT DISTINCT prediction FROM preds WHERE prediction NOT IN (SELECT label FROM preds)"))
def predictions_outside_labels(spark, sf):
    """Empty when every predicted class is a known one."""
    preds = predictions(spark, sf)
    known = preds.select(F.col("label").alias("prediction"))
    return is_subset(preds, known, "prediction")


@register(
    "I8",
    with_sql(
        SCORES,
        """, accuracy AS (SELECT round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy FROM preds),
        f1 AS (SELECT round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM scores)
        SELECT 'votes-1' AS run_id, 'vote' AS run_name, '4' AS classes, accuracy, f1_macro, NULL::DOUBLE AS f1_weighted FROM accuracy, f1
        UNION ALL SELECT 'votes-2', 'vote_eval', '4', NULL, f1_macro, f1_weighted FROM f1""",
    ),
)
def logged_vote_runs(spark, sf):
    """Two runs of the votes logged with parameters and metrics, another experiment's among them, and listed."""
    path = scratch_path(spark, "runs")
    preds = predictions(spark, sf)
    accuracy, scores = mt.accuracy(preds).first()[0], mt.f1(preds).first()
    params = {"model": "votes", "classes": len(LANGS)}
    tb.append_run(spark, path, "votes-1", "languages", "vote", params, {"accuracy": accuracy, "f1_macro": scores[0]})
    tb.append_run(spark, path, "other", "topics", "vote", params, {"accuracy": 1.0})
    tb.append_run(spark, path, "votes-2", "languages", "vote_eval", params, {"f1_macro": scores[0], "f1_weighted": scores[1]})
    runs = tb.list_runs(spark, path, "languages")
    numbers = {n: F.round(F.try_element_at("metrics", F.lit(n)), 6) for n in ("accuracy", "f1_macro", "f1_weighted")}
    return runs.select(
        "run_id", "run_name", F.try_element_at("params", F.lit("classes")).alias("classes"), *(c.alias(n) for n, c in numbers.items())
    )
