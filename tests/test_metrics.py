"""Metrics against plain Python on a table with a class that is never predicted."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus_engine.operators import metrics as mt

random.seed(3)
PAIRS = [(c, c if random.random() < 0.7 else random.choice([0, 1, 2, 4])) for c in [0] * 40 + [1] * 25 + [2] * 10 + [3] * 3]


@pytest.fixture(scope="module")
def preds(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(PAIRS)]
    return spark.createDataFrame(rows, "id long, label int, prediction int").cache()


def scores():
    out = {}
    for c in {x for p in PAIRS for x in p}:
        tp = sum(1 for a, b in PAIRS if a == b == c)
        support, said = sum(a == c for a, _ in PAIRS), sum(b == c for _, b in PAIRS)
        p, r = (tp / said if said else 0.0), (tp / support if support else 0.0)
        out[c] = (p, r, 2 * p * r / (p + r) if p + r else 0.0, support)
    return out


def test_report(preds):
    want = scores()
    rows = {r["class"]: r for r in mt.classification_report(preds).collect()}
    for c, (p, r, f, s) in want.items():
        got = rows[str(c)]
        assert (got.precision, got.recall, got.f1, got.support) == (pytest.approx(p), pytest.approx(r), pytest.approx(f), s)
    n = len(PAIRS)
    assert rows["accuracy"].f1 == pytest.approx(sum(a == b for a, b in PAIRS) / n)
    assert rows["macro avg"].f1 == pytest.approx(sum(x[2] for x in want.values()) / len(want))
    assert rows["weighted avg"].recall == pytest.approx(sum(x[1] * x[3] for x in want.values()) / n)
    f1 = mt.f1(preds).first()
    assert f1.f1_macro == pytest.approx(rows["macro avg"].f1) and f1.f1_weighted == pytest.approx(rows["weighted avg"].f1)


def test_confusion_is_dense_and_rows_add_up(preds):
    cells = mt.confusion_matrix(preds, normalize=True).collect()
    count = Counter(PAIRS)
    classes = {x for p in PAIRS for x in p}
    assert {(r.label, r.prediction): r.n for r in cells} == {(a, b): count[(a, b)] for a in classes for b in classes}
    for c in classes:
        total = sum(r.fraction for r in cells if r.label == c)
        assert total == pytest.approx(1.0 if any(a == c for a, _ in PAIRS) else 0.0)
    worst = mt.worst_confusions(preds, 3).collect()
    assert all(r.true_topic != r.predicted_as for r in worst) and worst[0].fraction >= worst[-1].fraction


def test_binary_table_and_hardest(preds):
    row = mt.binary_table(preds, 0).first()
    want = scores()[0]
    assert (row.precision, row.recall, row.f1) == tuple(pytest.approx(x) for x in want[:3])
    assert row.tp + row.fp + row.fn + row.tn == len(PAIRS)
    assert mt.hardest_topics(preds, 1).first().f1 == min(x[2] for x in scores().values())


def test_pick_correct_and_tiers(preds):
    assert mt.pick_correct(preds).first().label == 0
    only_two = preds.filter("label = 2")
    assert mt.pick_correct(only_two).first().label == 2
    assert sum(r.classes for r in mt.f1_tiers(preds).collect()) == len(scores())


def test_ties_go_to_the_preferred_model(preds):
    both = preds.withColumn("model", F.lit("linear")).unionByName(preds.withColumn("model", F.lit("trees")))
    for preferred in ("linear", "trees"):
        won = [r.model for r in mt.compare_models(both, preferred).filter("winner").collect()]
        assert won == [preferred]
