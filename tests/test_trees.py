"""Trees on sparse rows: cuts, cells, and every level's best cut as plain NumPy finds it."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from corpus_engine.operators import models as md
from corpus_engine.operators import trees as tr


def table(spark, x, y, sparse=True):
    rows = [
        (i, int(k), Vectors.sparse(len(v), [(int(j), float(v[j])) for j in np.flatnonzero(v)]) if sparse else Vectors.dense(v))
        for i, (k, v) in enumerate(zip(y, x))
    ]
    return spark.createDataFrame(rows, ["id", "label_idx", "features"])


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(240, 12)), 3) * (rng.random((240, 12)) < 0.3)
    y = (x[:, 0] > 0.2).astype(int) + 2 * ((x[:, 1] != 0) & (x[:, 2] >= 0)).astype(int)
    return x, y


def plain_boosting(x, y, k, rounds, depth, step):
    """Margins of the rows, cuts as the trainer draws them, one node after the other."""
    sign, margin = np.where(y == k, 1.0, -1.0), np.zeros(len(y))
    cuts = [tr.cuts_of(c[c != 0], 32) for c in x.T]
    for turn in range(rounds):
        lack = sign if turn == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))
        out = np.zeros(len(y))

        def grow(rows, level):
            total, best = lack[rows].sum(), (1e-9, None)
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    left = x[rows, f] <= cut
                    n = left.sum()
                    if 0 < n < len(rows):
                        s = lack[rows][left].sum()
                        gain = s**2 / n + (total - s) ** 2 / (len(rows) - n) - total**2 / len(rows)
                        if gain > best[0] + 1e-4:  # sums travel in single precision
                            best = (gain, left)
            if level == depth or best[1] is None:
                out[rows] = lack[rows].mean()
            else:
                grow(rows[best[1]], level + 1)
                grow(rows[~best[1]], level + 1)

        grow(np.arange(len(y)), 0)
        margin += out * (step if turn else 1.0)
    return margin


def test_boosting_finds_the_cuts_that_plain_counting_finds(spark, planted, monkeypatch):
    monkeypatch.setattr(tr, "KEPT", 2)  # margins are written on the way
    x, y = planted
    df = table(spark, x, y)
    model = md.train_boosted(df, max_iter=5, max_depth=3, subsample=1.0)
    rows = model.transform(df).orderBy("id").collect()
    for k in range(4):
        want = plain_boosting(x, y, k, 5, 3, 0.1)
        assert np.allclose([r.rawPrediction[k] for r in rows], want, atol=1e-3)
    dense = model.transform(table(spark, x, y, sparse=False)).orderBy("id").collect()
    assert [r.rawPrediction for r in dense] == [r.rawPrediction for r in rows]


def test_classes_in_turn_are_classes_side_by_side(spark, planted, monkeypatch):
    x, y = planted
    df = table(spark, x, y)
    one = md.train_boosted(df, max_iter=2, max_depth=2)
    monkeypatch.setattr(tr, "CELLS", 1)
    assert [r[:4] for r in md.train_boosted(df, max_iter=2, max_depth=2).rows] == [r[:4] for r in one.rows]


def test_wide_rows_cost_their_entries_only(spark):
    """A dense copy of these rows has 6 billion numbers."""
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, Vectors.sparse(2_000_000, sorted({i % 2: 1.0, **{int(j): 0.5 for j in rng.integers(2, 2_000_000, 20)}}.items()))) for i in range(3_000)]
    df = spark.createDataFrame(rows, ["id", "label_idx", "features"]).repartition(8)
    model = md.train_boosted(df, max_iter=1, max_depth=1)
    got = md.predict(model, df).select("label_idx", "prediction").collect()
    assert all(r.label_idx == r.prediction for r in got)


def test_forest_learns_and_its_shares_add_up(spark, planted):
    x, y = planted
    df = table(spark, x, y)
    model = md.train_forest(df, trees=20, max_depth=6)
    rows = md.predict(model, df).collect()
    assert all(abs(sum(r.probability) - 1) < 1e-9 and len(r.probability) == 4 for r in rows)
    assert np.mean([r.prediction == r.label_idx for r in rows]) > 0.85


def test_entries_add_up_in_any_portions():
    keys, weights = np.array([3, 1, 3, 7, 1]), np.arange(10.0).reshape(5, 2)
    whole = tr.added_up([keys], [weights], 2)
    first = tr.added_up([keys[:3]], [weights[:3]], 2)
    again = tr.added_up([first[0], keys[3:]], [first[1], weights[3:]], 2)
    assert whole[0].tolist() == again[0].tolist() == [1, 3, 7] and np.array_equal(whole[1], again[1])
    assert tr.added_up([], [], 2)[1].shape == (0, 2)


def test_no_sums_of_boosting_are_moved(spark, planted):
    """A level is one stage: tasks have all rows of their features, and give back the best cuts."""
    df = table(spark, *planted)
    group = "boosting-stages"
    spark.sparkContext.setJobGroup(group, group)
    try:
        stages = []
        for rounds in (2, 4):
            md.train_boosted(df, max_iter=rounds, max_depth=3)
            told = spark.sparkContext.statusTracker()
            stages.append(sum(len(told.getJobInfo(j).stageIds) for j in told.getJobIdsForGroup(group)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    first, both = stages
    # the second training has all stages of the first, and those of two more rounds of three levels
    assert both - 2 * first <= 2 * 3 * (1 + 1)  # a stage, and the shuffle behind the kept columns, which is skipped


def test_rows_of_a_cell_add_up_in_any_chunks(monkeypatch):
    rng = np.random.default_rng(7)
    cells = tr.Cells([np.array(sorted(rng.normal(size=n))) for n in rng.integers(1, 9, 40)])
    dense = rng.normal(size=(300, 40)) * (rng.random((300, 40)) < 0.4)
    row, feature = np.nonzero(dense)
    cell = cells.of(feature, dense[row, feature])
    order = np.argsort(cell, kind="stable")
    block = tr.Columns(0, row[order].astype(np.int32), np.bincount(cell, minlength=len(cells)).astype(np.int32))
    lack, inside, node = rng.normal(size=(2, 300)).astype(np.float32), rng.random(300) < 0.8, rng.integers(0, 3, (2, 300)).astype(np.uint8)
    total = np.array([[(own := inside & (node[k] == u)).sum(), lack[k][own].sum()] for k in range(2) for u in range(2)], float)
    states = []
    for size in (40, 100_000):
        monkeypatch.setattr(tr, "CHUNK", size)
        states.append(dict(tr.best_of_columns(iter([block]), cells, lack, inside, np.minimum(node, 2), total, 2)))
    for unit, (gain, back, right, rows, bits) in states[0].items():
        k, u = divmod(unit, 2)
        f = cells.feature[-back]
        side = dense[:, f] > cells.cut(-back)
        own = inside & (node[k] == u)
        n, s = own.sum(), lack[k][own].sum(dtype=float)
        l, sl = (own & ~side).sum(), lack[k][own & ~side].sum(dtype=float)
        assert np.isclose(gain, sl**2 / l + (s - sl) ** 2 / (n - l) - s**2 / n, atol=1e-4)
        assert sorted(tr._rows(rows, bits, 300)) == np.flatnonzero((node[k] == u) & (side == right)).tolist()
    assert {u: x[1:] for u, x in states[0].items()} == {u: x[1:] for u, x in states[1].items()} and len(states[0]) == 4
