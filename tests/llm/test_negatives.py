"""Hard negatives next to all pairs, and what a cover tree promises."""

import math

import numpy as np
import pytest

from corpus_engine.llm import negatives

KIND = "vec_id long, label string, embedding array<double>"


def plain(rows, is_anchor, positives=5, negs=3):
    whole = [
        (i, label, [max(-negatives.LARGEST, min(negatives.LARGEST, math.floor(256 * x))) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, label, v) in enumerate(whole):
        if not is_anchor(anchor):
            continue
        scored = [(-sum(x * y for x, y in zip(v, u)), i, other) for b, (i, other, u) in enumerate(whole) if b != a]
        scored.sort(key=lambda s: s[:2])
        for back, positive, _ in [s for s in scored if s[2] == label][:positives]:
            hard = [s for s in scored if s[2] != label and 50 * -back <= 100 * -s[0] <= 95 * -back][:negs]
            out += [(anchor, positive, rank, i, -back, -b) for rank, (b, i, _) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, parts=3):
    df = spark.createDataFrame(rows, KIND).repartition(parts)
    got = negatives.mine(df, df.where("vec_id % 5 = 0")).collect()
    return sorted(tuple(r) for r in got)


def clustered(n, dims, seed, copies=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dims))
    rows = []
    for i in range(n):
        x = centres[draw.integers(12)] + draw.normal(size=dims) * draw.choice([0.02, 0.3])
        rows.append((int(i), "abc"[int(draw.integers(3))], [float(v) for v in x]))
    for k in range(copies):
        _, label, v = rows[int(draw.integers(10))]
        rows.append((n + k, label if k % 3 else "c", v))
    return rows


@pytest.mark.parametrize("copies", [0, 120])
def test_results_equal_those_of_all_pairs(spark, monkeypatch, copies):
    for name, value in (("BLOCK", 64), ("QUERIES", 16), ("LEAF", 4), ("CHUNK", 8)):
        monkeypatch.setattr(negatives, name, value)
    rows = clustered(300, 6, 3, copies)
    want = plain(rows, lambda i: i % 5 == 0)
    assert len(want) > 300
    assert mined(spark, rows) == want


def test_ties_zeros_negative_scores_and_repeated_ids(spark):
    rows = [(i, "a" if i % 2 else "b", [0.0, 0.0]) for i in range(12)]
    rows += [(20 + i, "a" if i % 2 else "b", [1.0, 0.0]) for i in range(10)]
    rows += [(40 + i, "a" if i % 2 else "b", [0.75, 0.25 * (i % 3)]) for i in range(10)]
    rows += [(60, "z", [-1.0, 0.0]), (65, "z", [1.0, 0.0]), (20, "b", [1.0, 0.0]), (20, "b", [0.9, 0.1]), (45, "a", [0.75, 0.5])]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_rows_that_take_no_part_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, "a", [1.0, 1.0]), (6, "a", [1.0, 0.9]), (7, "b", [0.7, 0.7]), (10, None, [1.0, 1.0]), (None, "b", [0.8, 0.8]),
        (15, "a", None), (20, "a", [1.0, None]), (25, "b", [nan, 0.8]), (8, "b", [inf, 0.8]), (30, "a", []), (9, "b", [0.75]),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], KIND + ", q int, tree string, score int")
    filled = [(i, label, v if v is None else v + [0.0] * (2 - len(v))) for i, label, v in rows]
    got = sorted(tuple(r) for r in negatives.mine(df, df.where("vec_id % 5 = 0")).collect())
    assert got == plain(filled, lambda i: i % 5 == 0) and got
    assert negatives.mine(df.limit(0), df.limit(0)).count() == 0
    assert negatives.mine(df, df.limit(0)).count() == 0
    assert negatives.mine(df.where("vec_id = 20"), df).count() == 0


def test_large_components_are_summed_without_rounding(spark):
    big = 2.0**25 + 1 / 256
    rows = [(5, "a", [big, 1.0]), (6, "a", [big, 0.0]), (7, "b", [big * 0.9, 3.0]), (8, "b", [1e300, -1e300]), (9, "b", [big * 0.9, 2.0])]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_a_long_list_of_equal_vectors(spark):
    rows = [(i, "a" if i % 3 else "b", [0.5, 0.5]) for i in range(3000)] + [(5000 + i, "b", [0.4, 0.4 + i / 100]) for i in range(9)]
    want = plain(rows[:20] + rows[3000:], lambda i: i == 10)
    df = spark.createDataFrame(rows, KIND).repartition(6)
    got = negatives.mine(df, df.where("vec_id in (10, 2500)")).collect()
    assert sorted(tuple(r) for r in got if r.anchor_id == 10) == want
    assert {r.positive_id for r in got if r.anchor_id == 2500} == {1, 2, 4, 5, 7}


@pytest.mark.parametrize("seed", [1, 2])
def test_cover_tree(seed):
    draw = np.random.default_rng(seed)
    x = np.concatenate([c + draw.normal(size=(150, 3)) * s for c, s in zip(draw.normal(size=(4, 3)) * 9, (0.01, 0.5, 2, 0))])
    order, nodes = negatives.cover_tree(x)
    assert sorted(order.tolist()) == list(range(len(x)))
    for centre, parent, reach, first, end in nodes:
        rows = x[order[first:end]]
        assert np.linalg.norm(rows - x[centre], axis=1).max() <= reach + 1e-9
        if parent >= 0:
            assert nodes[parent][3] <= first < end <= nodes[parent][4]
    children: dict[int, list] = {}
    for k, node in enumerate(nodes):
        children.setdefault(node[1], []).append(k)
    for k, below in children.items():
        if k >= 0:
            covered = sorted((nodes[b][3], nodes[b][4]) for b in below)
            assert [a for a, _ in covered] + [nodes[k][4]] == [nodes[k][3]] + [b for _, b in covered]
    leaves = [k for k in range(len(nodes)) if k not in children]
    assert len(leaves) > 4 and max(nodes[k][4] - nodes[k][3] for k in leaves) <= 150


def test_a_search_skips_nodes(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 8)
    draw = np.random.default_rng(4)
    x = np.concatenate([draw.normal(size=(1, 5)) * 2000 + draw.normal(size=(100, 5)) * 5 for _ in range(10)]).round().astype(np.int64)
    longest = float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max()))
    order, nodes = negatives.cover_tree(negatives._lifted(x.astype(float), longest))
    place = np.argsort(order)
    tree = negatives.Tree(x[order], np.array(["a"] * 1000), np.arange(1000), [(int(place[c]), *r) for c, *r in nodes], longest)
    read = []
    inner = tree._verify
    tree._verify = lambda best, q, x, l, who, node, *rest: (read.append(len(who) * (nodes[node][4] - nodes[node][3])), inner(best, q, x, l, who, node, *rest))
    queries = x[::100]
    n = len(queries)
    full = lambda v: np.full((n, 1), v)
    best = tree.search(queries, np.array(["a"] * n), full(negatives.LEAST), full(negatives.MOST), full(negatives.LEAST), 3, True)
    want = -np.sort(-(queries @ x.T), axis=1)[:, :3]
    assert (best.score[:, 0] == want).all()
    assert sum(read) < 0.5 * n * 1000
