"""Topics: planted clusters, assignment, keywords, numbering."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_engine.operators import density as dn
from corpus_engine.operators import topics as tp


@pytest.fixture(scope="module")
def blobs(spark):
    """Three dense blobs of unequal size and scattered noise."""
    rng = np.random.default_rng(5)
    sizes, centres = (150, 90, 60), ((0, 0, 0), (10, 0, 0), (0, 10, 5))
    rows, truth = [], {}
    for k, (n, c) in enumerate(zip(sizes, centres)):
        for x in rng.normal(c, 0.5, (n, 3)):
            truth[len(rows)] = k
            rows.append((len(rows), [float(v) for v in x]))
    for x in rng.uniform(-30, 40, (40, 3)):
        truth[len(rows)] = -1
        rows.append((len(rows), [float(v) for v in x]))
    return spark.createDataFrame(rows, "id long, embedding array<double>").cache(), truth


def test_nearest_neighbours_are_exact(spark, blobs):
    df, _ = blobs
    points = {r.id: np.array(r.embedding) for r in df.collect()}
    got = {}
    for r in dn.nearest_neighbours(df, 4).collect():
        got.setdefault(r.src, []).append(r.distance)
    for i in (0, 100, 200, 335):
        want = sorted(float(np.linalg.norm(points[i] - p)) for j, p in points.items() if j != i)[:4]
        assert sorted(got[i]) == pytest.approx(want)


def test_connected_components_match_union_find(spark):
    rng = np.random.default_rng(1)
    edges = [(lv, int(a), int(b)) for lv in (0, 1) for a, b in rng.integers(0, 120, (60 + 40 * lv, 2))]
    edges += [(0, 500, i) for i in range(501, 540)] + [(1, i, i + 1) for i in range(600, 640)]
    nodes = {(lv, n) for lv, a, b in edges for n in (a, b)} | {(0, 999)}
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for lv, a, b in edges:
        x, y = sorted((find((lv, a)), find((lv, b))))
        root[y] = x
    got = dn.connected_components(
        spark.createDataFrame(edges, "level int, a long, b long"),
        spark.createDataFrame(list(nodes), "level int, node long"),
    )
    assert {(r.level, r.node): r.component for r in got.collect()} == {n: find(n)[1] for n in nodes}


def test_density_clusters_find_the_blobs_and_the_noise(blobs):
    df, truth = blobs
    got = {r.id: r.topic_id for r in dn.density_clusters(df, min_cluster_size=20, min_pts=8).collect()}
    assert set(got.values()) == {-1, 0, 1, 2}
    right = sum(got[i] == truth[i] for i in truth)
    assert right / len(truth) > 0.9
    assert sum(got[i] == -1 for i in truth if truth[i] == -1) >= 30


def test_kmeans_with_noise(blobs):
    df, truth = blobs
    shifted = df.select("id", F.transform("embedding", lambda x: x + 1.0).alias("embedding"))
    rows = tp.kmeans_topics(shifted, k=3, noise_quantile=0.8).collect()
    assert {r.topic_id for r in rows} <= {-1, 0, 1, 2}
    noise = sum(r.topic_id == -1 for r in rows)
    assert 0.1 * len(rows) < noise < 0.3 * len(rows)


def test_assignment_matches_brute_force_and_radius(spark, blobs):
    df, truth = blobs
    labelled = df.join(spark.createDataFrame(list(truth.items()), "id long, topic_id int"), "id")
    centres = {r.topic_id: np.array(r.centroid) for r in tp.topic_centroids(labelled).collect()}
    assert set(centres) == {0, 1, 2}
    points = {r.id: np.array(r.embedding) for r in df.collect()}
    found = tp.assign_topics(df, tp.topic_centroids(labelled), 3.0, metric="euclidean").collect()
    for r in found:
        d, t = min((float(np.linalg.norm(points[r.id] - c)), k) for k, c in centres.items())
        assert r.distance == pytest.approx(d) and r.topic_id == (t if d <= 3.0 else -1)


def test_embeddings_are_unit_vectors_and_alike_for_alike_texts(spark):
    rows = [(1, "a", 0.6), (1, "b", 0.8), (2, "a", 0.6), (2, "b", 0.8), (3, "zz", 1.0)]
    features = spark.createDataFrame(rows, "id long, term string, tfidf double")
    got = {r.id: np.array(r.embedding) for r in tp.embed_documents(features, 64).collect()}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 and len(v) == 64 for v in got.values())
    assert got[1] @ got[2] == pytest.approx(1.0, abs=1e-6) and abs(got[1] @ got[3]) < 0.99


def test_reduced_dimensions(blobs):
    df, _ = blobs
    assert {len(r.embedding) for r in tp.reduce_dims(df, k=2).collect()} == {2}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, t, txt) for i, (t, txt) in enumerate(
        [(5, "goal match goal")] * 3 + [(9, "court law judge")] * 4 + [(2, "rates bank rates")] * 4 + [(-1, "misc words here")] * 2
    )]
    return spark.createDataFrame(rows, "id long, topic_id int, text_clean string")


def test_topics_are_numbered_by_size(labelled):
    got = {r.id: r.topic_id for r in tp.renumber_topics(labelled).collect()}
    assert [got[i] for i in (0, 3, 7, 11)] == [2, 1, 0, -1]


def test_class_weights_follow_the_formula(labelled):
    weights = {(r.topic_id, r.term): r.weight for r in tp.class_term_weights(labelled, "topic_id").collect()}
    mean = (9 + 12 + 12 + 6) / 4
    assert weights[(5, "goal")] == pytest.approx(6 / 9 * math.log(1 + mean / 6))
    assert weights[(9, "law")] == pytest.approx(4 / 12 * math.log(1 + mean / 4))


def test_topic_dimension_and_listing(labelled):
    info = tp.topic_info(labelled, tp.class_tfidf(labelled, "topic_id", 10))
    rows = {r.topic: r for r in info.collect()}
    assert rows[5].name == "5_goal_match" and rows[9].representation == ["court", "judge", "law"]
    listing = tp.describe_topics(info).collect()
    assert [r.topic for r in listing] == [2, 5, 9] and abs(sum(r.pct for r in listing) - 100) < 0.2
    assert listing[2].keywords == "court, judge, law"
    named = tp.label_articles(labelled, info)
    assert named.count() == 11 and named.filter("topic_label LIKE '%goal%'").count() == 3
    assert [r.topic for r in tp.topics_matching(info, ["LAW"]).collect()] == [9]
    assert tp.label_status(labelled).first().outliers == 2
    assert tp.topic_totals(info).first().topics == 3
    assert [r.topic for r in tp.biggest_topics(info, 2).collect()] == [2, 9]


def test_nearest_neighbours_over_many_cells_and_equal_points(spark, monkeypatch):
    monkeypatch.setattr(dn, "CELL_ROWS", 20)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 1, 3).tolist()) for i in range(150)] + [(200 + i, [5.0, 5.0, 5.0]) for i in range(60)]
    rows += [(300, [100.0, 0.0, 0.0])]
    got = {}
    for r in dn.nearest_neighbours(spark.createDataFrame(rows, "id long, embedding array<double>"), 5).collect():
        got.setdefault(r.src, []).append(r.distance)
    points = np.array([x for _, x in rows])
    for k, (i, x) in enumerate(rows):
        want = np.sort(np.delete(np.linalg.norm(points - np.array(x), axis=1), k))[:5]
        assert np.allclose(sorted(got[i]), want)


def test_no_points_and_no_centroids(spark):
    none = spark.createDataFrame([], "id long, embedding array<double>")
    assert dn.nearest_neighbours(none, 3).count() == 0
    points = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<double>")
    centroids = spark.createDataFrame([], "topic_id int, centroid array<double>")
    assert [r.topic_id for r in tp.assign_topics(points, centroids).collect()] == [-1]
    own = spark.createDataFrame([(0, [1.0, 1.0], 0.5), (1, [3.0, 0.0], 2.5)], "topic_id int, centroid array<double>, radius double")
    assert [r.topic_id for r in tp.assign_topics(points, own, metric="euclidean").collect()] == [-1]
