"""Queries over topics: vectors, clusters, keywords, the topic dimension.

Where a query needs articles with topics, the topic is the article's language number, and articles
without a label row are the outliers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_engine.catalog.base import (
    PREPARED,
    prepared,
    register,
    table,
    tfidf_sql,
    with_sql,
)
from corpus_engine.catalog.evaluation import LANGS
from corpus_engine.catalog.text import FULL, weights
from corpus_engine.operators import profile as pf
from corpus_engine.operators import topics as tp
from corpus_engine.operators import density as dn
from corpus_engine.operators.density import density_clusters, nearest_neighbours
from corpus_engine.operators.topk import with_sorted_index
from corpus_engine.session import scratch_path, settled
from corpus_engine.sources import tables as tb


def class_weights_sql(source: str, column: str) -> str:
    return f"""
ct AS (SELECT {column} AS class, term, count(*) AS tf FROM (SELECT {column}, unnest(words) AS term FROM {source}) GROUP BY 1, 2),
tot AS (SELECT class, sum(tf) AS total FROM ct GROUP BY 1),
cw AS (SELECT class, term, tf, tf / total * ln(1 + (SELECT avg(total) FROM tot) / sum(tf) OVER (PARTITION BY term)) AS weight
       FROM ct JOIN tot USING (class))"""


def _top_words_sql(column: str, n: int) -> str:
    return with_sql(
        PREPARED,
        f""",{class_weights_sql('worded', column)}
        SELECT class AS {column}, rank, term, round(weight, 6) AS weight FROM (
          SELECT *, row_number() OVER (PARTITION BY class ORDER BY weight DESC, term)::INTEGER AS rank FROM cw) WHERE rank <= {n}""",
    )


@register("H5 E2", _top_words_sql("lang", 10))
def words_per_language(spark, sf):
    """Which ten words set each language's articles apart?"""
    return tp.class_tfidf(prepared(spark, sf), "lang", 10).withColumn("weight", F.round("weight", 6))


@register("H5", _top_words_sql("publication", 5))
def words_per_outlet(spark, sf):
    return tp.class_tfidf(prepared(spark, sf), "publication", 5).withColumn("weight", F.round("weight", 6))


# --- supplied vectors --------------------------------------------------------------------------


def _labelled_vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", F.col("label").alias("topic_id")
    )


_CENTROIDS = """
x AS (SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(v) AS v FROM x GROUP BY 1, 2),
mean AS (SELECT label, list(v ORDER BY i) AS centroid FROM m GROUP BY 1)"""


@register("H4 C6", with_sql(_CENTROIDS, "SELECT label AS topic_id, len(centroid)::INTEGER AS dims, round(list_sum(centroid), 5) AS total FROM mean"))
def topic_centres(spark, sf):
    centres = tp.topic_centroids(_labelled_vectors(spark, sf))
    return centres.select(
        "topic_id",
        F.size("centroid").alias("dims"),
        F.round(F.aggregate("centroid", F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
    )


_NEAREST = (
    _CENTROIDS
    + """,
pairs AS (SELECT e.vec_id AS id, mean.label AS topic, 1 - list_cosine_similarity(e.embedding::DOUBLE[], centroid) AS d
          FROM embeddings e CROSS JOIN mean),
best AS (SELECT id, arg_min(topic, d) AS topic, min(d) AS d FROM pairs GROUP BY 1)"""
)


@register(
    "H4 C6",
    with_sql(_NEAREST, "SELECT id, (CASE WHEN d <= 0.7 THEN topic ELSE -1 END)::INTEGER AS topic_id, round(d, 5) AS distance FROM best"),
)
def nearest_topic(spark, sf):
    """Nearest of the label centres by cosine; farther than 0.7 is an outlier."""
    vectors = _labelled_vectors(spark, sf)
    found = tp.assign_topics(vectors.drop("topic_id"), tp.topic_centroids(vectors), 0.7)
    return found.select("id", "topic_id", F.round("distance", 5).alias("distance"))


_EUCLID = (
    _CENTROIDS
    + """,
pairs AS (SELECT e.vec_id AS id, mean.label AS topic, list_distance(e.embedding::DOUBLE[], centroid) AS d
          FROM embeddings e CROSS JOIN mean),
best AS (SELECT id, arg_min(topic, d) AS topic, min(d) AS d FROM pairs GROUP BY 1)"""
)


@register("H4 C6", with_sql(_EUCLID, "SELECT id, topic::INTEGER AS topic_id, round(d, 5) AS distance FROM best"))
def nearest_topic_euclidean(spark, sf):
    vectors = _labelled_vectors(spark, sf)
    found = tp.assign_topics(vectors.drop("topic_id"), tp.topic_centroids(vectors), metric="euclidean")
    return found.select("id", "topic_id", F.round("distance", 5).alias("distance"))


@register("H2")
def reduced_vectors(spark, sf):
    """Five principal components of the supplied vectors."""
    return tp.reduce_dims(_labelled_vectors(spark, sf).select("id", "embedding"), k=5)


@register("H2", "SELECT unnest(range(5))::INTEGER AS component, true AS unit, true AS holds")
def component_conditions(spark, sf):
    """Do the principal components satisfy their equation? Covariance times component is variance times component.

    The product is a sum over rows of projection times centred vector; no covariance matrix is made."""
    vectors = _labelled_vectors(spark, sf).select("id", F.col("embedding").cast("array<double>").alias("x"))
    model = tp.fit_reducer(vectors, "x", 5)
    parts = [(k, j, float(v)) for j, row in enumerate(model.pc.toArray()) for k, v in enumerate(row)]
    loads = settled(spark.createDataFrame(parts, "component int, axis int, load double"), "loads")
    cells = vectors.select("id", F.posexplode("x").alias("axis", "v"))
    means = settled(cells.groupBy("axis").agg(F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n")), "means")
    centred = cells.join(means, "axis").select("id", "axis", (F.col("v") - F.col("mean")).alias("v"), "n")
    scores = centred.join(loads, "axis").groupBy("id", "component").agg(F.sum(F.col("v") * F.col("load")).alias("z"))
    products = centred.join(scores, "id").groupBy("component", "axis").agg(
        (F.sum(F.col("z") * F.col("v")) / (F.max("n") - 1)).alias("product"),
        (F.sum(F.col("z") * F.col("z")) / (F.max("n") - 1)).alias("variance"),
    )
    checked = products.join(loads, ["component", "axis"])
    return checked.groupBy("component").agg(
        (F.abs(F.sum(F.col("load") * F.col("load")) - 1) < 1e-9).alias("unit"),
        (F.max(F.abs(F.col("product") - F.col("variance") * F.col("load"))) < 1e-9).alias("holds"),
    )


@register("H3b H4", "SELECT unnest(range(10))::INTEGER AS cluster, true AS nearest, true AS mean")
def kmeans_conditions(spark, sf):
    """Has k-means ended? Every vector belongs to its nearest centre, and every centre is the mean direction of its own."""
    vectors = _labelled_vectors(spark, sf).select("id", F.col("embedding").cast("array<double>").alias("x"))
    centres = settled(tp.fit_kmeans(vectors, 10, "x"), "centres")
    placed = settled(
        tp.assign_topics(vectors, centres.select(F.col("cluster").alias("topic_id"), F.col("centre").alias("centroid")), column="x"),
        "placed",
    )
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, e: t + e * e))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, e: t + e)
    every = centres.select("cluster", F.col("centre").alias("c"))
    far = F.lit(1.0) - dot("x", "c") / (length("x") * length("c"))
    best = placed.join(F.broadcast(every), F.lit(True)).groupBy("id", "topic_id", "distance").agg(F.min(far).alias("least"))
    nearest = best.groupBy(F.col("topic_id").alias("cluster")).agg(F.bool_and(F.col("distance") <= F.col("least") + 1e-9).alias("nearest"))
    sums = placed.select(F.col("topic_id").alias("cluster"), F.posexplode(F.transform("x", lambda e: e / length("x"))).alias("axis", "v"))
    means = sums.groupBy("cluster", "axis").agg(F.sum("v").alias("v")).groupBy("cluster").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("axis", "v"))), lambda e: e["v"]).alias("m")
    )
    same = F.lit(1.0) - dot("m", "centre") / (length("m") * length("centre")) < 1e-6
    return nearest.join(means.join(centres, "cluster"), "cluster").select("cluster", "nearest", same.alias("mean"))


@register("H3b")
def kmeans_topic_ids(spark, sf):
    return tp.kmeans_topics(_labelled_vectors(spark, sf), k=10, noise_quantile=0.8)


@register("H3")
def density_topic_ids(spark, sf):
    """Density clusters of the supplied vectors in five dimensions."""
    reduced = tp.reduce_dims(_labelled_vectors(spark, sf).select("id", "embedding"), k=5)
    return density_clusters(reduced, min_cluster_size=20)


@register(
    "H3",
    """WITH p AS (SELECT a.vec_id AS id, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d
               FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    r AS (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d) AS k FROM p)
    SELECT id, round(d, 5) AS core FROM r WHERE k = 5""",
)
def core_distances(spark, sf):
    """How far the fifth nearest other vector of every vector lies."""
    near = nearest_neighbours(_labelled_vectors(spark, sf), 5)
    return near.groupBy(F.col("src").alias("id")).agg(F.round(F.max("distance"), 5).alias("core"))


def _tree_sql(min_pts: int) -> str:
    """CTEs down to ``tree(k, a, b, w)``, the edges of the spanning tree by weight: the nearest point outside joins."""
    return f"""
p AS (SELECT (row_number() OVER (ORDER BY vec_id))::INTEGER AS i, vec_id, embedding::DOUBLE[] AS x FROM embeddings),
d AS (SELECT a.i, b.i AS j, sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
      FROM p a JOIN p b ON a.i <> b.i),
core AS (SELECT i, max(d) AS core FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d) AS k FROM d) WHERE k <= {min_pts} GROUP BY 1),
w AS (SELECT d.i, j, greatest(d, c.core, e.core) AS w FROM d JOIN core c ON c.i = d.i JOIN core e ON e.i = d.j
      UNION ALL SELECT i, i, 'infinity'::DOUBLE FROM p),
rows_of AS (SELECT i, list(w ORDER BY j) AS w FROM w GROUP BY 1),
prim AS (
  SELECT 0 AS step, 1 AS now, 0 AS source, 0::DOUBLE AS w, list_transform(w, lambda x, k: k = 1) AS seen, w AS best, list_transform(w, lambda x: 1) AS origin
  FROM rows_of WHERE i = 1
  UNION ALL
  SELECT n.step + 1, n.now, n.origin[n.now], n.best[n.now], list_transform(n.seen, lambda x, k: x OR k = n.now),
         list_transform(n.best, lambda x, k: least(x, r.w[k])), list_transform(n.origin, lambda x, k: CASE WHEN r.w[k] < n.best[k] THEN n.now ELSE x END)
  FROM (SELECT *, list_position(list_transform(best, lambda x, k: CASE WHEN seen[k] THEN 'infinity'::DOUBLE ELSE x END),
                                list_min(list_transform(best, lambda x, k: CASE WHEN seen[k] THEN 'infinity'::DOUBLE ELSE x END))) AS now
        FROM (SELECT * EXCLUDE (now) FROM prim)) n JOIN rows_of r ON r.i = n.now
  WHERE n.step < (SELECT count(*) FROM p) - 1),
tree AS (SELECT row_number() OVER (ORDER BY w, step) AS k, source AS a, now AS b, w FROM prim WHERE step > 0)"""


@register("H3", f"WITH RECURSIVE {_tree_sql(5)} SELECT k AS rank, round(w, 6) AS weight FROM tree")
def spanning_edges(spark, sf):
    """How far apart the parts of the supplied vectors are when they join, from the first to the last."""
    edges = dn.spanning_edges(_labelled_vectors(spark, sf), 5)
    ranked = with_sorted_index(edges.select(F.struct("weight", "a", "b").alias("edge")), "edge", "rank")
    return ranked.select((F.col("rank") + 1).alias("rank"), F.round("edge.weight", 6).alias("weight"))


def _clusters_sql(min_pts: int, size: int) -> str:
    """Components at every weight of the tree; those of ``size`` points linked upwards are chains, and a chain
    between two forks is a cluster. What a cluster is worth is added up from the inside out."""
    return f"""WITH RECURSIVE {_tree_sql(min_pts)},
parts AS (
  SELECT 0 AS k, (SELECT list(i ORDER BY i) FROM p) AS part
  UNION ALL
  SELECT t.k, list_transform(part, lambda c: CASE WHEN c = part[t.b] THEN part[t.a] ELSE c END) FROM parts JOIN tree t ON t.k = parts.k + 1),
levels AS (SELECT max(k) AS k, row_number() OVER (ORDER BY w) AS level, 1 / greatest(w, (SELECT min(w) FROM tree WHERE w > 0)) AS density
           FROM tree GROUP BY w),
at_level AS (SELECT level, density, part, lead(part) OVER (ORDER BY level) AS next, lead(density) OVER (ORDER BY level) AS after
             FROM levels JOIN parts USING (k)),
members AS (SELECT level, density, after, next, unnest(part) AS c, generate_subscripts(part, 1) AS i FROM at_level),
large AS (SELECT level, c, count(*) AS n, any_value(density) AS density, any_value(after) AS after, any_value(next)[c] AS up
          FROM members GROUP BY level, c HAVING count(*) >= {size}),
forked AS (SELECT l.*, (SELECT count(*) FROM large b WHERE b.level = l.level - 1 AND b.up = l.c) AS inner_ones FROM large l),
chain AS (
  SELECT level, c, up, n, density, after, level AS first_level, c AS first_c FROM forked WHERE inner_ones <> 1
  UNION ALL
  SELECT f.level, f.c, f.up, f.n, f.density, f.after, chain.first_level, chain.first_c
  FROM chain JOIN forked f ON f.level = chain.level + 1 AND f.c = chain.up AND f.inner_ones = 1),
clusters AS (SELECT row_number() OVER (ORDER BY first_level, first_c) AS number, first_level, first_c, max(level) AS top,
                    arg_max(c, level) AS top_c, arg_max(up, level) AS up, sum(n * (density - coalesce(after, 0))) AS mass
             FROM chain GROUP BY first_level, first_c),
nested AS (SELECT c.*, o.number AS parent FROM clusters c LEFT JOIN clusters o ON o.first_level = c.top + 1 AND o.first_c = c.up),
kids AS (SELECT n.number, any_value(n.mass) AS mass, coalesce(list(k.number) FILTER (k.number IS NOT NULL), []) AS kids
         FROM nested n LEFT JOIN nested k ON k.parent = n.number GROUP BY 1),
worth AS (
  SELECT 0::BIGINT AS number, []::DOUBLE[] AS best, false AS kept
  UNION ALL
  SELECT k.number, list_append(best, greatest(k.mass, coalesce(list_sum(list_transform(k.kids, lambda i: best[i])), 0))),
         k.mass >= coalesce(list_sum(list_transform(k.kids, lambda i: best[i])), 0)
  FROM worth JOIN kids k ON k.number = worth.number + 1),
above AS (
  SELECT number, parent AS outer_one FROM nested WHERE parent IS NOT NULL
  UNION ALL
  SELECT above.number, n.parent FROM above JOIN nested n ON n.number = above.outer_one WHERE n.parent IS NOT NULL),
good AS (SELECT n.* FROM nested n JOIN worth USING (number) WHERE kept AND parent IS NOT NULL),
chosen AS (SELECT * FROM good WHERE number NOT IN (SELECT a.number FROM above a JOIN good g ON g.number = a.outer_one)),
labels AS (SELECT m.i, number FROM chosen JOIN members m ON m.level = chosen.top AND m.c = chosen.top_c),
numbers AS (SELECT number, row_number() OVER (ORDER BY count(*) DESC, min(vec_id)) - 1 AS topic_id FROM labels JOIN p USING (i) GROUP BY 1)
SELECT vec_id AS id, coalesce(topic_id, -1)::INTEGER AS topic_id FROM p LEFT JOIN labels USING (i) LEFT JOIN numbers USING (number)"""


@register("H3", _clusters_sql(2, 4))
def density_clusters_given(spark, sf):
    """Small density clusters of the supplied vectors as they are."""
    return density_clusters(_labelled_vectors(spark, sf), min_cluster_size=4, min_pts=2)


@register("H1")
def document_vectors(spark, sf):
    """One unit vector of 384 numbers per article."""
    return tp.embed_documents(weights(spark, sf, **FULL)[2])


@register(
    "H1",
    with_sql(
        tfidf_sql(**FULL),
        """, hashed AS (SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 384 AS slot,
                             sum(tfidf * (1 - 2 * (('0x' || substr(md5(term), 9, 1))::BIGINT % 2))) AS x FROM features GROUP BY 1, 2),
        sized AS (SELECT id, slot, (x / sqrt(sum(x * x) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS x FROM hashed)
        SELECT id, slot::INTEGER AS slot, round(x, 5) AS x FROM sized WHERE abs(x) > 0.00001""",
    ),
)
def document_vector_entries(spark, sf):
    """The numbers of the articles' vectors that are not zero."""
    vectors = tp.embed_documents(weights(spark, sf, **FULL)[2])
    entries = vectors.select("id", F.posexplode(F.col("embedding").cast("array<double>")).alias("slot", "x"))
    return entries.filter(F.abs("x") > 0.00001).select("id", "slot", F.round("x", 5).alias("x"))


# --- topic dimension ---------------------------------------------------------------------------


def topical(spark, sf):
    """Articles with ``topic_id``."""
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.lit(True).alias("_known"))
    number = F.array_position(F.array(*[F.lit(k) for k in LANGS]), F.col("lang")) - 1
    rows = prepared(spark, sf).join(known, "id", "left")
    return rows.withColumn(
        "topic_id", F.when(F.col("_known"), number).otherwise(-1).cast("int")
    ).drop("_known")


TOPICAL = (
    PREPARED
    + """,
topical AS (SELECT w.*, (CASE WHEN l.doc_id IS NULL THEN -1 ELSE list_position(['de', 'en', 'es', 'fr'], w.lang) - 1 END)::INTEGER AS topic_id
            FROM worded w LEFT JOIN labels l ON l.doc_id = w.id)"""
)
INFO = (
    TOPICAL
    + ","
    + class_weights_sql("topical", "topic_id")
    + """,
kw AS (SELECT class, term, row_number() OVER (PARTITION BY class ORDER BY weight DESC, term) AS rank FROM cw),
lists AS (SELECT class, list(term ORDER BY rank) AS representation FROM kw WHERE rank <= 10 GROUP BY 1),
info AS (SELECT t.topic_id AS topic, count(*) AS count,
                t.topic_id || '_' || array_to_string(any_value(representation)[1:4], '_') AS name,
                any_value(representation) AS representation
         FROM topical t JOIN lists ON class = t.topic_id GROUP BY t.topic_id)"""
)


def dimension(spark, sf):
    rows = topical(spark, sf)
    return tp.topic_info(rows, tp.class_tfidf(rows, "topic_id", 10))


@register("H6", with_sql(INFO, "SELECT topic, count, name, array_to_string(representation, ' ') AS words FROM info"))
def topic_dimension(spark, sf):
    return dimension(spark, sf).select("topic", "count", "name", F.array_join("representation", " ").alias("words"))


@register("A9", with_sql(INFO, "SELECT topic, count, name, array_to_string(representation, '|') AS words FROM info"))
def stored_topic_dimension(spark, sf):
    path = scratch_path(spark, "topic-info")
    tb.write_topic_info(dimension(spark, sf), path)
    return tb.read_topic_info(spark, path).select(
        "topic", "count", "name", F.array_join("representation", "|").alias("words")
    )


@register(
    "H7",
    with_sql(
        TOPICAL,
        """, s AS (SELECT topic_id, (row_number() OVER (ORDER BY count(*) DESC, topic_id) - 1)::INTEGER AS new
                  FROM topical WHERE topic_id <> -1 GROUP BY 1)
        SELECT t.id, coalesce(s.new, -1)::INTEGER AS topic_id FROM topical t LEFT JOIN s USING (topic_id)""",
    ),
)
def topics_by_size(spark, sf):
    return tp.renumber_topics(topical(spark, sf).select("id", "topic_id"))


@register(
    "H8 B5 C2",
    with_sql(INFO, "SELECT t.id, t.topic_id, i.name AS topic_label FROM topical t JOIN info i ON i.topic = t.topic_id WHERE t.topic_id <> -1"),
)
def labelled_articles(spark, sf):
    return tp.label_articles(topical(spark, sf).select("id", "topic_id"), settled(dimension(spark, sf), "topic-info"))


@register(
    "C2 B10",
    with_sql(INFO, "SELECT t.id, t.topic_id, coalesce(i.name, t.topic_id::VARCHAR) AS topic_label FROM topical t LEFT JOIN (SELECT * FROM info WHERE count >= 60) i ON i.topic = t.topic_id"),
)
def topic_names_with_fallback(spark, sf):
    """Topics missing from the dimension are shown by number."""
    big = settled(dimension(spark, sf).filter(F.col("count") >= 60), "topic-info")
    return tp.attach_topic_label(topical(spark, sf).select("id", "topic_id"), big)


@register(
    "H9 F14 E7",
    with_sql(
        INFO,
        """SELECT topic, count, array_to_string(string_split(name, '_')[2:], ', ') AS keywords,
                  round(100.0 * count / sum(count) OVER (), 1) AS pct FROM info WHERE topic <> -1""",
    ),
)
def topic_listing(spark, sf):
    return tp.describe_topics(dimension(spark, sf))


@register(
    "H10",
    with_sql(
        TOPICAL,
        """SELECT count(*) AS total, count(*) FILTER (topic_id <> -1) AS labelled, count(*) FILTER (topic_id = -1) AS outliers,
                  round(100.0 * count(*) FILTER (topic_id <> -1) / count(*), 2) AS labelled_pct,
                  round(100.0 * count(*) FILTER (topic_id = -1) / count(*), 2) AS outlier_pct FROM topical""",
    ),
)
def labelling_status(spark, sf):
    return tp.label_status(topical(spark, sf))


@register("H11", with_sql(INFO, "SELECT topic, name FROM info WHERE lower(name) LIKE '%und%' OR lower(name) LIKE '%les%'"))
def topics_with_words(spark, sf):
    return tp.topics_matching(dimension(spark, sf), ["und", "les"]).select("topic", "name")


@register(
    "D17",
    with_sql(
        INFO,
        """SELECT count(*) FILTER (topic <> -1) AS topics, sum(count) FILTER (topic <> -1)::BIGINT AS labelled,
                  sum(count) FILTER (topic = -1)::BIGINT AS outliers FROM info""",
    ),
)
def topic_totals(spark, sf):
    return tp.topic_totals(dimension(spark, sf))


@register(
    "D17 E9",
    with_sql(INFO, "SELECT topic, count, array_to_string(representation[1:6], ', ') AS keywords FROM info WHERE topic <> -1 ORDER BY count DESC, topic LIMIT 20"),
)
def biggest_topics(spark, sf):
    return tp.biggest_topics(dimension(spark, sf))


@register(
    "D18",
    with_sql(
        TOPICAL,
        """SELECT count(*) AS classes, max(n) AS max_count, min(n) AS min_count, round(max(n) / min(n), 4) AS imbalance_ratio
           FROM (SELECT count(*) AS n FROM topical WHERE topic_id <> -1 GROUP BY topic_id)""",
    ),
)
def topic_balance(spark, sf):
    return pf.class_balance(tp.drop_outliers(topical(spark, sf)), "topic_id")
