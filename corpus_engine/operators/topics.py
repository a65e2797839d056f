"""Topics: document vectors, clusters with a noise bucket, keywords, labels, topic dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.functions import text as tx
from corpus_engine.operators.centres import NEAREST, nearest_of
from corpus_engine.operators.topk import top_n_per_group, with_share
from corpus_engine.session import settled

OUTLIER = -1
CENTRE_CELLS = 8_000_000  # numbers of a matrix of centres that goes to every task: 64 MB


def embed_documents(features: DataFrame, dim: int = 384, key: str = "id") -> DataFrame:
    """``(key, embedding)``: one unit vector of ``dim`` numbers per document.

    Signed feature hashing of the TF-IDF weights. ``features`` is partitioned by document, so
    nothing moves. Bring an ``embedding`` column of your own where synonyms matter.
    """
    # the first eight and the next hex digits of a term's md5 tell its place and its sign
    digest = F.md5(F.col("term").cast("binary"))
    slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % dim
    sign = F.conv(F.substring(digest, 9, 1), 16, 10).cast("int") % 2
    hashed = (
        features.select(key, slot.cast("int").alias("slot"), (F.col("tfidf") * (1 - 2 * sign)).alias("x"))
        .groupBy(key, "slot")
        .agg(F.sum("x").alias("x"))
        .groupBy(key)
        .agg(
            F.sort_array(F.collect_list(F.struct("slot", "x"))).alias("e"),
            F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"),
        )
        .filter(F.col("length") > 0)
    )
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    filled = F.aggregate(
        "e",
        F.array().cast("array<double>"),
        lambda out, p: F.concat(out, zeros(p["slot"] - F.size(out)), F.array(p["x"] / F.col("length"))),
        lambda out: F.concat(out, zeros(F.lit(dim) - F.size(out))),
    )
    return hashed.select(key, filled.cast("array<float>").alias("embedding"))


def fit_reducer(df: DataFrame, column: str = "embedding", k: int = 5) -> PCAModel:
    """Principal components of an array column. The covariance is dim x dim, whatever the rows."""
    return PCA(k=k, inputCol="_v", outputCol="_p").fit(_with_vector(df, column))


def reduce_with(model: PCAModel, df: DataFrame, column: str = "embedding") -> DataFrame:
    """Replace the array column by its components."""
    reduced = model.transform(_with_vector(df, column))
    return reduced.withColumn(column, vector_to_array("_p")).select(df.columns)


def load_reducer(path: str) -> PCAModel:
    """A reducer stored with its ``write``."""
    return PCAModel.load(path)


def reduce_dims(df: DataFrame, column: str = "embedding", k: int = 5) -> DataFrame:
    """Fit and apply on the same rows."""
    return reduce_with(fit_reducer(df, column, k), df, column)


def _with_vector(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("_v", array_to_vector(F.col(column).cast("array<double>")))


def fit_kmeans(df: DataFrame, k: int, column: str = "embedding", seed: int = 42, rounds: int = 200) -> DataFrame:
    """``(cluster, centre)`` of cosine k-means, run until no centre moves (at most ``rounds`` rounds)."""
    vectors = _with_vector(df.select(column), column)
    model = KMeans(k=k, distanceMeasure="cosine", seed=seed, maxIter=rounds, tol=1e-9, featuresCol="_v", predictionCol="_c").fit(vectors)
    # k centres of `dim` numbers
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(centres, "cluster int, centre array<double>")


def kmeans_topics(
    df: DataFrame,
    k: int,
    column: str = "embedding",
    noise_quantile: float = 0.9,
    seed: int = 42,
    key: str = "id",
) -> DataFrame:
    """``(key, topic_id)`` from cosine k-means; the farthest rows of each cluster become -1."""
    centres = fit_kmeans(df, k, column, seed).select(F.col("cluster").alias("topic_id"), F.col("centre").alias("centroid"))
    placed = settled(assign_topics(df.select(key, column), centres, column=column).select(key, "topic_id", "distance"), "placed")
    radii = settled(
        placed.groupBy("topic_id").agg(F.percentile_approx("distance", noise_quantile, 10_000).alias("_r")), "radii"
    )
    return placed.join(radii, "topic_id").select(
        key, F.when(F.col("distance") <= F.col("_r"), F.col("topic_id")).otherwise(OUTLIER).alias("topic_id")
    )


def topic_centroids(
    df: DataFrame, topic: str = "topic_id", column: str = "embedding"
) -> DataFrame:
    """``(topic, centroid)``: mean vector per topic, outliers left out."""
    return (
        df.filter(F.col(topic) != OUTLIER)
        .select(topic, F.posexplode(column).alias("i", "x"))
        .groupBy(topic, "i")
        .agg(F.avg("x").alias("x"))
        .groupBy(topic)
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("e"))
        .select(topic, F.transform("e", lambda p: p["x"]).alias("centroid"))
    )


def assign_topics(
    df: DataFrame,
    centroids: DataFrame,
    radius: float | None = None,
    column: str = "embedding",
    metric: str = "cosine",
) -> DataFrame:
    """Add ``topic_id`` and ``distance`` of the nearest centroid; beyond ``radius`` the id is -1.

    ``centroids`` may have a ``radius`` of its own per topic. Blocks of rows are compared with a matrix of
    centres, see ``centres``; up to ``CENTRE_CELLS`` numbers of it go along with a pass, and more centres take
    further passes over the arrays. Lengths are worked out once per block and centre. Ties go to the smaller
    topic id; without any centroid, or without an array, every row is an outlier.
    """
    own = F.col("radius") if "radius" in centroids.columns else F.lit(radius)
    table = settled(centroids.select(F.col("topic_id").cast("int").alias("topic_id"), "centroid", own.cast("double").alias("radius")), "centres")
    count, width = table.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()
    step = max(1, CENTRE_CELLS // max(1, width or 1))
    found = df.withColumn("_near", F.lit(None).cast(f"struct<{NEAREST}>"))
    below = None
    for _ in range(0, count, step):
        rest = table if below is None else table.filter(F.col("topic_id") > below)
        some = rest.orderBy("topic_id").limit(step).select("topic_id", "centroid").collect()
        below = some[-1].topic_id
        near = nearest_of([c.topic_id for c in some], [c.centroid for c in some], metric == "cosine")
        found = found.withColumn("_more", near(F.col(column).cast("array<double>")))
        nearer = F.col("_near.topic").isNull() | (F.col("_more.distance") < F.col("_near.distance"))
        found = found.withColumn("_near", F.when(nearer, F.col("_more")).otherwise(F.col("_near"))).drop("_more")
    radii = table.select(F.col("topic_id").alias("_topic"), F.col("radius").alias("_radius"))
    judged = found.join(radii, F.col("_near.topic") == F.col("_topic"), "left")
    outside = F.col("_near.topic").isNull() | F.coalesce(F.col("_near.distance") > F.col("_radius"), F.lit(False))
    topic = F.when(outside, OUTLIER).otherwise(F.col("_near.topic"))
    return judged.select(*df.columns, topic.cast("int").alias("topic_id"), F.col("_near.distance").alias("distance"))


def class_term_weights(df: DataFrame, class_col: str, text: str = "text_clean") -> DataFrame:
    """Class TF-IDF ``(class, term, tf, weight)`` over every word of every class.

    ``weight = tf / class total * ln(1 + A / f)`` with A the mean number of words per class and f
    the term's total. Words are counted per (class, term) with map-side combine.
    """
    words = df.filter(F.col(class_col).isNotNull()).select(
        class_col, F.explode(F.filter(F.split(text, " "), lambda w: F.length(w) > 1)).alias("term")
    )
    counts = words.groupBy(class_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    totals = counts.groupBy(class_col).agg(F.sum("tf").alias("_total"))
    mean_words = totals.agg(F.avg("_total")).scalar()
    # a term has one row per class here
    overall = F.sum("tf").over(Window.partitionBy("term"))
    return (
        counts.withColumn("_f", overall)
        .join(totals, class_col)
        .select(
            class_col,
            "term",
            "tf",
            (F.col("tf") / F.col("_total") * F.ln(F.lit(1) + mean_words / F.col("_f"))).alias("weight"),
        )
    )


def class_tfidf(df: DataFrame, class_col: str, n: int = 10, text: str = "text_clean") -> DataFrame:
    """The ``n`` words that set each class apart: ``(class, rank, term, weight)``."""
    weights = class_term_weights(df, class_col, text)
    return top_n_per_group(weights, class_col, [F.desc("weight"), "term"], n).select(
        class_col, "rank", "term", "weight"
    )


def topic_numbers(df: DataFrame, topic: str = "topic_id") -> DataFrame:
    """``(topic, number)``: topics by size, 0 the largest (ties by old id)."""
    sizes = df.filter(F.col(topic) != OUTLIER).groupBy(topic).agg(F.count(F.lit(1)).alias("_n"))
    # one row per topic
    rank = F.row_number().over(Window.orderBy(F.desc("_n"), topic)) - 1
    return settled(sizes.select(topic, rank.cast("int").alias("number")), "numbers")


def renumber_topics(df: DataFrame, topic: str = "topic_id") -> DataFrame:
    """Topics by size, 0 the largest (ties by old id); -1 stays."""
    return df.join(topic_numbers(df, topic), topic, "left").withColumn(
        topic, F.coalesce("number", F.lit(OUTLIER))
    ).select(df.columns)


def topic_info(
    assigned: DataFrame, keywords: DataFrame, topic: str = "topic_id", fit_flag: str | None = None
) -> DataFrame:
    """Topic dimension: id, size, name ``{id}_{k1}_{k2}_{k3}_{k4}``, keyword list.

    ``count`` is the size in the frame given; with ``fit_flag`` the rows of the fit sample are
    counted as well. ``keywords`` has ``(topic, rank, term)``.
    """
    sizes = [F.count(F.lit(1)).alias("count")]
    if fit_flag:
        sizes.append(F.count_if(F.col(fit_flag)).alias("fit_count"))
    counts = assigned.groupBy(topic).agg(*sizes)
    lists = keywords.groupBy(topic).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda k: k["term"]).alias(
            "representation"
        )
    )
    named = counts.join(lists, topic, "left").withColumn(
        "representation", F.coalesce("representation", F.array().cast("array<string>"))
    )
    return named.select(
        F.col(topic).alias("topic"),
        *[c for c in ("count", "fit_count") if c in named.columns],
        F.concat_ws(
            "_", F.col(topic).cast("string"), F.slice("representation", 1, 4)
        ).alias("name"),
        "representation",
    )


def attach_topic_label(
    df: DataFrame, info: DataFrame, topic: str = "topic_id", name: str = "topic_label"
) -> DataFrame:
    """Add the topic's name, or its id as text where it has none. Spark broadcasts the dimension."""
    names = info.select(F.col("topic").alias(topic), F.col("name").alias("_name"))
    return df.join(names, topic, "left").select(
        *df.columns, F.coalesce("_name", F.col(topic).cast("string")).alias(name)
    )


def drop_outliers(df: DataFrame, topic: str = "topic_id") -> DataFrame:
    return df.filter(F.col(topic) != OUTLIER)


def label_articles(df: DataFrame, info: DataFrame, topic: str = "topic_id") -> DataFrame:
    """Articles with a real topic, and its name."""
    return attach_topic_label(drop_outliers(df, topic), info, topic)


def label_status(df: DataFrame, topic: str = "topic_id") -> DataFrame:
    """How many rows have a topic and how many are outliers."""
    outlier = F.col(topic) == OUTLIER
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~outlier).alias("labelled"),
        F.count_if(outlier).alias("outliers"),
        F.round(100.0 * F.count_if(~outlier) / F.count(F.lit(1)), 2).alias("labelled_pct"),
        F.round(100.0 * F.count_if(outlier) / F.count(F.lit(1)), 2).alias("outlier_pct"),
    )


def describe_topics(info: DataFrame) -> DataFrame:
    """Topic listing by id: size, keywords, share of the labelled articles."""
    real = info.filter(F.col("topic") != OUTLIER)
    shared = with_share(real, "count", "_share", 100.0)
    return shared.select(
        "topic",
        "count",
        tx.keywords_from_name(F.col("name")).alias("keywords"),
        F.round("_share", 1).alias("pct"),
    ).orderBy("topic")


def topic_totals(info: DataFrame) -> DataFrame:
    """Number of real topics, labelled articles and outliers."""
    outlier = F.col("topic") == OUTLIER
    return info.agg(
        F.count_if(~outlier).alias("topics"),
        F.coalesce(F.sum(F.when(~outlier, F.col("count"))), F.lit(0)).alias("labelled"),
        F.coalesce(F.sum(F.when(outlier, F.col("count"))), F.lit(0)).alias("outliers"),
    )


def biggest_topics(info: DataFrame, n: int = 20, words: int = 6) -> DataFrame:
    """The ``n`` biggest topics with their first keywords."""
    return (
        info.filter(F.col("topic") != OUTLIER)
        .orderBy(F.desc("count"), "topic")
        .limit(n)
        .select(
            "topic", "count", F.array_join(F.slice("representation", 1, words), ", ").alias("keywords")
        )
    )


def topics_matching(info: DataFrame, words: Sequence[str]) -> DataFrame:
    """Topics whose name contains one of the words."""
    name = F.lower("name")
    wanted = F.array(*[F.lit(w.lower()) for w in words])
    return info.filter(F.exists(wanted, lambda w: F.contains(name, w)))
