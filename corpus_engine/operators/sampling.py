"""Exact random samples and splits, reproducible and spread over all tasks.

Rows are ordered by md5(seed:id). To take the first ``q`` rows of that order in a stratum, nobody
sorts the stratum: a histogram over equal slices of the key space tells in which slice the q-th key
lies, only that slice (1/65536 of the stratum) is ranked, and the q-th key becomes a threshold every
row is compared with. A stratum with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.functions.hashing import key_bucket, random_key
from corpus_engine.session import settled

# Strata up to which the quota and threshold tables (one row each) are sent to every executor.
BROADCAST_STRATA = 1_000_000


def key_thresholds(keyed: DataFrame, stratum: str, quotas: DataFrame, key: str = "_key") -> DataFrame:
    """``(stratum, _threshold)``: the key of the ``quota``-th row per stratum in key order.

    ``quotas`` has ``(stratum, quota)``; strata with quota 0 get no row. Keys must be distinct.
    The two tables of one row per stratum are written down, so the joins of all rows with them are
    broadcast up to ``BROADCAST_STRATA``.
    """
    sliced = keyed.select(stratum, key, key_bucket(F.col(key)).alias("_slice"))
    sizes = sliced.groupBy(stratum, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # one row per key slice: at most 65,536 per stratum
    earlier = Window.partitionBy(stratum).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    located = settled(
        sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(quotas.select(stratum, "quota"), stratum)
        .filter((F.col("_before") < F.col("quota")) & (F.col("_before") + F.col("_n") >= F.col("quota")))
        .select(stratum, "_slice", (F.col("quota") - F.col("_before")).alias("_need")),
        "located",
        BROADCAST_STRATA,
    )
    in_slice = Window.partitionBy(stratum, "_slice").orderBy(key)
    return settled(
        sliced.join(located, [stratum, "_slice"])
        .withColumn("_at", F.row_number().over(in_slice))
        .filter(F.col("_at") == F.col("_need"))
        .select(stratum, F.col(key).alias("_threshold")),
        "thresholds",
        BROADCAST_STRATA,
    )


def _global_threshold(keyed: DataFrame, size: Column) -> Column:
    """Scalar key of the ``size``-th row of the whole frame (null when ``size`` is 0)."""
    whole = keyed.select(F.lit(0).alias("_all"), "_key")
    quota = whole.agg(F.least(size.cast("bigint"), F.count(F.lit(1))).alias("quota")).select(
        F.lit(0).alias("_all"), "quota"
    )
    return key_thresholds(whole, "_all", quota).select(F.max("_threshold")).scalar()


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """Exactly ``n`` rows (all of them if there are fewer), without sorting the table."""
    keyed = df.withColumn("_key", random_key(seed, key))
    cut = _global_threshold(keyed, F.lit(n))
    return keyed.filter(F.col("_key") <= cut).drop("_key")


def shuffle(df: DataFrame, seed: int = 42, key: str = "id") -> DataFrame:
    """All rows in random order: a range-partitioned sort on the random key."""
    return df.orderBy(random_key(seed, key))


def stratified_sample(
    df: DataFrame, by: str, size: int, seed: int = 42, key: str = "id"
) -> DataFrame:
    """Proportional sample of exactly ``size`` rows (or the table, if smaller).

    Every stratum gives ``floor(size * n_g / N)`` rows; what rounding leaves open is drawn from all
    remaining rows, which is also the only way in for rows without a stratum.
    """
    # counts and thresholds take several passes: over ids and strata, written once, not over the rows
    keyed = settled(df.select(key, by), "strata-rows").withColumn("_key", random_key(seed, key))
    counts = settled(keyed.groupBy(by).agg(F.count(F.lit(1)).alias("n")), "strata", BROADCAST_STRATA)
    total = counts.agg(F.sum("n")).scalar()
    quotas = counts.filter(F.col(by).isNotNull()).select(
        by, F.least("n", F.floor(F.lit(size) * F.col("n") / total)).cast("bigint").alias("quota")
    )
    cuts = settled(key_thresholds(keyed, by, quotas), "cuts", BROADCAST_STRATA)

    def marked(rows: DataFrame) -> DataFrame:
        return rows.join(cuts, by, "left").withColumn("_taken", F.coalesce(F.col("_key") <= F.col("_threshold"), F.lit(False)))

    open_places = F.lit(size) - quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).scalar()
    # the remaining rows have a random order of their own, under the next seed
    rest = marked(keyed).filter(~F.col("_taken")).select(random_key(seed + 1, key).alias("_key"))
    cut = _global_threshold(rest, F.greatest(open_places, F.lit(0)))
    return marked(df.withColumn("_key", random_key(seed, key))).filter(
        F.col("_taken") | F.coalesce(random_key(seed + 1, key) <= cut, F.lit(False))
    ).select(df.columns)


def split_quotas(df: DataFrame, label: str, test_size: float = 0.2) -> DataFrame:
    """``(label, n, n_train, quota)``; ``quota`` is the number of test rows.

    ``ceil(test_size * N)`` rows go to the test side. Training rows are shared out in proportion,
    rounding by largest remainder (ties by label); the test side gets the rest of each class.
    """
    counts = settled(
        df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")), "classes"
    )
    total = counts.agg(F.sum("n")).scalar()
    train_total = total - F.ceil(F.lit(test_size) * total)
    shares = (
        counts.withColumn("_exact", F.col("n") / total * train_total)
        .withColumn("_floor", F.floor("_exact"))
        .withColumn("_rest", F.round(F.col("_exact") - F.col("_floor"), 9))
    )
    left_over = train_total - shares.agg(F.sum("_floor")).scalar()
    # one row per class
    by_rest = F.row_number().over(Window.orderBy(F.desc("_rest"), label))
    n_train = F.col("_floor") + F.when(by_rest <= left_over, 1).otherwise(0)
    return shares.withColumn("n_train", n_train).select(
        label, "n", "n_train", (F.col("n") - F.col("n_train")).alias("quota")
    )


def stratified_split(
    df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42, key: str = "id"
) -> DataFrame:
    """Add ``is_test`` with exact class quotas. Keep the flag: it is the held-out set for good."""
    keyed = df.withColumn("_key", random_key(seed, key))
    cuts = key_thresholds(keyed, label, split_quotas(df, label, test_size))
    flag = F.coalesce(F.col("_key") <= F.col("_threshold"), F.lit(False))
    return keyed.join(cuts, label, "left").withColumn("is_test", flag).select(*df.columns, "is_test")


def test_set(df: DataFrame) -> DataFrame:
    """The held-out rows, as they were drawn."""
    return df.filter("is_test").drop("is_test")


def background_ids(split: DataFrame, n: int = 100, seed: int = 42, key: str = "id") -> DataFrame:
    """Ids of ``n`` random training rows, the background of the attributions."""
    return sample_n(split.filter(~F.col("is_test")).select(key), n, seed, key)


def split_balance(split: DataFrame, label: str, digits: int = 1) -> DataFrame:
    """Class shares of the training and the test side next to each other."""
    counts = split.groupBy(label).agg(
        F.count_if(~F.col("is_test")).alias("train_n"), F.count_if(F.col("is_test")).alias("test_n")
    )
    train_total = counts.agg(F.sum("train_n")).scalar()
    test_total = counts.agg(F.sum("test_n")).scalar()
    return counts.select(
        label,
        "train_n",
        "test_n",
        F.round(100.0 * F.col("train_n") / train_total, digits).alias("train_pct"),
        F.round(100.0 * F.col("test_n") / test_total, digits).alias("test_pct"),
    )
