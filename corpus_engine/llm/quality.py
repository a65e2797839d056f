"""Quality rules: plain counts, and a calibrated logistic regression on hashed words and characters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.base import slices
from corpus_engine.llm.linear import calibration, held_back, logistic, margins
from corpus_engine.llm.ngrams import Grams
from corpus_engine.llm.sample import per_class

PER_CLASS = 2000
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
MIN_QUALITY = 0.5
GRAMS = Grams(sizes=(1, 3, 4), bits=16, words=True, fold=False)
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that are found twice or more, the first one included."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    number = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    pair = number[:-2] * len(index) + number[1:-1]
    if len(index) > 2_000_000:  # keep the product below within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, where, count = np.unique(pair * len(index) + number[2:], return_inverse=True, return_counts=True)
    again = count[where] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated windows."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    repeats, seen = 0, set()
    for line in text.split("\n"):
        if line in seen:
            repeats += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return len(words), chars, symbols, repeats, repeated_words(words)


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """The regression on three quarters of the sample, its probabilities on the rest."""
    group = group.sort_values(["doc_id", "quality"])
    rows = GRAMS.rows(pa.array(group["text"]))
    target = group["quality"].to_numpy(dtype=float)
    back = held_back(target)
    weights, bias = logistic([r for r, h in zip(rows, back, strict=True) if not h], target[~back], GRAMS.width)
    held = [r for r, h in zip(rows, back, strict=True) if h] or rows
    slope, offset = calibration(margins(held, weights, bias), target[back] if back.any() else target)
    return pd.DataFrame(
        {"weights": [weights.astype("<f4").tobytes()], "bias": [bias], "slope": [slope], "offset": [offset]}
    )


def train(docs: DataFrame, labels: DataFrame, per_class_bound: int = PER_CLASS) -> Model | None:
    """Fit on the labelled documents: for each quality the ``per_class_bound`` labels whose doc_id has the
    smallest hash (the documented bound of the sample), in one task. Labels without a value or a
    document are left out; None if there is no sample of both classes.
    """
    labelled = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
    )
    chosen = per_class(labelled.distinct(), "quality", per_class_bound, "quality-sample")
    sample = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    fitted = sample.join(chosen, "doc_id").withColumn("model", F.lit(0)).groupBy("model").applyInPandas(
        _fit, "weights binary, bias double, slope double, offset double"
    )
    if chosen.select("quality").distinct().count() < 2:
        return None
    row = fitted.first()
    if row is None:
        return None
    return Model(np.frombuffer(bytes(row["weights"]), dtype="<f4"), row["bias"], row["slope"], row["offset"])


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, probability double, kept boolean"
)


def judge(docs: DataFrame, model: Model | None, least: float = MIN_QUALITY) -> DataFrame:
    """Counts, the probability of good quality, and the verdict for every row.

    Words are what stands between ASCII white space, of the whole text; a null text has none. A row
    with under 50 words, or with over half its words in repeated windows, fails without asking the
    model; the others are kept at a probability of ``least`` or more. Without a model (no labels of
    both classes) the probability is null and the plain rules decide. Repeated rows are judged
    each for itself; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            texts = batch.column(1)
            n = np.array([counts(t) for t in texts.to_pylist()], dtype=np.int64).reshape(-1, 5)
            failed = (n[:, 0] < MIN_WORDS) | (100 * n[:, 4] > MAX_REPEATED * n[:, 0])
            chance = np.full(len(texts), np.nan)
            if model is not None:
                margin = GRAMS.scores(texts, model.weights[None, :])[:, 0] + model.bias
                chance = 1 / (1 + np.exp(-np.clip(margin * model.slope + model.offset, -30, 30)))
            good = ~failed & ((chance >= least) | (model is None))
            columns = [batch.column(0), *(pa.array(n[:, k]) for k in range(5)), pa.array(failed)]
            columns += [pa.array(chance, from_pandas=True), pa.array(good)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
