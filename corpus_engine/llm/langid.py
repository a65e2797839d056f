"""Language identification in two steps: first the family, then the languages within it.

Every family has a linear support vector machine against the other families. Within a family every
pair of languages has one of its own; the language with most pairwise wins is the answer. All read
hashed byte n-grams of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corpus_engine.llm.base import give_back_memory, slices
from corpus_engine.llm.linear import calibration, held_back, margins, svm
from corpus_engine.llm.ngrams import Grams
from corpus_engine.llm.sample import per_class

PER_LANGUAGE = 800
UNKNOWN = "und"
GRAMS = Grams(sizes=(2, 3, 4), bits=16, words=False, fold=True)

# Families of languages by their codes.
FAMILIES = {
    "germanic": "en de nl af da sv no nb nn is fy lb yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky",
    "indo-aryan": "hi ur bn pa mr gu ne",
    "semitic": "ar he mt am",
    "cjk": "zh ja ko",
    "austronesian": "id ms tl jv",
    "celtic": "ga cy gd br",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    """The family of a language value; an unlisted one is a family of its own."""
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"={lang}")


@dataclass(frozen=True)
class Model:
    """Machines by name with weights, bias, and the slope and offset of their probabilities."""

    languages: tuple[str, ...]
    names: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    offset: np.ndarray


def _machines(languages: list[str]) -> dict[str, dict[str, int]]:
    """Name of each machine -> side of each language that takes part. Two families need one machine."""
    families = sorted({family(x) for x in languages})
    out = {}
    for name in families if len(families) > 2 else families[:1] if len(families) == 2 else []:
        out[f"family:{name}"] = {x: 1 if family(x) == name else -1 for x in languages}
    for a, b in combinations(languages, 2):
        if family(a) == family(b):
            out[f"pair:{a}|{b}"] = {a: 1, b: -1}
    return out


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """One machine; every fourth row of each side is held back to fit the probabilities."""
    group = group.sort_values(["doc_id", "side"])
    rows = GRAMS.rows(pa.array(group["text"]))
    sign = group["side"].to_numpy()
    back = held_back(sign)
    fitted = [r for r, h in zip(rows, back, strict=True) if not h]
    weights, bias = svm(fitted, sign[~back], GRAMS.width)
    held = [r for r, h in zip(rows, back, strict=True) if h] or rows
    goal = (sign[back] if back.any() else sign) > 0
    slope, offset = calibration(margins(held, weights, bias), goal.astype(float))
    return pd.DataFrame(
        {
            "machine": group["machine"].iloc[:1],
            "weights": [weights.astype("<f4").tobytes()],
            "bias": [bias],
            "slope": [slope],
            "offset": [offset],
        }
    )


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on ``doc_id, text, lang``: for each language the ``per_language`` rows whose doc_id has
    the smallest hash (the documented bound of the sample), of texts with a letter. The machines
    are fitted side by side, one task each. Without a labelled text the model knows no language.
    """
    usable = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    chosen = per_class(usable.select("doc_id", "lang"), "lang", per_language, "language-sample").distinct()
    languages = sorted(r[0] for r in chosen.select("lang").distinct().collect())
    machines = _machines(languages)
    sides = [(m, lang, side) for m, by in machines.items() for lang, side in by.items()]
    if not sides:
        none = np.zeros(0)
        return Model(tuple(languages), (), np.zeros((0, GRAMS.width), np.float32), none, none, none)
    spark = docs.sparkSession
    part = spark.createDataFrame(sides, "machine string, lang string, side int")
    sample = usable.join(chosen, ["doc_id", "lang"]).join(F.broadcast(part), "lang").drop("lang")
    fitted = sample.groupBy("machine").applyInPandas(
        _fit, "machine string, weights binary, bias double, slope double, offset double"
    )
    rows = sorted(fitted.collect())
    return Model(
        tuple(languages),
        tuple(r["machine"] for r in rows),
        np.stack([np.frombuffer(bytes(r["weights"]), dtype="<f4") for r in rows]),
        *(np.array([r[k] for r in rows]) for k in ("bias", "slope", "offset")),
    )


def _decide(model: Model, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language and score of each row from the machines' probabilities."""
    at = {name: i for i, name in enumerate(model.names)}
    families = sorted({family(x) for x in model.languages})
    of = np.ones((len(chance), len(families)))
    if len(families) > 1:
        for k, name in enumerate(families):
            machine = at.get(f"family:{name}")
            of[:, k] = chance[:, machine] if machine is not None else 1 - chance[:, at[f"family:{families[0]}"]]
    best, score = of.argmax(axis=1), of.max(axis=1)
    answer = np.zeros(len(chance), dtype=np.int64)
    for k, name in enumerate(families):
        own = [i for i, x in enumerate(model.languages) if family(x) == name]
        wins, worst = np.zeros((len(chance), len(own))), np.ones((len(chance), len(own)))
        for i, j in combinations(range(len(own)), 2):
            p = chance[:, at[f"pair:{model.languages[own[i]]}|{model.languages[own[j]]}"]]
            wins[:, i] += (p >= 0.5) + p * 1e-3
            wins[:, j] += (p < 0.5) + (1 - p) * 1e-3
            worst[:, i], worst[:, j] = np.minimum(worst[:, i], p), np.minimum(worst[:, j], 1 - p)
        here = best == k
        top = wins[here].argmax(axis=1)
        answer[here] = np.array(own)[top]
        score[here] *= worst[here][np.arange(len(top)), top]
    return answer, np.clip(score, 0.0, 1.0)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row of ``docs``, with ``lang_pred, score`` from its ``text`` alone.

    ``und`` with score 0 for a text that is null or has no letter, and for all where the model
    knows no language. Repeated rows are judged each for itself; an empty table gives no rows. ``keep`` may not
    hold ``lang_pred`` or ``score``; see ``base.aside`` for rows that have such columns.
    """
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            texts = batch.column(batch.schema.get_field_index("text"))
            letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], dtype=bool)
            answer, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
            if model.languages:
                margin = GRAMS.scores(texts, model.weights) + model.bias
                chance = 1 / (1 + np.exp(-np.clip(margin * model.slope + model.offset, -30, 30)))
                found, sure = _decide(model, chance)
                answer, score = np.where(letters, found, answer), np.where(letters, sure, 0.0)
            columns = [*batch.columns[: len(keep)], pa.array(names[answer], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])
        give_back_memory()

    kept = docs.select(*keep)
    schema = StructType([*kept.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    # a text that is kept anyway is handed over once
    own = F.col("text").cast("string").alias("text")
    if "text" in keep and docs.schema["text"].dataType == StringType():
        return kept.mapInArrow(run, schema)
    return docs.select(*(F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep)), own).mapInArrow(run, schema)
