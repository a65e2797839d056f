"""Repeated passages against a plain count of all windows, and suffix arrays against sorting."""

import collections

import numpy as np
import pytest

from corpus_engine.llm import repeats
from corpus_engine.llm.suffixes import suffix_arrays

SCHEMA = "doc_id long, text string, key string, kept int, anchors string"


def plain(texts, window):
    bodies = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + window] for b in bodies for i in range(len(b) - window + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(x for x, g in zip(b, gone, strict=True) if not g), sum(gone), spans))
    return out


def texts():
    rng = np.random.default_rng(5)
    letters = list("abcdefgh é\n")
    draw = lambda n: "".join(rng.choice(letters, n))
    shared, line = draw(260), draw(230)
    out = [draw(int(rng.integers(0, 900))) for _ in range(40)]
    out += [draw(60) + shared + draw(int(rng.integers(0, 90))) for _ in range(20)]
    out += [draw(int(rng.integers(1, 50))) + line + draw(30) + line for _ in range(5)]
    out += [out[3], out[3], None, "", "a" * 900, "ab" * 300, "x" * 200, "x" * 199, draw(150) * 3]
    near = draw(1500)
    out += [near[:k] + "#" + near[k + 1 :] for k in (100, 700, 705, 1400)]
    return out


@pytest.mark.parametrize("most", [32, 2])
def test_removed_bytes_are_those_of_repeated_windows(spark, most):
    data = texts()
    docs = spark.createDataFrame([(i, t, "k", 1, "a") for i, t in enumerate(data)], SCHEMA)
    lost = {bytes(r.key): r for r in repeats.removals(docs, most=most).collect()}
    keys = {r.doc_id: bytes(r.k) for r in docs.select("doc_id", repeats.key_of(docs.text).alias("k")).collect()}
    for i, want in enumerate(plain(data, 200)):
        row = lost.get(keys[i])
        got = (bytes(row.kept), row.n_removed, row.n_spans) if row else ((data[i] or "").encode(), 0, 0)
        assert got == want, i


def test_texts_lose_their_repeats_and_keep_their_columns(spark):
    data = texts()
    docs = spark.createDataFrame([(i, t, "k", 1, "a") for i, t in enumerate(data)], SCHEMA)
    out = repeats.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    want = [None if t is None else k.decode("utf-8", "ignore") for t, (k, _, _) in zip(data, plain(data, 200), strict=True)]
    assert [got[i] for i in range(len(data))] == want


def test_empty_table_and_bad_bounds(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repeats.removals(empty).count() == 0
    assert repeats.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        repeats.removals(empty, window=10, gram=32)


def test_suffix_arrays_of_many_texts():
    rng = np.random.default_rng(1)
    texts_ = [rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 60))) for _ in range(200)]
    texts_ += [np.ones(k, int) for k in range(20)] + [np.tile([2, 1, 3], 9)]
    closed = [np.append(t, 0) for t in texts_]
    bounds = np.cumsum([0, *map(len, closed)])
    found = suffix_arrays(np.concatenate(closed), bounds)
    for k, t in enumerate(closed):
        s = t.tolist()
        assert (found[bounds[k] : bounds[k + 1]] - bounds[k]).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
