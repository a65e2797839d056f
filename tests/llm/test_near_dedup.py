"""SimHash classes, and components, against plain versions."""

import itertools

import numpy as np
import pytest
import xxhash

from corpus_engine.llm import simhash
from corpus_engine.llm.components import connected

SCHEMA = "doc_id long, text string, fp string, key int, component_id string"


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def plain_classes(rows):
    prints = [plain_print(r[1]) for r in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    ids = {}
    for i, x in enumerate(label):
        if rows[i][0] is not None:
            ids[x] = min(ids.get(x, rows[i][0]), rows[i][0])
    return sorted((str(r[0]), p, str(ids.get(x))) for r, p, x in zip(rows, prints, label, strict=True))


def rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(60):
        text = list(rng.choice(words, 300))
        out.append((3 * i, " ".join(text)))
        for k in range(i % 4):
            text[int(rng.integers(300))] = "Changed"
            out.append((3 * i + k + 1, " ".join(text)))
    out += [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "ONE two"), (905, "x"), (7, "x")]
    out += [(906, "x y z q " * 5000), (907, "same"), (907, "same"), (None, "no id at all"), (908, "é É K")]
    return out


def table(spark, data):
    return spark.createDataFrame([(*r, "f", 1, "c") for r in data], SCHEMA)


@pytest.mark.parametrize("most", [2048, 2])
def test_classes_are_those_of_all_pairs(spark, most, monkeypatch):
    monkeypatch.setattr(simhash, "SHORT_RUN", 2 if most == 2 else 64)
    data = rows()
    real = simhash.links
    monkeypatch.setattr(simhash, "links", lambda d, bits: real(d, bits, most))
    got = simhash.near_duplicates(table(spark, data)).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == plain_classes(data)


def test_every_distance_up_to_four_shares_a_key():
    rng = np.random.default_rng(0)
    base = rng.integers(-(2**63), 2**63 - 1, 300)
    for flips in range(5):
        other = base.copy()
        for j in range(len(other)):
            for bit in rng.choice(64, flips, replace=False):
                other[j] ^= np.uint64(1 << int(bit)).astype(np.int64)
        mine, theirs = (set(zip(*map(np.ndarray.tolist, simhash.segment_keys(x)), strict=True)) for x in (base, other))
        assert {r for r, _ in mine & theirs} == set(range(300))


def test_one_row_of_each_class_stays_with_its_columns(spark):
    data = rows()
    kept = simhash.keep_one(table(spark, data))
    assert kept.columns == ["doc_id", "text", "fp", "key", "component_id"]
    classes = plain_classes(data)
    want = sorted({c for _, _, c in classes})
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    assert simhash.keep_one(table(spark, [])).count() == 0


def test_more_bits_than_the_keys_cover_is_an_error(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 5)


def test_components_of_paths_stars_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(7, 7), (1, 2), (2, 1), (None, 3)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {k: 5 for k in range(5, 40)} | {1: 1, 2: 1}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
