"""Token ids against the tokenizers library, packing invariants, and pieces against sentencepiece."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpus_engine.llm import packing, pieces
from corpus_engine.llm.tokens import words

TEXTS = [
    "Hello  world, it's LLAMA'S <|endoftext|>x <|startoftext|>", "", " \n\t ", "straße ÄÖÜ été İstanbul ſtop ŉ", "a\xa0b\x1cc",
    "日本 😀 é ﬁ ½ ΑΣ", "x" * 3000, "12345 3.14 don't we've I'll 'S", "###!!\n| a | b |", "▁x ▁▁ y", "\x00nul",
]


def test_ids_are_the_tokenizers():
    whole = Tokenizer.from_file(packing.VOCABULARY)
    for text in TEXTS:
        got = np.frombuffer(words(packing.VOCABULARY).ids(text), dtype="<u4").tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, text


def test_pieces_carry_all_ids_in_order(spark):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, None, "word " * 9000, "word " * 9000])] + [(0, TEXTS[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    whole = Tokenizer.from_file(packing.VOCABULARY)
    packed = packing.pack(packing.pieces(docs)).collect()
    assert len({(r.row, r.piece) for r in packed}) == len(packed)
    by_row = {}
    for r in packed:
        by_row.setdefault(r.row, []).append(r)
    assert len(by_row) == len(rows)
    got = []
    for parts in by_row.values():
        parts.sort(key=lambda r: r.piece)
        assert [r.start for r in parts] == list(np.cumsum([0, *(r.length for r in parts[:-1])]))
        assert all(r.length == 4096 for r in parts[:-1])
        got.append((parts[0].doc_id, b"".join(bytes(r.ids) for r in parts)))
    ids = lambda t: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()
    assert sorted(got) == sorted((i, ids(t)) for i, t, _ in rows)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own[:-1])]))
        assert sum(n for _, n in own) <= 4096


def test_packing_in_many_blocks_comes_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 50)
    rng = random.Random(1)
    rows = [(i, 0, rng.choice([1, 7, 400, 1500, 2049, 4096])) for i in range(1500)]
    parts = spark.createDataFrame(rows, "row long, piece int, length long")
    packed = packing.pack(parts).collect()
    assert sorted((r.row, r.piece, r.length) for r in packed) == rows
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096
    single = packing.improve(packing.best_fit([r[2] for r in rows], 4096), [r[2] for r in rows], 4096)
    assert len(fill) <= 1.02 * len(single) + 1


def test_exchanges_empty_a_bin():
    size = [6, 5, 5, 4]
    assert len(packing.improve([[0, 2], [1, 3], []], size, 11)) == 2
    assert len(packing.improve([[0], [1], [2], [3]], size, 10)) == 2
    assert len(packing.improve([[0, 1], [2], [3]], [5, 2, 5, 8], 10)) == 2
    assert len(packing.improve([[0, 1], [2], [3]], [5, 3, 4, 8], 10)) == 3  # nothing fits beside the 8


def fewest(size, capacity):
    """Bins of the best packing, by trying every place for every item."""
    best = len(size)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(size):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= size[k]:
                rest = list(rooms)
                rest.remove(room)
                place(k + 1, [*rest, room - size[k]])
        place(k + 1, [*rooms, capacity - size[k]])

    place(0, [])
    return best


def test_small_cases_next_to_all_packings():
    rng = random.Random(11)
    above = 0
    for _ in range(400):
        size = [rng.randint(1, 30) for _ in range(rng.randint(1, 8))]
        capacity = rng.randint(max(size), 45)
        first = packing.best_fit(size, capacity)
        bins = packing.improve(first, size, capacity)
        assert sorted(i for b in bins for i in b) == list(range(len(size)))
        assert all(sum(size[i] for i in b) <= capacity for b in bins)
        best = fewest(size, capacity)
        assert packing.lower_bound(size, capacity) <= best <= len(bins) <= len(first)
        above += len(bins) > best
    assert above <= 4


@pytest.mark.parametrize("kinds", [[3], [1, 2, 3], [2, 3, 5, 7, 11, 2049]])
def test_many_equal_lengths_end_soon(kinds):
    rng = random.Random(12)
    size = [rng.choice(kinds) for _ in range(8192)]
    start = time.monotonic()
    bins = packing.improve(packing.best_fit(size, 4096), size, 4096)
    assert time.monotonic() - start < 20
    assert len(bins) <= packing.lower_bound(size, 4096) + 1


def test_packing_nothing_and_too_long(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(empty)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 5000)], "row long, piece int, length long"))


def test_pieces_are_those_of_the_library_and_come_back(spark):
    rng = random.Random(2)
    texts = [*TEXTS, *("".join(rng.choice("abe tionrs▁é日\n") for _ in range(rng.randint(0, 60))) for _ in range(500))]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.createDataFrame([*enumerate(texts), (0, TEXTS[0]), (-1, None)], "doc_id long, text string")
    rows = pieces.decode(pieces.encode(docs)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id < 0:
            assert r.ids is None and r.text is None
            continue
        text = texts[r.doc_id]
        assert np.frombuffer(bytes(r.ids), dtype="<u4").tolist() == library.encode(text)
        assert r.text == text.replace("▁", " ")
    assert pieces.decode(pieces.encode(docs.limit(0))).count() == 0
