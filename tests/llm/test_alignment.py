"""Aligned tokens next to a plain count over all pairs of token occurrences."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpus_engine.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def plain(texts):
    one = Tokenizer.from_file(alignment.FIRST)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)
    letters = alignment._byte_letters()
    out, held = [], Counter()
    for text in texts:
        a, b, groups, links = [], [], [], []
        if text:
            a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, alignment._piece_bytes(two.id_to_piece(i))) for i in two.encode(text)]
            if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == (" " + text).encode():
                a, b = [], []
        left, right, size_a, size_b, j = [], [], 0, 0, 0
        for i, raw in a:
            left.append(i)
            size_a += len(raw)
            while size_b < size_a:
                right.append(b[j][0])
                size_b += len(b[j][1])
                j += 1
            if size_a == size_b:
                groups.append((left, right))
                left, right = [], []
        assert not left and not right
        for left, right in groups:
            links += [(x, y) for x in left for y in right]
        held.update(set(links))
        out.append((a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = [
        (
            len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
            ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups),
        )
        for a, b, groups, links in out
    ]
    return rows, {(x, y): (n, n == most[x]) for (x, y), n in held.items()}


def some_texts(n, seed):
    draw = random.Random(seed)
    parts = [
        " ", "  ", "\n", "\n ", "\t", "a", "the", "world", "Übermut", "é", "😀", "\xa0", "　", "ſ", "ﬁ", "Ⅷ", "\x00", "<s>", "</s>",
        "<unk>", "<0x0A>", "<|endoftext|>", "'s", "123", "!", "..", "中文字符", "é", "\x85", "supercalifragilistic", "www.", "ключ", "▁",
    ]
    weights = [6] + [1] * (len(parts) - 2) + [0.05]
    return ["".join(draw.choices(parts, weights, k=draw.randint(0, 60))) for _ in range(n)]


def rows_of(done):
    return {r.doc_id: tuple(r[c] for c in COLUMNS[1:]) for r in done.collect()}


@pytest.mark.parametrize("small", [True, False])
def test_rows_and_pairs_equal_those_of_a_plain_count(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(alignment, "FAN_IN", 3)
    texts = [*some_texts(400, 1), None, "", "x" * 5000 + "😀" * 500, "the the the", "the the the", " ", "  ", "\n", "a▁b"]
    want, counted = plain(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(24)
    done, counts = alignment.align(docs)
    got = rows_of(done)
    assert len(got) == len(texts)
    for i, row in enumerate(want):
        assert got[i] == row, texts[i]
    assert {(r.first_id, r.second_id): (r.documents, r.highest) for r in alignment.pairs(counts).collect()} == counted
    if not small:
        digest, _ = alignment.align(docs, whole=False)
        for i, row in rows_of(digest).items():
            assert row[-1] == (hashlib.sha256(want[i][-1].encode()).hexdigest() if want[i][-1] else "")
    assert want[-1][:4] == (0, 0, 0, 0)


def test_memory_of_units_changes_nothing(monkeypatch):
    texts = some_texts(60, 2)
    know = alignment.Both(alignment.FIRST, alignment.SECOND)
    fresh = [alignment._worked_out([t], alignment.Both(alignment.FIRST, alignment.SECOND), 4, True) for t in texts[:6]]
    monkeypatch.setattr(alignment, "MEMORY", 20)
    for _ in range(2):
        for text, want in zip(texts, fresh):
            got = alignment._worked_out([text], know, 4, True)
            assert got[0] == want[0] and got[2] == want[2] and all((x == y).all() for x, y in zip(got[4:], want[4:]))


def test_empty_tables_clashing_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "one two", 3, "x"), (1, "one two", 3, "x"), (None, "one", 4, None), (2, None, 5, "y")], "doc_id long, text string, n_a int, batch string")
    got = sorted((tuple(r) for r in alignment.align(docs)[0].collect()), key=str)
    assert [r[0] for r in got] == [1, 1, 2, None] and got[0] == got[1]
    assert got[0][6] == 5 and got[2][1:7] == (0,) * 6 and got[2][7] == ""
    done, counts = alignment.align(docs.limit(0))
    assert done.count() == 0 and alignment.pairs(counts).count() == 0
    nulls = docs.where("text IS NULL")
    assert [r.n_links for r in alignment.align(nulls)[0].collect()] == [0]


def test_runs_are_merged_block_by_block(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 7)
    draw = np.random.default_rng(1)
    want, runs = Counter(), []
    for _ in range(20):
        keys = np.unique(draw.integers(0, 1 << 34, 50) >> draw.integers(0, 30))
        counts = draw.integers(1, 9, len(keys))
        runs.append(alignment.write_run(keys, counts))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
    pieces = list(alignment.merge_runs(runs))
    keys = np.concatenate([k for k, _ in pieces])
    assert len(pieces) > 5 and (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([c for _, c in pieces]).tolist())) == want
    marks = alignment.highest(np.array([1 << 32, 1 << 32 | 5, 2 << 32]), np.array([3, 3, 1]))
    assert marks.tolist() == [1, 1, 1]
