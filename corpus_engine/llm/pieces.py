"""SentencePiece encoding and decoding by suffix-array matching.

The distinct units of a batch (runs of word marks with what follows up to the next mark) that are
not known yet are written one after another. A suffix array over this text gives, by binary search
for every piece of the vocabulary, the range of its occurrences. The occurrences are edges between
positions; sorted by their end they are relaxed: an edge extends the encoding that ends at its
start if the last piece there and the edge's piece may stand next to each other, that is if merging
in order of scores would never join across their border. Exactly one edge holds for each position,
so the result is the one of the merges themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.base import give_back_memory, slices

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
MEMORY = 550_000  # units remembered; only speed depends on it
LEARN = 900_000  # characters of new units worked out at once; a longer unit by itself
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")


class Vocabulary:
    """Pieces by order of merging, how each is joined, and which pairs join."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        plain.sort(key=lambda i: (-model.get_score(i), i))
        self.ids = np.array(plain, dtype=np.uint32)  # rank -> id
        self.texts = [model.id_to_piece(i) for i in plain]
        if any(MARK in t.lstrip(MARK) for t in self.texts):
            raise ValueError("pieces with a word mark inside are not supported")
        self.rank = {t: r for r, t in enumerate(self.texts)}
        self.sizes = np.array([len(t) for t in self.texts])
        self.longest = int(self.sizes.max())
        self.points = np.zeros((len(self.texts), self.longest), dtype=np.uint32)  # characters of each piece, zeros after it
        for r, t in enumerate(self.texts):
            self.points[r, : len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.uint32)
        self._learn()

    def _learn(self) -> None:
        """Left and right part of each piece by its last merge; pieces that merging never makes are dropped."""
        rank = self.rank
        score = np.arange(len(self.texts))
        self.left, self.right = score.copy(), score.copy()
        self.made = np.ones(len(self.texts), dtype=bool)
        for r, text in enumerate(self.texts):
            parts = list(text)
            while len(parts) > 2:
                joined = [rank.get(a + b, len(rank)) for a, b in zip(parts, parts[1:], strict=False)]
                best = min(joined)
                if best == len(rank):
                    break
                at = joined.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2 and parts[0] in rank and parts[1] in rank:
                self.left[r], self.right[r] = rank[parts[0]], rank[parts[1]]
            elif len(text) > 1:
                self.made[r] = False
        pairs = {}
        for r, text in enumerate(self.texts):
            for cut in range(1, len(text)):
                a, b = rank.get(text[:cut]), rank.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * len(rank) + b] = r
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces ``a`` and ``b`` (ranks; characters outside the vocabulary are larger) may
        stand next to each other: undo their merges, latest first, and see that no pair across the
        border would have been joined before the merge that is undone."""
        count = len(self.texts)
        good = np.ones(len(a), dtype=bool)
        open_ = np.flatnonzero((a < count) & (b < count))
        x, y = a[open_].astype(np.int64), b[open_].astype(np.int64)
        limit = np.full(len(open_), np.iinfo(np.int64).max)
        while len(open_):
            key = x * count + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), max(len(self.pair_keys) - 1, 0))
            joined = self.pair_keys[at] == key if len(self.pair_keys) else np.zeros(len(key), bool)
            bad = joined & (self.pair_rank[at] < limit) if len(self.pair_keys) else joined
            good[open_[bad]] = False
            split_x, split_y = self.left[x] != x, self.left[y] != y
            # A later merge is undone first. Of equal ones the right one is: it was done after the left.
            first = split_x & (~split_y | (x > y))
            second = ~first & split_y
            limit = np.where(first, x, np.where(second, y + 1, limit))
            x, y = np.where(first, self.right[x], x), np.where(second, self.left[y], y)
            go = ~bad & (first | second)
            open_, x, y, limit = open_[go], x[go], y[go], limit[go]
        return good


def _suffixes(codes: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in order of their next ``width`` codes (up to the end of the unit), and the packed codes."""
    bits = 8 if codes.max(initial=0) < 255 else 16 if codes.max(initial=0) < 65535 else 32
    each = 64 // bits
    words = []
    place = np.arange(len(codes))
    for start in range(0, width, each):
        word = np.zeros(len(codes), dtype=np.uint64)
        for k in range(start, start + each):
            at = np.minimum(place + k, len(codes) - 1)
            inside = (place + k < ends) & (k < width)
            word |= np.where(inside, codes[at], 0).astype(np.uint64) << np.uint64(64 - bits * (k - start + 1))
        words.append(word)
    order = np.lexsort(words[::-1])
    return order, [w[order] for w in words]


def _bounds(words: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """For each row of ``wanted`` the first place in the sorted ``words`` that is not smaller."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(words[0]))
    while (low < high).any():
        mid = np.minimum((low + high) // 2, len(words[0]) - 1)
        less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
        for have, want in zip(words, wanted, strict=True):
            less |= same & (have[mid] < want)
            same &= have[mid] == want
        going = low < high
        low, high = np.where(going & less, mid + 1, low), np.where(going & ~less, mid, high)
    return low


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known: dict[str, bytes] = {}

    def _match(self, codes: np.ndarray, ends: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``start, rank`` of every occurrence of every piece; codes count the ``alphabet`` from 1."""
        vocabulary, width = self.vocabulary, self.vocabulary.longest
        order, words = _suffixes(codes, ends, width)
        points = vocabulary.points
        at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
        ranks = np.flatnonzero(((alphabet[at] == points) | (points == 0)).all(axis=1) & vocabulary.made)
        if not len(ranks):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        table = np.where(points[ranks] > 0, at[ranks] + 1, 0).astype(np.uint64)
        bits = 8 if codes.max() < 255 else 16 if codes.max() < 65535 else 32
        each, full = 64 // bits, (1 << bits) - 1
        lengths = vocabulary.sizes[ranks]
        least, most = [], []
        for start in range(0, width, each):
            a, b = np.zeros(len(ranks), np.uint64), np.zeros(len(ranks), np.uint64)
            for k in range(start, start + each):
                own = table[:, k] if k < width else np.zeros(len(ranks), np.uint64)
                shift = np.uint64(64 - bits * (k - start + 1))
                a |= own << shift
                b |= np.where(k < lengths, own, full).astype(np.uint64) << shift
            least.append(a)
            most.append(b)
        low, high = _bounds(words, least), _bounds(words, most)
        count = high - low
        begin = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return order[begin], np.repeat(ranks, count)

    def learn(self, units: list[str]) -> None:
        """Encode new units together and remember their ids as bytes."""
        vocabulary, count = self.vocabulary, len(self.vocabulary.texts)
        points = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)
        alphabet, codes = np.unique(points, return_inverse=True)
        letters = list(map(chr, alphabet.tolist()))
        sizes = np.array([len(u) for u in units])
        finish = np.cumsum(sizes)
        begins = finish - sizes
        start, rank = self._match(codes + 1, np.repeat(finish, sizes), alphabet)
        # A character outside the vocabulary is a piece of its own, which joins with nothing.
        strange = np.flatnonzero(np.array([c not in vocabulary.rank for c in letters])[codes])
        start = np.concatenate([start, strange])
        rank = np.concatenate([rank, count + points[strange].astype(np.int64)])
        end = start + self._lengths(rank)
        # One step relaxes the edges that end at one distance from the begin of their units.
        distance = end - np.repeat(begins, sizes)[start]
        order = np.lexsort((start, distance))
        start, rank, end, distance = start[order], rank[order], end[order], distance[order]
        last = np.full(len(points) + 1, -1, dtype=np.int64)  # the piece that ends at a position
        first = np.zeros(len(points) + 1, dtype=bool)
        first[begins] = True
        cuts = np.flatnonzero(np.diff(distance, prepend=0))
        for a, b in zip(cuts, [*cuts[1:], len(distance)], strict=True):
            holds = first[start[a:b]]
            rest = np.flatnonzero(~holds & (last[start[a:b]] >= 0)) + a
            holds[rest - a] = vocabulary.neighbours(last[start[rest]], rank[rest])
            last[end[a:b][holds]] = rank[a:b][holds]
        self._collect(units, begins, finish, last)

    def _lengths(self, rank: np.ndarray) -> np.ndarray:
        sizes = self.vocabulary.sizes
        return np.where(rank < len(sizes), sizes[np.minimum(rank, len(sizes) - 1)], 1)

    def _collect(self, units: list[str], begins: np.ndarray, finish: np.ndarray, last: np.ndarray) -> None:
        """Follow the pieces of all units back from their ends."""
        vocabulary, count = self.vocabulary, len(self.vocabulary.texts)
        at, live, found = finish.copy(), np.arange(len(units)), []
        while len(live):
            rank = last[at[live]]
            found.append((live, at[live], rank))
            at[live] -= self._lengths(rank)
            live = live[at[live] > begins[live]]
        owner, place, rank = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((place, owner))
        owner, rank = owner[order], rank[order]
        cut = np.searchsorted(owner, np.arange(len(units) + 1))
        plain = rank < count
        known = np.minimum.reduceat(plain, cut[:-1])
        ids = vocabulary.ids[np.where(plain, rank, 0)]
        written = ids.tobytes()
        for unit, a, b, whole in zip(units, cut[:-1].tolist(), cut[1:].tolist(), known.tolist(), strict=True):
            if whole:
                self.known[unit] = written[4 * a : 4 * b]
            else:
                parts = [
                    i.tobytes() if p else vocabulary.bytes[list(chr(r - count).encode())].tobytes()
                    for i, p, r in zip(ids[a:b], plain[a:b], rank[a:b].tolist(), strict=True)
                ]
                self.known[unit] = b"".join(parts)

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, little-endian unsigned 32 bits. Null and empty texts have none."""
        split = [_UNIT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        used = {u for units in split for u in units}
        new = used - self.known.keys()
        if len(self.known) + len(new) > MEMORY:
            # what this batch uses is what the next ones will use most
            self.known = {u: self.known[u] for u in used - new}
        new = sorted(new)
        size = np.cumsum([len(u) for u in new])
        cuts = np.unique(np.searchsorted(size, np.arange(LEARN, int(size[-1]), LEARN))) if new else []
        for a, b in zip([0, *cuts], [*cuts, len(new)], strict=True):
            if a < b:
                self.learn(new[a:b])
        return [b"".join(map(self.known.__getitem__, units)) for units in split]


def written_pieces(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """What each id stands for: pieces with spaces for word marks, and single bytes."""
    written = [b""] * model.get_piece_size()
    for i in range(len(written)):
        if model.is_byte(i):
            written[i] = bytes([int(model.id_to_piece(i)[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            written[i] = model.id_to_piece(i).replace(MARK, " ").encode()
    return written


def text_of(ids: bytes, written: list[bytes]) -> str:
    """The text of ids; the leading space that encoding adds is taken off."""
    found = b"".join(map(written.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
    return found.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary."""
    return Encoder(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> list[bytes]:
    """What ids stand for; a worker that only decodes has no more than this."""
    return written_pieces(sentencepiece.SentencePieceProcessor(model_file=path))


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs`` (``doc_id, text``), for the whole text.

    Ids are little-endian unsigned 32-bit numbers. A space and the word mark itself are the same; a
    character outside the vocabulary becomes its UTF-8 bytes' pieces. A null text has null ids, an
    empty one none. Repeated rows stay apart; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            texts = batch.column(1).to_pylist()
            ids = [None if t is None else i for t, i in zip(texts, encoder(path).batch(texts), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        give_back_memory()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary"
    )


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with ``text``: the text with word marks as spaces. Null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", 2_000_000):
            ids = batch.column(1).to_pylist()
            texts = [None if i is None else text_of(i, decoder(path)) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
