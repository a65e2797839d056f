"""How the tokens of two tokenizers line up, and how many documents hold each pair of them.

Both tokenizers cut at the border between a visible character and a space, so a text is worked out in
units that begin with a space; what is known of a unit is remembered. Batches of documents yield runs:
for each radix of the first token the batch's pairs in order, with the number of documents that hold
them, packed with zstd. Runs of a radix are merged by a heap of their blocks, some hundred at a time,
until one is left; in it the pairs of a first token stand side by side, which gives the token's highest
count. Counts then go back to every run in its own order, and from there to the documents.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus_engine.llm.base import give_back_memory, slices
from corpus_engine.session import settled

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")

BATCH_BYTES = 700_000  # text worked out at once; a longer text is a batch of its own
MEMORY = 80_000  # units remembered; only speed depends on it
LEARN = 100_000  # characters of new units worked out at once; a longer unit by itself
SMALL_GROUP = 64  # links of a group up to which they are written one by one
LONG_UNIT = 200  # characters of a unit beyond which it is not remembered
RADIX_BYTES = 24_000_000  # text for each radix, up to RADIXES
RADIXES = 512
FAN_IN = 256  # runs merged at once
BLOCK = 65_536  # pairs of a block of a run

_BORDER = re.compile(r"(?<=\S)(?= )")


# --- units ---------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {chr(b if b in shown else next(hidden)): b for b in range(256)}


def _piece_bytes(piece: str) -> bytes:
    byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def _stretches(ends: array, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of ``units``, one unit after the other, and how many each has."""
    begin = np.frombuffer(ends, dtype=np.int64)
    size = begin[units + 1] - begin[units]
    return np.repeat(begin[units] - np.cumsum(size) + size, size) + np.arange(size.sum()), size


class Both:
    """Units of text under both tokenizers, with a memory.

    For unit ``u`` the tables hold the numbers of first and second tokens, groups and links, the groups
    written out, and its pairs (``first << 32 | second``) with how often each is linked. A unit whose
    tokens do not spell it has ``good`` 0 and no tokens.
    """

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        letters = _byte_letters()
        vocabulary = self.first.get_vocab(with_added_tokens=True)
        spelt = {i: bytes(map(letters.__getitem__, t)) for t, i in vocabulary.items() if all(c in letters for c in t)}
        self.first_bytes = [spelt.get(i, b"") for i in range(max(vocabulary.values()) + 1)]
        self.second_bytes = [_piece_bytes(self.second.id_to_piece(i)) for i in range(len(self.second))]
        self.first_size, self.second_size = (np.array([len(t) for t in x]) for x in (self.first_bytes, self.second_bytes))
        self.space = self.second.piece_to_id("▁")
        self.ids = max(len(self.first_bytes), len(self.second_bytes))
        self.shown = [b"%d%c" % (i, mark) for mark in b",|;\n" for i in range(self.ids)]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = {n: array("q") for n in ("first", "second", "groups", "links", "good")}
        self.written: list[bytes] = []
        self.pairs, self.times, self.ends = array("q"), array("q"), array("q", [0])
        self.uses = np.zeros(0, dtype=np.int64)

    def used(self, units: np.ndarray) -> None:
        """Note which units occurred."""
        many = np.bincount(units, minlength=len(self.written))
        many[: len(self.uses)] += self.uses
        self.uses = many

    def thin(self) -> None:
        """Forget units that hardly occurred, and half of what is remembered at least."""
        name = {n: u for u, n in self.number.items()}
        keep = np.array([n for n in np.flatnonzero(self.uses > 1).tolist() if n in name], dtype=np.int64)
        if len(keep) > MEMORY // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[: MEMORY // 2]])
        spot, size = _stretches(self.ends, keep)
        uses = self.uses[keep] // 2
        counts = {n: np.frombuffer(c, dtype=np.int64)[keep] for n, c in self.counts.items()}
        pairs, times = (np.frombuffer(x, dtype=np.int64)[spot] if len(spot) else np.zeros(0, np.int64) for x in (self.pairs, self.times))
        written = [self.written[n] for n in keep.tolist()]
        self.forget()
        self.written, self.uses = written, uses
        self.number = {name[n]: k for k, n in enumerate(keep.tolist())}
        for n, values in counts.items():
            self.counts[n].frombytes(values.tobytes())
        self.pairs.frombytes(pairs.tobytes())
        self.times.frombytes(times.tobytes())
        self.ends.frombytes(np.cumsum(size).astype(np.int64).tobytes())

    def _tokens(self, units: list[str]) -> tuple:
        """First and second tokens, one unit after the other, with the numbers of each; and which units both sides
        spell. The others have no tokens. Units that end in a visible character are cut as one text."""
        raw = list(map(str.encode, units))
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        whole = b"".join(raw)
        if not any(u[-1].isspace() for u in units):
            text, flats = "".join(units), []
            listed = self.first.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.second.encode(text[1:])
            for tokens, spelt, sizes in zip(listed, (self.first_bytes, self.second_bytes), (self.first_size, self.second_size)):
                flat = np.array(tokens, dtype=np.int64)
                ends, border = np.cumsum(sizes[flat]), np.cumsum(size)
                if b"".join(map(spelt.__getitem__, tokens)) == whole and np.isin(border, ends).all():
                    flats.append((flat, np.diff(np.searchsorted(ends, border, side="right"), prepend=0)))
            if len(flats) == 2:
                return *flats, np.ones(len(units), dtype=bool)
        a = [e.ids for e in self.first.encode_batch_fast(units, add_special_tokens=False)]
        # the second tokenizer adds the space itself, but not to nothing
        b = self.second.encode([u[1:] for u in units], num_threads=1)
        if " " in units:
            b[units.index(" ")] = [self.space]
        good = np.ones(len(units), dtype=bool)
        flats = []
        for tokens, spelt, sizes in ((a, self.first_bytes, self.first_size), (b, self.second_bytes, self.second_size)):
            listed = list(chain.from_iterable(tokens))
            flat, many = np.array(listed, dtype=np.int64), np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
            flats.append((flat, many))
            same = np.bincount(np.repeat(np.arange(len(units)), many), sizes[flat], len(units)) == size
            if not same.all() or b"".join(map(spelt.__getitem__, listed)) != whole:
                good &= [b"".join(map(spelt.__getitem__, t)) == r for t, r in zip(tokens, raw, strict=True)]
        return *((flat[np.repeat(good, many)], np.where(good, many, 0)) for flat, many in flats), good

    def learn(self, units: list[str]) -> None:
        """Work out units and remember them."""
        (flat_a, size_a), (flat_b, size_b), good = self._tokens(units)
        end_a, end_b = np.cumsum(self.first_size[flat_a]), np.cumsum(self.second_size[flat_b])
        at = np.minimum(np.searchsorted(end_b, end_a), max(0, len(end_b) - 1))
        cut = end_a[end_b[at] == end_a] if len(end_b) else end_a
        cut = cut[np.flatnonzero(np.diff(cut, prepend=-1))]
        group_a, group_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
        unit_a = np.repeat(np.arange(len(units)), size_a)
        first_a = np.cumsum(in_a) - in_a
        unit_of = unit_a[first_a]  # of each group
        groups = np.bincount(unit_of, minlength=len(units))
        start = len(self.written)
        self._write(flat_a, flat_b, group_a, group_b, unit_of, len(units))
        keys, times, owner = self._linked(flat_a, flat_b, group_a, in_a, in_b, unit_of)
        links = np.zeros(len(units), dtype=np.int64)
        np.add.at(links, unit_of, in_a * in_b)
        for name, values in (("first", size_a), ("second", size_b), ("groups", groups), ("links", links), ("good", good)):
            self.counts[name].frombytes(values.astype(np.int64).tobytes())
        begin = len(self.pairs)
        self.pairs.frombytes(keys.tobytes())
        self.times.frombytes(times.tobytes())
        self.ends.frombytes((begin + np.cumsum(np.bincount(owner, minlength=len(units)))).astype(np.int64).tobytes())
        self.number.update(zip(units, range(start, start + len(units)), strict=True))

    def _write(self, flat_a, flat_b, group_a, group_b, unit_of, units: int) -> None:
        """Every unit's groups as ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = (np.diff(g, append=-1) != 0 for g in (group_a, group_b))
        ends_unit = np.diff(unit_of, append=-1) != 0
        mark_a = np.where(last_a, 1, 0)
        mark_b = np.where(last_b, np.where(ends_unit[group_b], 3, 2), 0)
        at = np.concatenate([mark_a * self.ids + flat_a, mark_b * self.ids + flat_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = b"".join(map(self.shown.__getitem__, at[order].tolist())).split(b"\n")
        out = [b""] * units
        for unit, text in zip(unit_of[ends_unit].tolist(), shown, strict=False):
            out[unit] = text
        self.written += out

    def _linked(self, flat_a, flat_b, group_a, in_a, in_b, unit_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each unit's pairs once, with their numbers of links, and the unit."""
        first_b = np.cumsum(in_b) - in_b
        small = in_a * in_b <= SMALL_GROUP
        repeat = np.where(small, in_b, 0)[group_a]
        spot = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        keys = [np.repeat(flat_a, repeat) << 32 | flat_b[np.repeat(first_b[group_a], repeat) + spot]]
        owner = [np.repeat(unit_of[group_a], repeat)]
        times = [np.ones(len(keys[0]), dtype=np.int64)]
        first_a = np.cumsum(in_a) - in_a
        for g in np.flatnonzero(~small).tolist():
            # a long group: tokens that occur again share their pairs
            left, many = np.unique(flat_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            right, often = np.unique(flat_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            keys.append((left[:, None] << 32 | right[None, :]).ravel())
            times.append((many[:, None] * often[None, :]).ravel())
            owner.append(np.full(len(keys[-1]), unit_of[g]))
        key, time, own = np.concatenate(keys), np.concatenate(times), np.concatenate(owner)
        order = np.lexsort((key, own))
        key, time, own = key[order], time[order], own[order]
        first = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(own, prepend=-1) != 0))
        return key[first], np.add.reduceat(time, first) if len(first) else time, own[first]

    def units(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the units of texts; those not known yet are learnt together."""
        if len(self.written) > MEMORY:
            self.thin()
        if len(self.pairs) > 10 * MEMORY:
            self.forget()
        cut = [_BORDER.split(" " + t) if t else [] for t in texts]
        known = self.number
        new = [u for u in dict.fromkeys(chain.from_iterable(cut)) if u not in known]
        for some in ([u for u in new if not u[-1].isspace()], [u for u in new if u[-1].isspace()]):
            size = np.cumsum([len(u) for u in some])
            cuts = np.unique(np.searchsorted(size, np.arange(LEARN, int(size[-1]), LEARN))) if some else []
            for part in (some[a:b] for a, b in zip([0, *cuts], [*cuts, len(some)]) if a < b):
                self.learn(part)
        out = [list(map(known.__getitem__, units)) for units in cut]
        for u in new:
            if len(u) > LONG_UNIT:
                del known[u]
        return out


@lru_cache(maxsize=1)
def both(first: str, second: str) -> Both:
    """One per Python worker."""
    return Both(first, second)


# --- runs ----------------------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.tobytes())


def _unpacked(raw: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Steps between sorted keys; other numbers as they are."""
    return np.diff(values, prepend=0)


def write_run(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """A run: blocks of sorted keys with columns beside them, each block packed by itself."""
    out = []
    for a in range(0, len(keys), BLOCK):
        part = slice(a, a + BLOCK)
        block = np.concatenate([_narrow(keys[part]), *(c[part].astype(np.int64) for c in columns)])
        packed = _packed(block)
        out.append(struct.pack("<II", len(keys[part]), len(packed)) + packed)
    return b"".join(out)


def read_run(run: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """The blocks of a run: keys and columns."""
    at = 0
    while at < len(run):
        rows, size = struct.unpack_from("<II", run, at)
        block = _unpacked(run[at + 8 : at + 8 + size]).reshape(-1, rows)
        yield np.cumsum(block[0]), *block[1:]
        at += 8 + size


def merge_runs(runs: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in order with their added counts, over all runs, in pieces.

    A heap has each run's current block by its last key. Up to the smallest of these, all runs are
    known; that much of each is put together, and the run at the top goes on to its next block. Of each
    run one block is in memory.
    """
    blocks = [read_run(r) for r in runs]
    now: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(k: int) -> None:
        block = next(blocks[k], None)
        if block is not None:
            now[k] = block[0], block[1]
            heapq.heappush(heap, (int(block[0][-1]), k))
        else:
            now.pop(k, None)

    for k in range(len(blocks)):
        advance(k)
    while heap:
        upto = heap[0][0]
        keys, counts = [], []
        for k, (key, count) in now.items():
            n = int(np.searchsorted(key, upto, side="right"))
            if n:
                keys.append(key[:n])
                counts.append(count[:n])
                now[k] = key[n:], count[n:]
        while heap and heap[0][0] == upto:
            advance(heapq.heappop(heap)[1])
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[first], np.add.reduceat(count, first)


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where a pair's count is the highest of its first token, else 0. Pairs of a first token stand together."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    side = keys >> 32
    first = np.flatnonzero(np.diff(side, prepend=-1))
    most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(side))))
    return (counts == most).astype(np.int64)


def radix_of(keys: np.ndarray, radixes: int) -> np.ndarray:
    """The radix of pairs, by their first token."""
    return (((keys >> 32) * 2654435761) >> 9) % radixes


# --- batches of documents ------------------------------------------------------------------------

#: ``part`` tells rows apart: a radix for runs, ``LINKS`` for a batch's links, ``DOCUMENT`` for a document.
LINKS, DOCUMENT = -1, -2
ROWS = pa.schema(
    [
        ("batch", pa.int64()), ("part", pa.int32()), ("run", pa.binary()), ("at", pa.int32()), ("doc_id", pa.int64()),
        *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups", pa.binary()),
    ]
)
ROW_TYPES = (
    "batch long, part int, run binary, at int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary"
)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that end at ``ends``."""
    total = np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])]
    return np.diff(total)


def _worked_out(texts: list[str | None], know: Both, radixes: int, whole: bool):
    """Documents' columns, the batch's links, and its runs by radix."""
    units: list[int] = []
    ends, told = [], []
    for mine in know.units(texts):
        if not all(map(know.counts["good"].__getitem__, mine)):
            mine = []
        units += mine
        ends.append(len(units))
        groups = b";".join(map(know.written.__getitem__, mine)) if mine else b""
        told.append(groups if whole or not mine else hashlib.sha256(groups).hexdigest().encode())
    u, ends = np.array(units, dtype=np.int64), np.array(ends, dtype=np.int64)
    know.used(u)
    table = {n: np.frombuffer(c, dtype=np.int64) if len(c) else np.zeros(0, np.int64) for n, c in know.counts.items()}
    columns = [_sums(table[n][u], ends) for n in ("first", "second", "groups", "links")]
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    # each unit of a document once, then its pairs
    many = max(1, len(know.written))
    once, again = np.unique(doc * many + u, return_counts=True)
    doc, u = once // many, once % many
    spot, size = _stretches(know.ends, u)
    pair = np.frombuffer(know.pairs, dtype=np.int64)[spot] if len(spot) else np.zeros(0, np.int64)
    times = np.frombuffer(know.times, dtype=np.int64)[spot] * np.repeat(again, size) if len(spot) else pair
    keys, place = np.unique(pair, return_inverse=True)
    part = radix_of(keys, radixes)
    order = np.lexsort((keys, part))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    keys, part = keys[order], part[order]
    links = np.repeat(doc, size) * max(1, len(keys)) + rank[place]
    by = np.argsort(links, kind="stable")
    links, times = links[by], times[by]
    first = np.flatnonzero(np.diff(links, prepend=-1))
    times = np.add.reduceat(times, first) if len(first) else times
    links = links[first]
    holders = np.bincount(links % max(1, len(keys)), minlength=len(keys))
    return told, columns, write_run(links, times), len(keys), part, keys, holders


def _runs(docs: DataFrame, first: str, second: str, radixes: int, whole: bool) -> DataFrame:
    """Rows of all batches, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", BATCH_BYTES):
            number += 1
            told, columns, links, size, part, keys, holders = _worked_out(
                batch.column(1).to_pylist(), both(first, second), radixes, whole
            )
            n = batch.num_rows
            cuts = np.searchsorted(part, np.arange(radixes + 1))
            present = [p for p in range(radixes) if cuts[p] < cuts[p + 1]]
            runs = [links] + [write_run(keys[cuts[p] : cuts[p + 1]], holders[cuts[p] : cuts[p + 1]]) for p in present]
            more = len(runs)
            none = [None] * more
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * (n + more), pa.int64()),
                    pa.array([DOCUMENT] * n + [LINKS] + present, pa.int32()),
                    pa.array([None] * n + runs, pa.binary()),
                    # the links' row has the number of pairs
                    pa.array([*range(n), size, *none[1:]], pa.int32()),
                    pa.array(batch.column(0).to_pylist() + none, pa.int64()),
                    *(pa.array(c.tolist() + none, pa.int64()) for c in columns),
                    pa.array([*told, *none], pa.binary()),
                ],
                schema=ROWS,
            )
        # the worker goes on with other stages
        both(first, second).forget()
        give_back_memory()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settled(texts.mapInArrow(run, ROW_TYPES), "token-runs")


# --- counting and giving back --------------------------------------------------------------------


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One run of the runs of a radix and group."""
    pieces = list(merge_runs(rows["run"]))
    run = write_run(np.concatenate([k for k, _ in pieces]), np.concatenate([c for _, c in pieces]))
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "bunch": [rows["bunch"].iloc[0]], "run": [run]})


def _with_highest(rows: pd.DataFrame) -> pd.DataFrame:
    """The last run of a radix, with a mark on each first token's highest pairs."""
    pieces = list(merge_runs(rows["run"]))
    keys, counts = np.concatenate([k for k, _ in pieces]), np.concatenate([c for _, c in pieces])
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "counts": [write_run(keys, counts, highest(keys, counts))]})


def pair_counts(runs: DataFrame, batches: int) -> DataFrame:
    """``part, counts``: for each radix all pairs with the number of documents that hold them.

    Merged in rounds of about ``FAN_IN`` runs, so that no task holds more; what is left of a radix is at most
    the pairs that its tokens can form, whatever the number of documents.
    """
    bunches = math.ceil(batches / FAN_IN)
    current = runs.withColumn("bunch", F.pmod(F.xxhash64("batch"), F.lit(bunches))).select("part", "bunch", "run")
    while bunches > 1:
        merged = settled(current.groupBy("part", "bunch").applyInPandas(_merged, "part int, bunch long, run binary"), "merged-runs")
        bunches = math.ceil(bunches / FAN_IN)
        current = merged.withColumn("bunch", F.pmod("bunch", F.lit(bunches)))
    return settled(current.groupBy("part").applyInPandas(_with_highest, "part int, counts binary"), "pair-counts")


def _answers(runs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Each run's pairs' counts and marks, in the run's order."""
    out = []
    if len(runs):
        blocks = list(read_run(counts["counts"].iloc[0]))
        keys, many, best = (np.concatenate([b[i] for b in blocks]) for i in range(3))
        for run in runs["run"]:
            at = np.searchsorted(keys, np.concatenate([b[0] for b in read_run(run)]))
            out.append(_packed(np.concatenate([many[at], best[at]])))
    return pd.DataFrame({"batch": runs["batch"], "part": runs["part"], "answer": pd.Series(out, index=runs.index, dtype=object)})


def _given_back(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """A batch's documents with what their links add up to."""
    docs = rows[rows["part"] == DOCUMENT].sort_values("at")
    links = rows[rows["part"] == LINKS]
    best, total = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
    if len(links) and len(answers):
        read = [_unpacked(a).reshape(2, -1) for a in answers.sort_values("part")["answer"]]
        many, mark = (np.concatenate([r[i] for r in read]) for i in range(2))
        size = int(links["at"].iloc[0])
        for link, times in read_run(links["run"].iloc[0]):
            doc, pair = link // size, link % size
            for out, worth in ((best, mark), (total, many)):
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                # a document's links may go on in the next block
                np.add.at(out, doc[first], np.add.reduceat(times * worth[pair], first))
    out = docs[["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]].copy()
    out.insert(5, "n_best", best)
    out.insert(6, "count_sum", total)
    return out


DONE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups binary"
)


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND, whole: bool = True) -> tuple[DataFrame, DataFrame]:
    """Documents with their token groups, and the counted pairs.

    The first table has a row for every row of ``docs`` (``doc_id, text``): ``doc_id``, the numbers of first
    and second tokens, of groups and links, of links whose pair has its first token's highest count, the sum of
    the links' counts, and the groups as ``a1,a2|b1;a3|b2,b3`` (``whole``) or their SHA-256 in hex. The text is
    encoded with a space in front. Texts that are null, empty or not spelt by the tokens of both sides have no
    tokens: zeros, and no groups. Repeated rows are documents of their own; an empty table gives no rows; other
    columns are not looked at. The second table has the pairs: ``part, counts``, to be read with ``pairs``.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    radixes = max(8, min(RADIXES, math.ceil(size / RADIX_BYTES)))
    rows = _runs(docs, first, second, radixes, whole)
    runs = rows.where(F.col("part") >= 0).select("batch", "part", "run")
    batches = rows.where(F.col("part") == LINKS).count()
    counts = pair_counts(runs, max(1, batches))
    # the counts meet the runs in bunches, so that a task holds some hundred runs however many there are
    bunches = math.ceil(max(1, batches) / FAN_IN)
    asked = runs.withColumn("bunch", F.pmod(F.xxhash64("batch"), F.lit(bunches)))
    known = counts.withColumn("bunch", F.explode(F.sequence(F.lit(0), F.lit(bunches - 1)))).select(
        "part", F.col("bunch").cast("long").alias("bunch"), "counts"
    )
    both_sides = asked.groupBy("part", "bunch").cogroup(known.groupBy("part", "bunch"))
    answers = both_sides.applyInPandas(_answers, "batch long, part int, answer binary")
    back = rows.where(F.col("part") < 0).groupBy("batch").cogroup(answers.groupBy("batch"))
    done = back.applyInPandas(_given_back, DONE).withColumn("groups", F.col("groups").cast("string"))
    return done, counts


def pairs(counts: DataFrame) -> DataFrame:
    """``first_id, second_id, documents, highest`` of every counted pair."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for packed in frame["counts"]:
                for key, many, best in read_run(packed):
                    yield pd.DataFrame({"first_id": key >> 32, "second_id": key & 0xFFFFFFFF, "documents": many, "highest": best == 1})

    return counts.select("counts").mapInPandas(run, "first_id long, second_id long, documents long, highest boolean")
