"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Pieces are dealt into blocks of some thousand. Each block is packed in its own task: best fit in
descending order, then exchanges that increase the sum of squared fills until bins run empty. The
emptiest bins of 32 blocks then meet in one block of the next round, until one block is left, so
that the whole table has no more underfull bins than a single block leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.base import aside, slices
from corpus_engine.llm.tokens import words
from corpus_engine.session import settled

CAPACITY = 4096
END = 1
BLOCK = 8192  # pieces in a block of the first round
JOINED = 32  # blocks that meet in the next round
OPEN = 64  # emptiest bins of a block that go on
TARGETS = 8  # emptiest bins that the search tries to empty, one after the other
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

PIECES = "row long, doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, path: str = VOCABULARY, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``row, doc_id, piece, start, length, ids`` of every row of ``docs`` (``doc_id, text``).

    The ids of the whole text and the end id, as little-endian unsigned 32-bit numbers; a text of
    more than ``capacity`` ids is cut into pieces of that length, the last one shorter. A null or
    empty text is the end id alone. ``row`` tells repeated doc_ids apart.
    """
    tail = int(end).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = words(path)
        for batch in slices(batches, "text", 4_000_000):
            rows: list[tuple] = []
            for row, doc, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ids = tokenizer.ids(text) + tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((row, doc, piece, at // 4, len(own) // 4, own))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = [f.split()[0] for f in PIECES.split(", ")]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return numbered.mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the bin with the least room that holds it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        fits = mask >> size
        if fits:
            have = size + (fits & -fits).bit_length() - 1
            at = room[have].pop()
            if not room[have]:
                mask &= ~(1 << have)
            bins[at].append(item)
            left = have - size
        else:
            at, left = len(bins), capacity - size
            bins.append([item])
        if left:
            room[left].append(at)
            mask |= 1 << left
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Bins that any packing needs: longer items than the rest of a bin take one each, and what of the
    shorter ones finds no room beside those of more than half a bin takes more. The best over all borders."""
    size = np.sort(np.asarray(lengths, dtype=np.int64))
    if not len(size):
        return 0
    total = np.concatenate([[0], np.cumsum(size)])
    half = int(np.searchsorted(size, capacity // 2, side="right"))
    border = np.unique(np.concatenate([[0], size[:half]]))
    long_from = np.searchsorted(size, capacity - border, side="right")
    small_from = np.minimum(np.searchsorted(size, border, side="left"), half)
    middle = np.maximum(long_from - half, 0)
    room = middle * capacity - (total[np.maximum(long_from, half)] - total[half])
    rest = np.maximum(total[half] - total[small_from] - room, 0)
    return int((len(size) - half + -(-rest // capacity)).max())


def _two(sizes: dict[int, list[int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Sums of two items of a bin, each once, in order, and the sizes they come from."""
    kinds = sorted(sizes)
    found = {a + b: (a, b) for i, a in enumerate(kinds) for b in kinds[: i + 1] if a != b or len(sizes[a]) > 1}
    sums = sorted(found)
    return np.array(sums, dtype=np.int64), [found[s] for s in sums]


def _exchange(low: dict[int, list[int]], high: dict[int, list[int]], room: int) -> bool:
    """Make the fuller bin fuller by one move, one-for-one or two-for-one exchange; True if one was found.

    Bins are items by size: what an exchange gains depends on sizes alone, and a bin has few of them,
    however many items it holds.
    """
    best, change = 0, None
    mine, theirs = sorted(low), sorted(high)
    for x in mine:
        if best < x <= room:
            best, change = x, ((x,), ())
    for x in mine:
        for y in theirs:
            if best < x - y <= room:
                best, change = x - y, ((x,), (y,))
    if best < room:
        sums, pairs = _two(high)
        for x in mine:  # one against two
            at = int(np.searchsorted(sums, x - room))
            if at < len(sums) and best < x - int(sums[at]) <= room:
                best, change = x - int(sums[at]), ((x,), pairs[at])
        sums, pairs = _two(low)
        for y in theirs:  # two against one
            at = int(np.searchsorted(sums, room + y, side="right")) - 1
            if at >= 0 and best < int(sums[at]) - y <= room:
                best, change = int(sums[at]) - y, (pairs[at], (y,))
    if change is None:
        return False
    for source, target, moved in ((low, high, change[0]), (high, low, change[1])):
        for kind in moved:
            item = source[kind].pop()
            if not source[kind]:
                del source[kind]
            target.setdefault(kind, []).append(item)
    return True


def improve(bins: list[list[int]], size: list[int], capacity: int, targets: int = TARGETS) -> list[list[int]]:
    """Empty bins by exchanges. Each exchange moves length from an emptier to a fuller bin, so the sum
    of squared fills only grows. Ends at ``lower_bound``, or when none of the ``targets`` emptiest bins
    has an exchange left."""
    least = lower_bound(size, capacity)
    held = []
    for items in bins:
        if items:
            by_size: dict[int, list[int]] = {}
            for i in items:
                by_size.setdefault(size[i], []).append(i)
            held.append([sum(size[i] for i in items), by_size])
    while len(held) > least:
        held.sort(key=lambda b: b[0])
        changed = emptied = False
        for low in held[:targets]:
            for high in sorted((b for b in held if b is not low), key=lambda b: b[0]):
                while low[1] and low[0] <= high[0] < capacity and _exchange(low[1], high[1], capacity - high[0]):
                    changed = True
                    total = low[0] + high[0]
                    low[0] = sum(kind * len(items) for kind, items in low[1].items())
                    high[0] = total - low[0]
                if not low[1]:
                    break
            if not low[1]:
                emptied = True
                break
        held = [b for b in held if b[1]]
        if not emptied and not changed:
            break
    return [[i for items in by_size.values() for i in items] for _, by_size in held]


KEYS = "row long, piece int, length long, block long, bin int, offset long, again boolean"


def _packer(capacity: int, joined: bool):
    """Pack one block; bins of the round before are kept if a new packing needs as many."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "piece"], ignore_index=True)
        size = group["length"].tolist()
        bins = best_fit(size, capacity)
        if joined:
            before = list(group.groupby(["block", "bin"], sort=True).indices.values())
            if len(before) <= len(bins):
                bins = [b.tolist() for b in before]
        bins = improve(bins, size, capacity)
        fill = [sum(size[i] for i in b) for b in bins]
        order = sorted(range(len(bins)), key=lambda k: (fill[k], k))
        place, offset, again = np.zeros(len(group), int), np.zeros(len(group), int), np.zeros(len(group), bool)
        for number, k in enumerate(order):
            own = sorted(bins[k])
            place[own] = number
            offset[own] = np.cumsum([0, *(size[i] for i in own[:-1])])
            again[own] = number < OPEN and fill[k] < capacity
        return pd.DataFrame(
            {
                "row": group["row"], "piece": group["piece"], "length": group["length"], "block": group["next"],
                "bin": place, "offset": offset, "again": again,
            }
        )

    return run


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (``row, piece, length`` and any other columns) with ``sequence_id`` and ``offset``.

    Every piece lies whole in one sequence; a sequence's pieces follow each other from offset 0
    without gaps, at most ``capacity`` in all. Pieces longer than that are an error. Ties are broken
    by row and piece. An empty table gives an empty result. Columns of ``parts`` that are called like the new
    ones are replaced.
    """
    parts = settled(parts.drop("sequence_id", "offset"), "packing-pieces")
    whole, widen = aside(parts, "row", "piece", "length")
    longest, total = parts.agg(F.max("length"), F.count("*")).first()
    if longest is not None and longest > capacity:
        raise ValueError(f"a piece of {longest} does not fit into {capacity}")
    blocks = max(1, -(-total // BLOCK))
    work = parts.select(
        "row", "piece", "length", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("bin"),
        F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)).alias("next"),
    )
    done, level = [], 0
    while True:
        packed = settled(
            work.groupBy("next").applyInPandas(_packer(capacity, level > 0), KEYS), "packing-round"
        )
        last = blocks == 1
        number = F.lit(level << 48) + F.shiftleft("block", 20) + F.col("bin")
        kept = packed if last else packed.where(~F.col("again"))
        done.append(kept.select("row", "piece", number.alias("sequence_id"), "offset"))
        if last:
            break
        work = packed.where("again").select(
            "row", "piece", "length", "block", "bin", F.floor(F.col("block") / JOINED).cast("long").alias("next")
        )
        blocks, level = -(-blocks // JOINED), level + 1
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    placed = placed.withColumnsRenamed({"row": "its_row", "piece": "its_piece"})
    here = (F.col("row") == F.col("its_row")) & (F.col("piece") == F.col("its_piece"))
    return widen(whole.join(placed, here), "sequence_id", "offset")
