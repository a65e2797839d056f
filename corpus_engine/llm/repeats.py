"""Removal of repeated passages: every byte covered by a string of ``WINDOW`` bytes that occurs twice.

1. Winnowing: each window of a text has an anchor, the window's ``GRAM`` bytes with the smallest
   hash. Equal windows have equal anchors at equal places, so only anchors that occur twice can
   belong to repeated windows.
2. An anchor's windows are read from the text as one context. Equal contexts repeat as a whole.
3. The different contexts of one anchor are written one after another and sorted by suffixes
   (``suffixes``); windows that are neighbours in this order and equal are repeated.

An anchor with more than ``MOST`` different contexts is split by where its windows lie, in halves,
down to single windows, so no task holds an unbounded group. Texts are handled once, however many
copies there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.base import aside, slices
from corpus_engine.llm.ngrams import flat
from corpus_engine.llm.suffixes import suffix_arrays
from corpus_engine.session import settled

WINDOW = 200
GRAM = 64
MOST = 32  # different contexts sorted together
REACH = 256  # a power of two over the places of an anchor in its window
SYMBOLS = 400_000  # symbols sorted in one go
SLICE = 1_000_000  # bytes hashed in one go
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.ones(size, dtype=np.uint64)
        done, factor = 1, base
        while done < size:
            step = min(done, size - done)
            powers[done : done + step] = powers[:step] * np.uint64(factor)
            done, factor = done + step, factor * factor % (1 << 64)
        out.append(powers)
    return out[0], out[1]


_LETTERS = np.random.default_rng(11).integers(1, 1 << 63, 512, dtype=np.uint64)


def window_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` symbols from each position on (only positions with so many left)."""
    n = len(symbols)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(1 << max(n, SLICE).bit_length())
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[symbols] * power[:n], out=total[1:])
    found = (total[size:] - total[:-size]) * inverse[: n - size + 1]
    found ^= found >> np.uint64(31)
    found *= _MIX
    found ^= found >> np.uint64(29)
    return found


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of ``width`` values from each position on; the first one of equals."""
    n = len(values)
    coded = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = coded
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[: n - width + 1], forward[width - 1 : n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(body: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """``row, hash, low, count, reach`` of all anchors: the windows from ``low`` on (in the row's
    bytes), how many, and how far the anchor lies behind the first one."""
    starts = len(body) - window + 1
    if starts < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    hashes = window_hashes(body, gram)
    at = _sliding_argmin(hashes, window - gram + 1)[:starts]
    fresh = np.ones(starts, dtype=bool)
    fresh[1:] = at[1:] != at[:-1]
    row = np.searchsorted(offsets, np.arange(starts), side="right") - 1
    good = np.arange(starts) + window <= offsets[row + 1]
    fresh[1:] |= (row[1:] != row[:-1]) | (good[1:] != good[:-1])
    low = np.flatnonzero(fresh)
    count = np.diff(np.append(low, starts))
    keep = good[low]
    low, count = low[keep], count[keep]
    row = row[low]
    return row, hashes[at[low]].view(np.int64), low - offsets[row], count, at[low] - low


_FOUND = "key binary, anchors array<struct<hash: bigint, low: int, count: int, reach: int>>"


def _winnow(window: int, gram: int):
    kind = pa.struct([("hash", pa.int64()), ("low", pa.int32()), ("count", pa.int32()), ("reach", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            body, offsets = flat(batch.column(1))
            row, *values = anchors(body, offsets, window, gram)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            fields = [pa.array(v.astype(t)) for v, t in zip(values, ("i8", "i4", "i4", "i4"), strict=True)]
            listed = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays(fields, fields=list(kind)))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], ["key", "anchors"])

    return run


def key_of(text) -> F.Column:
    """Sixteen bytes that stand for a text; null stands for the empty one."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _candidates(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``key, text, copies, anchors`` of the different texts with anchors that occur twice."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(key_of(F.col("text")).alias("key"), text.alias("text")).where(F.octet_length("text") >= window)
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    found = settled(keyed.mapInArrow(_winnow(window, gram), _FOUND), "repeat-anchors")
    each = found.select("key", F.inline("anchors"))
    # written, so that both sides of the join are dealt by hash anew and a hot anchor's part can be split
    twice = settled(each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeat-hashes")
    own = each.join(twice, "hash").groupBy("key").agg(
        F.collect_set(F.struct("hash", "low", "count", "reach")).alias("anchors")
    )
    return settled(texts.join(own, "key"), "repeat-texts")


# A row of a group: its context, and the text and first window if one text alone has it.
ROWS = "grp bigint, context binary, key binary, low int, reach int, known boolean"


def _contexts(window: int):
    """Each anchor's windows as one context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            rows: list[tuple] = []
            for key, text, copies, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = text.encode()
                for a in found:
                    context = body[a["low"] : a["low"] + a["count"] + window - 1]
                    rows.append((a["hash"], context, key, a["low"], a["reach"], copies > 1))
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_())
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    names = ["grp", "context", "key", "low", "reach", "known"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _halves(window: int, level: int):
    """Cut contexts to the windows whose anchor lies in one of 2**level equal ranges; the bytes that
    all windows of a range share become part of the group."""
    wide = REACH >> level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for grp, context, key, low, reach, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                windows = len(context) - window + 1
                for part in range(max(reach - windows + 1, 0) // wide, reach // wide + 1):
                    a = max(0, reach - (part + 1) * wide + 1)  # first window of the range
                    b = min(windows - 1, reach - part * wide)
                    if a > b:
                        continue
                    core = context[reach - part * wide : reach - (part + 1) * wide + 1 + window]
                    shared = xxhash.xxh64_intdigest(core, (grp + part) % (1 << 64)) - (1 << 63)
                    rows.append((shared, context[a : b + window], key, low + a, reach - a, known))
            yield _rows(rows)

    return run


def _shared(parts: list[bytes], group: list[int], width: int) -> np.ndarray:
    """How many leading bytes each part has in common with some other part of its group. In sorted
    order that is the most it shares with the part before or after it."""
    order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], parts[i])))
    sizes = np.array([len(p) for p in parts])[order]
    grid = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(-1, width)[order]
    differ = grid[1:] != grid[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    groups = np.array(group)[order]
    common[groups[1:] != groups[:-1]] = -1
    most = np.full(len(parts), -1)
    most[order[1:]] = common
    most[order[:-1]] = np.maximum(most[order[:-1]], common)
    return most


def trimmed(groups: list[list[tuple]], window: int) -> list[list[tuple]]:
    """The groups with each context cut to the bytes around the anchor that some other context of the
    group shares. No repeated window reaches beyond them; contexts that share less than a window
    before and behind the anchor together have none and go, as do groups with one context left."""
    rows = [r for g in groups for r in g]
    group = [k for k, g in enumerate(groups) for _ in g]
    left = _shared([r[1][: r[4]][::-1] for r in rows], group, window)
    right = _shared([r[1][r[4] : r[4] + window] for r in rows], group, window)
    out: list[list[tuple]] = [[] for _ in groups]
    for k, (grp, context, key, low, reach, known), a, b in zip(group, rows, left.tolist(), right.tolist(), strict=True):
        if a + b >= window:
            out[k].append((grp, context[reach - a : reach + b], key, low + reach - a, a, known))
    return [g for g in out if len(g) > 1]


def repeated_windows(contexts: list[bytes], bounds: np.ndarray, window: int) -> np.ndarray:
    """Whether each byte begins a window that some other place of its text equals. ``bounds``: which
    contexts make up a text. Contexts are closed by a separator, texts by an end symbol."""
    sizes = np.array([len(c) for c in contexts])
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", dtype=np.uint8)
    stops = np.cumsum(sizes + 1) - 1  # place of each separator
    symbols = raw.astype(np.int64) + 2
    symbols[stops] = 1
    # After its last separator each text gets one end symbol.
    last = stops[bounds[1:] - 1]
    padded = np.insert(symbols, last + 1, 0)
    ends = last + 1 + np.arange(len(last))
    order = suffix_arrays(padded, np.concatenate([[0], ends + 1]))
    shift = np.searchsorted(last, np.arange(len(raw)))  # end symbols before a byte
    back = np.full(len(padded), -1)
    back[np.arange(len(raw)) + shift] = np.arange(len(raw))
    begins = np.concatenate([[0], stops[:-1] + 1])
    valid = np.zeros(len(raw), dtype=bool)
    counts = np.maximum(sizes - window + 1, 0)
    spots = np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)
    valid[spots] = True
    place = back[order]
    place = place[(place >= 0)]
    place = place[valid[place]]
    again = np.zeros(len(raw), dtype=bool)
    if len(place) < 2:
        return again
    hashes = window_hashes(raw, window)
    a, b = place[:-1], place[1:]
    same = np.flatnonzero(hashes[a] == hashes[b])
    a, b = a[same], b[same]
    words = np.ndarray((len(raw) - 7,), dtype=np.uint64, buffer=raw, strides=(1,))
    for step in range(0, window, 8):  # equal hashes are compared byte by byte
        step = min(step, window - 8)
        true = words[a + step] == words[b + step]
        a, b = a[true], b[true]
    text = np.searchsorted(ends - np.arange(len(ends)), np.concatenate([a, b]), side="right")
    inside = text[: len(a)] == text[len(a) :]
    again[a[inside]] = again[b[inside]] = True
    return again


OUT = "grp bigint, context binary, key binary, low int, reach int, known boolean, high int"


def _sorted_groups(window: int, most: int):
    """Over rows sorted by group: windows that repeat as ``key, low, high``, and the rows of groups of
    more than ``most`` contexts unchanged, with no ``high``."""

    def ranges(groups: list[list[tuple]]) -> Iterator[tuple]:
        groups = sorted(groups, key=lambda g: sum(len(r[1]) for r in g))
        while groups:
            some, size = [], 0
            while groups and (not some or size < SYMBOLS):
                some.append(groups.pop())
                size += sum(len(r[1]) for r in some[-1])
            some = trimmed(some, window)
            if not some:
                continue
            rows = [r for g in some for r in g]
            bounds = np.cumsum([0, *(len(g) for g in some)])
            again = repeated_windows([r[1] for r in rows], bounds, window)
            at = 0
            for grp, context, key, low, reach, known in rows:
                if not known:
                    own = again[at : at + len(context)].astype(np.int8)
                    edge = np.flatnonzero(np.diff(own, prepend=0, append=0))
                    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                        yield grp, None, key, low + a, reach, known, low + b - 1
                at += len(context) + 1

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.int32())
        names = [f.split()[0] for f in OUT.split(", ")]
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        waiting: list[list[tuple]] = []
        weight, hot = 0, None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] == hot:
                    out.append((*row, None))
                    continue
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        waiting.append(group)
                        weight += sum(len(r[1]) for r in group)
                    group = []
                group.append(row)
                if len(group) > most:
                    hot = row[0]
                    out += [(*r, None) for r in group]
                    group = []
                if weight > 2 * SYMBOLS:
                    out += ranges(waiting)
                    waiting, weight = [], 0
            yield from emit(out)
        if len(group) > 1:
            waiting.append(group)
        yield from emit(list(ranges(waiting)))

    return run


def _resolve(rows: DataFrame, window: int, most: int, level: int) -> DataFrame:
    """``key, low, high``: runs of repeated windows among the rows of all groups."""
    marked = rows.withColumn("digest", F.unhex(F.md5("context")))
    once = marked.groupBy("grp", "digest").agg(
        F.first("context").alias("context"), F.count("*").alias("n"), F.max("known").alias("known"),
        F.min("key").alias("key"), F.min("low").alias("low"), F.min("reach").alias("reach"),
    )
    once = settled(once.withColumn("known", F.col("known") | (F.col("n") > 1)), "repeat-contexts")
    twice = once.where("n > 1").select("grp", "digest")
    whole = (
        marked.where(~F.col("known"))
        .select("grp", "digest", "key", "low", (F.col("low") + F.length("context") - window).alias("high"))
        .join(twice, ["grp", "digest"])
        .select("key", "low", "high")
    )
    columns = [f.split()[0] for f in ROWS.split(", ")]
    found = settled(
        once.select(columns).repartition("grp").sortWithinPartitions("grp").mapInArrow(_sorted_groups(window, most), OUT),
        "repeat-found",
    )
    runs = settled(whole, "repeat-whole").unionByName(
        found.where(F.col("high").isNotNull()).select("key", "low", "high")
    )
    over = found.where(F.col("high").isNull()).select(columns)
    if REACH >> level <= 1 or over.isEmpty():
        return runs
    return runs.unionByName(_resolve(over.mapInArrow(_halves(window, level + 1), ROWS), window, most, level + 1))


RESULT = "key binary, kept binary, n_removed bigint, n_spans bigint"


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for key, text, copies, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = text.encode()
                spans = [(0, len(body))] if copies > 1 else sorted((r["low"], r["high"] + window) for r in runs)
                kept, at, merged = [], 0, 0
                for low, high in spans:
                    if low > at or not merged:
                        merged += 1
                        kept.append(body[at:low])
                    at = max(at, high)
                kept.append(body[at:])
                left = b"".join(kept)
                rows.append((key, left, len(body) - len(left), merged))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["key", "kept", "n_removed", "n_spans"]
            )

    return run


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """``key, kept, n_removed, n_spans`` of each different text that loses bytes.

    ``key`` is ``key_of`` the text; ``kept`` holds the remaining bytes joined. A null text counts as
    empty; texts under ``window`` bytes lose nothing, and a text that occurs twice loses all.
    Extra columns of ``docs`` are not looked at. No rows give no rows.
    """
    if not 8 <= gram <= window or window - gram >= REACH:
        raise ValueError("needs 8 <= gram <= window < gram + 256")
    texts = _candidates(docs, window, gram)
    rows = texts.select("key", "text", "copies", "anchors").mapInArrow(_contexts(window), ROWS)
    runs = _resolve(rows, window, most, 0)
    listed = runs.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    cut = texts.select("key", "text", "copies").join(listed, "key", "left").where("copies > 1 or runs is not null")
    return settled(cut.mapInArrow(_cut(window), RESULT), "repeat-removals")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **bounds: int) -> DataFrame:
    """``docs`` with repeated bytes taken out of ``text``; halves of characters at the cuts go as well.

    Null texts stay null. A text that is repeated as a whole becomes empty; its row stays.
    """
    lost = removals(docs, window, **bounds).select(F.col("key").alias("lost_key"), F.col("kept").alias("lost_kept"))

    @F.pandas_udf("string")
    def readable(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    narrow, widen = aside(docs, "text")
    joined = narrow.join(lost, key_of(F.col("text")) == F.col("lost_key"), "left")
    text = F.when(F.col("lost_key").isNull(), F.col("text").cast("string")).otherwise(readable("lost_kept"))
    return widen(joined.withColumn("text", text))
