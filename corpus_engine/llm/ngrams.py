"""Hashed n-grams of whole texts, computed for an Arrow column at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MIX = np.uint32(2654435761)
_ROLL = (np.uint64(257) ** np.arange(256, dtype=np.uint64)).astype(np.uint32)

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes in one array, and the offsets of its rows; null counts as empty."""
    whole = pc.fill_null(values.cast(pa.large_string()), "")
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def byte_grams(body: np.ndarray, offsets: np.ndarray, size: int, bits: int) -> np.ndarray:
    """A bucket for the ``size`` bytes from each position on; ``2**bits`` where they leave the row."""
    found = np.zeros(len(body), dtype=np.uint32)
    for k in range(size):
        found[: len(body) - k] += body[k:].astype(np.uint32) << np.uint32(8 * k)
    found += np.uint32(size)
    found *= _MIX
    found ^= found >> np.uint32(15)
    found *= _MIX
    found >>= np.uint32(32 - bits)
    for k in range(1, size):
        late = offsets[1:] - k
        found[late[late >= offsets[:-1]]] = 1 << bits
    return found


def word_grams(body: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket for each word between ASCII white space, and the offsets of the rows in words."""
    inside = ~SPACE[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(body)]
    first[edge] = inside[edge]
    starts = np.flatnonzero(first)
    counts = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint32), counts
    place = np.arange(len(body)) - np.repeat(starts, np.diff(np.append(starts, len(body)))) if starts[0] == 0 else None
    if place is None:
        place = np.arange(len(body))
        place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(body))))
    part = (body.astype(np.uint32) + np.uint32(1)) * _ROLL[place & 255] * inside
    found = np.add.reduceat(part, starts, dtype=np.uint32)
    found *= _MIX
    found ^= found >> np.uint32(15)
    found *= _MIX
    return found >> np.uint32(32 - bits), counts


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between offsets; zero for empty rows."""
    out = np.zeros(len(offsets) - 1)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.float64)
    return out


class Grams:
    """Hashed features of several kinds: bytes n-grams of the given sizes, and words if asked for.

    A kind's features of a text are its buckets' shares of the text's n-grams of that kind, times
    ``SCALE``, so that whole texts of any length are on one scale.
    """

    SCALE = 30.0

    def __init__(self, sizes: tuple[int, ...], bits: int, words: bool, fold: bool):
        self.sizes, self.bits, self.words, self.fold = sizes, bits, words, fold

    @property
    def kinds(self) -> int:
        return len(self.sizes) + self.words

    @property
    def width(self) -> int:
        """Buckets of all kinds, each with one more that stands for no n-gram."""
        return self.kinds * ((1 << self.bits) + 1)

    def parts(self, values: pa.Array):
        """``buckets, offsets, n-grams per row`` for each kind."""
        body, offsets = flat(values)
        if self.fold:
            fold = np.arange(256, dtype=np.uint8)
            fold[65:91] += 32
            body = fold[body]
        for size in self.sizes:
            yield byte_grams(body, offsets, size, self.bits), offsets, np.maximum(np.diff(offsets) - size + 1, 0)
        if self.words:
            found, counts = word_grams(body, offsets, self.bits)
            yield found, counts, np.diff(counts)

    def scores(self, values: pa.Array, weights: np.ndarray) -> np.ndarray:
        """Rows times models: inner products of the features with rows of ``weights``."""
        out = np.zeros((len(values), len(weights)))
        step = (1 << self.bits) + 1
        for kind, (found, offsets, total) in enumerate(self.parts(values)):
            share = self.SCALE / np.maximum(total, 1)
            for model, row in enumerate(weights):
                own = row[kind * step : (kind + 1) * step]
                out[:, model] += row_sums(own[found], offsets) * share
        return out

    def rows(self, values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Indices and values of the features of each row, for training."""
        return [row for at in range(0, len(values), 64) for row in self._some_rows(values[at : at + 64])]

    def _some_rows(self, values: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        step = (1 << self.bits) + 1
        kinds = [(k * step, *p) for k, p in enumerate(self.parts(values))]
        out = []
        for i in range(len(values)):
            index, value = [], []
            for base, found, offsets, total in kinds:
                own = found[offsets[i] : offsets[i + 1]]
                seen, count = np.unique(own[own < 1 << self.bits], return_counts=True)
                index.append(seen.astype(np.int32) + np.int32(base))
                value.append((count * (self.SCALE / max(int(total[i]), 1))).astype(np.float32))
            out.append((np.concatenate(index), np.concatenate(value)))
        return out
