"""The nearest of many centres, for blocks of rows at once.

Centres are dealt to leaders among them. A row measures its distance to all leaders; a leader's group is
looked at only by rows that lie no farther from the leader than their nearest so far and the group's reach
together. About the root of the number of centres is compared with every row, and of the others those nearby.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ROWS = 1024  # rows compared at once


class Centres:
    """Centres in groups, prepared once per task."""

    def __init__(self, ids: np.ndarray, centres: np.ndarray, cosine: bool):
        self.ids, self.cosine = ids, cosine
        self.x = centres
        self.length = np.linalg.norm(centres, axis=1)
        # centres without a direction are at cosine distance 1 from everything
        self.flat = ids[self.length == 0] if cosine else ids[:0]
        if cosine:
            keep = self.length > 0
            self.ids, self.x = ids[keep], centres[keep] / self.length[keep][:, None]
        self.squares = (self.x * self.x).sum(axis=1)
        self.leaders, self.groups = self._grouped()

    def _grouped(self) -> tuple[np.ndarray, list[tuple[np.ndarray, float]]]:
        n = len(self.ids)
        if not n:
            return np.zeros(0, dtype=np.int64), []
        chosen = [0]
        gap = self._measured(self.x, self.squares, self.x[[0]], self.squares[[0]])[:, 0]
        owner = np.zeros(n, dtype=np.int64)
        while len(chosen) < math.isqrt(n - 1) + 1 and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            more = self._measured(self.x, self.squares, self.x[[chosen[-1]]], self.squares[[chosen[-1]]])[:, 0]
            owner[more < gap] = len(chosen) - 1
            gap = np.minimum(gap, more)
        members = [np.flatnonzero(owner == k) for k in range(len(chosen))]
        return np.array(chosen), [(m, float(gap[m].max())) for m in members]

    @staticmethod
    def _measured(a, a2, b, b2) -> np.ndarray:
        return np.sqrt(np.maximum(a2[:, None] + b2[None, :] - 2.0 * a @ b.T, 0.0))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and distance of each row's nearest centre; -1 and infinity without any. Ties: smallest number."""
        out, far = np.full(len(rows), -1, dtype=np.int64), np.full(len(rows), np.inf)
        for a in range(0, len(rows), ROWS):
            part = slice(a, a + ROWS)
            out[part], far[part] = self._block(rows[part])
        return out, far

    def _block(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, far = np.full(len(rows), -1, dtype=np.int64), np.full(len(rows), np.inf)
        lengths = np.linalg.norm(rows, axis=1)
        use = np.flatnonzero(lengths > 0) if self.cosine else np.arange(len(rows))
        if len(self.ids) and len(use):
            x = rows[use] / lengths[use][:, None] if self.cosine else rows[use]
            squares = (x * x).sum(axis=1)
            # a hair more than rounding may cost: whoever may be nearest is measured exactly below
            hair = 1e-7 * (1.0 + np.sqrt(squares) + math.sqrt(float(self.squares.max())))
            lead = self._measured(x, squares, self.x[self.leaders], self.squares[self.leaders])
            best = lead.min(axis=1)
            seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for k in np.argsort(lead.min(axis=0)):
                members, reach = self.groups[k]
                near = np.flatnonzero(lead[:, k] - reach <= best + hair)
                if len(near):
                    d = self._measured(x[near], squares[near], self.x[members], self.squares[members])
                    best[near] = np.minimum(best[near], d.min(axis=1))
                    i, j = np.nonzero(d <= (best[near] + hair[near])[:, None])
                    seen.append((near[i], members[j], d[i, j]))
            row, centre, rough = (np.concatenate(c) for c in zip(*seen, strict=True))
            keep = rough <= best[row] + hair[row]
            row, centre = row[keep], centre[keep]
            if self.cosine:
                exact = 1.0 - (x[row] * self.x[centre]).sum(axis=1)
            else:
                exact = np.sqrt(((x[row] - self.x[centre]) ** 2).sum(axis=1))
            order = np.lexsort((self.ids[centre], exact, row))
            row, centre, exact = row[order], centre[order], exact[order]
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[use[row[first]]], far[use[row[first]]] = self.ids[centre[first]], exact[first]
        if self.cosine:
            # rows without a direction are at distance 1 from every centre
            every = np.concatenate([self.ids, self.flat])
            if len(every):
                blank = lengths == 0
                out[blank], far[blank] = every.min(), 1.0
            if len(self.flat):
                flat = (far > 1.0) | ((far == 1.0) & (self.flat.min() < out))
                out[flat], far[flat] = self.flat.min(), 1.0
        return out, far


NEAREST = "topic int, distance double"


def nearest_of(ids: list[int], centres: list[list[float]], cosine: bool) -> Callable[[Column], Column]:
    """A column function: array -> ``(topic, distance)`` of the nearest centre; nulls for null arrays."""
    table = np.array(centres, dtype=np.float64).reshape(len(ids), -1)
    numbers = np.array(ids, dtype=np.int64)

    @F.pandas_udf(NEAREST)
    def nearest(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ready = Centres(numbers, table, cosine)
        for column in columns:
            here = column.notna().to_numpy()
            topic, distance = pd.array([pd.NA] * len(column), dtype="Int32"), np.full(len(column), np.nan)
            if here.any() and len(numbers):
                topic[here], distance[here] = ready.nearest(np.stack(column[here].to_numpy()).astype(np.float64))
            yield pd.DataFrame({"topic": topic, "distance": distance})

    return nearest
