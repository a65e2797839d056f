"""Hard negatives: for an anchor and each of its positives, the best rows of other labels whose score
lies in a window below the positive's.

Vectors become integers, so scores are exact. Equal vectors of one label are one candidate with its
smallest ids. A candidate gets one more coordinate, ``sqrt(M^2 - |x|^2)``, which makes a large inner
product a small distance. Candidates are dealt to the nearest of a bounded number of pivots, and each
block of them is a cover tree: centres of a level lie apart by that level's radius, every node knows
how far its rows reach, and that radius bounds the scores below it from both sides. A query goes down
level by level, leaves out nodes whose scores lie outside its windows or cannot be among its best,
and takes what is left best first; the rows of leaves are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.session import settled

SCALE = 256
LARGEST = 1 << 26  # components of larger size count as this, so that sums fit 64 bits
BLOCK = 4096  # candidates of a tree
QUERIES = 2048  # queries that meet a tree at once
PIVOTS = 1024  # at most
SAMPLE = 8192  # candidates from which pivots are taken, at most
BASE = 1.5  # from level to level the radius shrinks by this
LEAF = 64  # rows that are not divided any more
FEW = 24  # rows that are not worth a node
CHUNK = 1024  # rows of a leaf scored at once
LEAST, MOST = -(1 << 62), 1 << 62

TREE = (
    "tree long, place int, g long, label string, ids array<long>, v binary, "
    "nodes array<struct<node: int, parent: int, reach: double, first: int, end: int>>, "
    "centre array<double>, reach double, longest double"
)
FOUND = "q long, w int, score long, g long, ids array<long>"


# --- one cover tree ------------------------------------------------------------------------------


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that makes all lengths ``longest``."""
    squares = (x * x).sum(axis=1)
    return np.hstack([x, np.sqrt(np.maximum(longest * longest - squares, 0.0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


def _net(x: np.ndarray, centre: int, members: np.ndarray, radius: float) -> list[tuple[int, np.ndarray]]:
    """Centres among ``members``, more than ``radius`` apart and the node's own centre first, each with
    the rows that it is the first to cover."""
    near = _distances(x[[centre]], x[members])[0] <= radius
    near |= members == centre
    out, rest = [(centre, members[near])], members[~near]
    while len(rest):
        ahead = rest[:128]
        apart = _distances(x[ahead], x[ahead])
        taken = np.zeros(len(ahead), dtype=bool)
        chosen = []
        for k in range(len(ahead)):
            if not taken[k]:
                chosen.append(k)
                taken |= apart[k] <= radius
                taken[k] = True
        covers = _distances(x[ahead[chosen]], x[rest]) <= radius
        covers[np.arange(len(chosen)), chosen] = True
        owner = np.where(covers.any(axis=0), covers.argmax(axis=0), -1)
        # a centre belongs to itself, whatever rounding says
        owner[chosen] = np.arange(len(chosen))
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(chosen) + 1))
        out += [(int(ahead[c]), rest[order[cuts[i] : cuts[i + 1]]]) for i, c in enumerate(chosen)]
        rest = rest[owner < 0]
    return out


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, float, int, int]]]:
    """An order of the rows of ``x`` and the nodes, parents first: ``centre, parent, reach, first, end``.

    A node holds the rows ``first`` to ``end`` of the order, none farther than ``reach`` from its centre
    (a row number of ``x``). Nodes of less than ``FEW`` rows are not written: such rows of a parent are one
    leaf together, which has the parent's centre and its own reach.
    """
    order: list[np.ndarray] = []
    nodes: list[tuple[int, int, float, int, int]] = []
    start = int(_distances(x.mean(axis=0)[None, :], x)[0].argmin())
    # centre, rows, parent, radius of the level; None for the radius: not divided
    todo: list[tuple[int, np.ndarray, int, float | None]] = [(start, np.arange(len(x)), -1, float("inf"))]
    placed = 0
    while todo:
        centre, rows, parent, radius = todo.pop()
        reach = float(_distances(x[[centre]], x[rows])[0].max())
        me = len(nodes)
        nodes.append((centre, parent, reach, placed, placed + len(rows)))
        if radius is None or len(rows) <= LEAF or reach <= 1e-6:
            order.append(rows)
            placed += len(rows)
            continue
        parts, level = [(centre, rows)], min(radius, reach)
        while len(parts) == 1:
            level /= BASE
            parts = _net(x, centre, rows, level)
        loose = [r for _, r in parts if len(r) < FEW]
        if loose:
            todo.append((centre, np.concatenate(loose), me, None))
        todo += [(c, r, me, level) for c, r in parts if len(r) >= FEW]
    return np.concatenate(order), nodes


def _grow(block: pd.DataFrame) -> pd.DataFrame:
    """The stored form of a block's tree: its rows in order, nodes beside the first row they hold."""
    block = block.sort_values("g", kind="stable")
    x = _matrix(block["v"]).astype(np.float64)
    longest = float(np.sqrt((x * x).sum(axis=1).max()))
    lifted = _lifted(x, longest)
    order, nodes = cover_tree(lifted)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    listed: dict[int, list] = {}
    for k, (centre, parent, reach, first, end) in enumerate(nodes):
        listed.setdefault(int(place[centre]), []).append(
            {"node": k, "parent": parent, "reach": reach, "first": first, "end": end}
        )
    out = block.iloc[order][["tree", "g", "label", "ids", "v"]].reset_index(drop=True)
    out.insert(1, "place", np.arange(len(out), dtype=np.int32))
    out["nodes"] = [listed.get(k) for k in range(len(out))]
    root = lifted[nodes[0][0]]
    out["centre"] = [root.tolist() if k == 0 else None for k in range(len(out))]
    out["reach"], out["longest"] = nodes[0][2], longest
    return out


def _matrix(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype="<i4").reshape(len(packed), -1)


# --- search --------------------------------------------------------------------------------------


@dataclass
class _Best:
    """The best ``k`` rows found so far for every query and window: scores (``LEAST``: none), ids, places."""

    score: np.ndarray
    first: np.ndarray
    place: np.ndarray

    @classmethod
    def none(cls, queries: int, windows: int, k: int) -> _Best:
        shape = (queries, windows, k)
        return cls(np.full(shape, LEAST), np.full(shape, MOST), np.full(shape, -1))

    def merge(self, q: np.ndarray, w: int, score: np.ndarray, first: np.ndarray, place: np.ndarray) -> None:
        """Take in rows for window ``w`` of queries ``q`` (sorted, repeated)."""
        if not len(q):
            return
        k = self.score.shape[2]
        who = np.unique(q)
        allq = np.concatenate([np.repeat(who, k), q])
        s = np.concatenate([self.score[who, w].ravel(), score])
        f = np.concatenate([self.first[who, w].ravel(), first])
        p = np.concatenate([self.place[who, w].ravel(), place])
        order = np.lexsort((f, -s, allq))
        allq, s, f, p = allq[order], s[order], f[order], p[order]
        at = np.arange(len(allq)) - np.searchsorted(allq, allq)
        keep = at < k
        for mine, new in ((self.score, s), (self.first, f), (self.place, p)):
            mine[who, w] = new[keep].reshape(len(who), k)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of integer rows in a type in which their inner products are not rounded."""
    if not a.size or not b.size or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return a.astype(np.float64), b.astype(np.float64)
    return a.astype(np.int64), b.astype(np.int64)


@dataclass
class Tree:
    x: np.ndarray  # integer rows in the tree's order
    label: np.ndarray
    first: np.ndarray  # smallest id of each row
    nodes: list[tuple[int, int, float, int, int]]  # centre (place), parent, reach, first, end
    longest: float

    def levels(self) -> list[list[int]]:
        depth: list[int] = []
        for _, parent, *_ in self.nodes:
            depth.append(depth[parent] + 1 if parent >= 0 else 0)
        out: list[list[int]] = [[] for _ in range(max(depth) + 1)]
        for k, d in enumerate(depth):
            out[d].append(k)
        return out

    def search(
        self, queries: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int, same: bool
    ) -> _Best:
        """For every query and window the ``k`` rows of highest score between ``low`` and ``high``, not
        below ``floor``, of the query's label (``same``) or of others; ties by smallest id."""
        best = _Best.none(len(queries), low.shape[1], k)
        asked, known = _exact(queries, self.x)
        least = np.maximum(low, floor)
        fq = queries.astype(np.float64)
        both = self.longest**2 + (fq * fq).sum(axis=1)[:, None]
        slack = 1e-6 * (1.0 + both)
        n = len(self.nodes)
        upper, lower = np.empty((len(queries), n)), np.empty((len(queries), n))
        alive = np.zeros((len(queries), n), dtype=bool)
        parents = np.array([p for _, p, *_ in self.nodes])
        inner = set(parents.tolist())
        for level in self.levels():
            up = parents[level]
            open_ = alive[:, up] if up[0] >= 0 else np.ones((len(queries), 1), dtype=bool)
            ask = np.flatnonzero(open_.any(axis=1))
            use = np.flatnonzero(open_.any(axis=0))
            if not len(ask) or not len(use):
                break
            at = np.array(level)[use]
            centres = self.x[[self.nodes[i][0] for i in at]].astype(np.float64)
            reach = np.array([self.nodes[i][2] for i in at])[None, :]
            total = both[ask]
            far = np.sqrt(np.maximum(total - 2.0 * fq[ask] @ centres.T, 0.0))
            high_at = (total - np.maximum(far - reach, 0.0) ** 2) / 2 + slack[ask]
            low_at = (total - (far + reach) ** 2) / 2 - slack[ask]
            if up[0] >= 0:
                high_at = np.minimum(high_at, upper[np.ix_(ask, parents[at])])
                low_at = np.maximum(low_at, lower[np.ix_(ask, parents[at])])
            some = np.zeros(high_at.shape, dtype=bool)
            for w in range(low.shape[1]):
                some |= (high_at >= least[ask, w][:, None]) & (low_at <= high[ask, w][:, None]) & (low <= high)[ask, w][:, None]
            upper[np.ix_(ask, at)], lower[np.ix_(ask, at)] = high_at, low_at
            alive[np.ix_(ask, at)] = some & open_[np.ix_(ask, use)]
        leaves = np.array([i for i in range(n) if i not in inner])
        open_, bound, under = alive[:, leaves], upper[:, leaves], lower[:, leaves]
        order = np.argsort(np.where(open_, -bound, np.inf), axis=1, kind="stable")
        for turn in range(len(leaves)):
            pick = order[:, turn]
            rows = np.arange(len(queries))
            now = np.maximum(least, best.score[:, :, k - 1])
            wanted = (bound[rows, pick][:, None] >= now) & (under[rows, pick][:, None] <= high) & (low <= high)
            go = open_[rows, pick] & wanted.any(axis=1)
            if not open_[rows, pick].any():
                break
            for leaf in np.unique(pick[go]):
                who = np.flatnonzero(go & (pick == leaf))
                self._verify(best, asked[who], known, label[who], who, leaves[leaf], high[who], least[who], k, same)
        return best

    def _verify(self, best, asked, known, label, who, node, high, least, k, same) -> None:
        """Score all rows of a leaf for queries ``who``."""
        _, _, _, begin, end = self.nodes[node]
        for a in range(begin, end, CHUNK):
            rows = slice(a, min(a + CHUNK, end))
            score = asked @ known[rows].T
            score[(self.label[rows][None, :] == label[:, None]) != same] = LEAST
            for w in range(high.shape[1]):
                now = np.maximum(np.maximum(least[:, w], best.score[who, w, k - 1]), LEAST + 1)
                ok = (score >= now[:, None]) & (score <= high[:, w][:, None])
                if score.shape[1] > k and np.count_nonzero(ok) > 8 * k * len(who):
                    # with ties at the k-th place, so that ids decide
                    kth = np.partition(np.where(ok, score, LEAST), score.shape[1] - k, axis=1)[:, -k]
                    ok &= score >= kth[:, None]
                q, p = np.nonzero(ok)
                best.merge(who[q], w, score[q, p].astype(np.int64), self.first[a + p], a + p)


def _read_tree(rows: pd.DataFrame) -> tuple[Tree, pd.DataFrame]:
    rows = rows.sort_values("place").reset_index(drop=True)
    nodes = [
        (s["node"], (place, s["parent"], s["reach"], s["first"], s["end"]))
        for place, listed in enumerate(rows["nodes"]) if listed is not None for s in listed
    ]
    first = np.array([ids[0] for ids in rows["ids"]], dtype=np.int64)
    return Tree(_matrix(rows["v"]), rows["label"].to_numpy(), first, [n for _, n in sorted(nodes)], rows["longest"][0]), rows


def _padded(lists: pd.Series, value: int) -> np.ndarray:
    width = max(map(len, lists))
    out = np.full((len(lists), width), value, dtype=np.int64)
    for k, values in enumerate(lists):
        out[k, : len(values)] = values
    return out


def _meeting(k: int, same: bool):
    def meet(asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(rows):
            return pd.DataFrame({"q": [], "w": [], "score": [], "g": [], "ids": []})
        tree, rows = _read_tree(rows)
        # beyond its own windows a query has empty ones
        low, high, floor = _padded(asking["low"], 1), _padded(asking["high"], 0), _padded(asking["floor"], LEAST)
        codes, _ = pd.factorize(pd.concat([rows["label"], asking["label"]]))
        tree.label = codes[: len(rows)]
        best = tree.search(_matrix(asking["v"]), codes[len(rows) :], low, high, floor, k, same)
        q, w, at = np.nonzero(best.score > LEAST)
        place = best.place[q, w, at]
        return pd.DataFrame(
            {
                "q": asking["q"].to_numpy()[q], "w": w.astype(np.int32), "score": best.score[q, w, at],
                "g": rows["g"].to_numpy()[place], "ids": rows["ids"].to_numpy()[place],
            }
        )

    return meet


# --- in Spark ------------------------------------------------------------------------------------


def _whole(rows: DataFrame, column: str) -> DataFrame:
    """``vec_id, label, v`` (integers, all of one length) of the rows that take part."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    edge = float(LARGEST)
    whole = F.transform(x, lambda e: F.greatest(F.lit(-edge), F.least(F.lit(edge), F.floor(e * SCALE).cast("double"))).cast("int"))
    taken = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(column).isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("v"), bad.alias("bad")
    )
    return taken.where(~F.col("bad")).drop("bad")


def _candidates(rows: DataFrame, anchors: DataFrame, copies: int) -> DataFrame:
    """``g, label, v, ids, asked``: one row for each vector and label, with its ``copies`` smallest ids
    and whether it is some anchor's. Larger ids can never be among the first rows of any query."""
    order = Window.partitionBy("label", "v").orderBy("vec_id")
    few = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= copies)
    marks = anchors.select("label", "v", F.lit(None).cast("long").alias("vec_id"), F.lit(True).alias("asked")).distinct()
    both = few.select("label", "v", "vec_id", F.lit(False).alias("asked")).unionByName(marks)
    groups = both.groupBy("label", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.max("asked").alias("asked"))
    return settled(groups.select(F.monotonically_increasing_id().alias("g"), "label", "v", "ids", "asked"), "candidates")


def _pivots(groups: DataFrame, total: int) -> np.ndarray:
    """Up to ``PIVOTS`` candidates of a bounded sample, each as far as can be from those before."""
    hashed = F.pmod(F.xxhash64("g"), F.lit(1 << 20))
    near = groups if total <= SAMPLE else groups.where(hashed < int((1 << 20) * min(1.0, 2.0 * SAMPLE / total)))
    drawn = near.orderBy(F.xxhash64("g"), "g").limit(SAMPLE).select("v").collect()
    x = np.array([r.v for r in drawn], dtype=np.float64)
    lifted = _lifted(x, float(np.sqrt((x * x).sum(axis=1).max())))
    chosen = [0]
    gap = _distances(lifted[[0]], lifted)[0]
    while len(chosen) < min(PIVOTS, -(-total // BLOCK)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(lifted[[chosen[-1]]], lifted)[0])
    return x[chosen]


def _dealt(groups: DataFrame, total: int) -> DataFrame:
    """Candidates with packed vectors, the nearest pivot, their tree and, for queries, their block."""
    pivots = _pivots(groups, total)

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["v"].tolist(), dtype="<i4").reshape(len(frame), -1)
            frame["v"] = [row.tobytes() for row in x]
            frame["cell"] = _distances(x.astype(np.float64), pivots).argmin(axis=1) if len(frame) else []
            yield frame

    placed = settled(
        groups.mapInPandas(nearest, "g long, label string, v binary, ids array<long>, asked boolean, cell long"), "cells"
    )
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asks"))
    # one row for each of at most PIVOTS cells
    ahead = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = settled(sizes.withColumn("ahead", F.coalesce(F.sum("asks").over(ahead), F.lit(0))), "cell-sizes", PIVOTS)
    spot = F.pmod(F.xxhash64("g", F.lit(7)), F.greatest(F.col("asks"), F.lit(1)))
    return placed.join(sizes, "cell").select(
        "g", "label", "v", "ids", "asked", "cell",
        (F.col("cell") * (1 << 40) + F.pmod(F.xxhash64("g"), F.ceil(F.col("n") / BLOCK))).alias("tree"),
        F.floor((F.col("ahead") + spot) / QUERIES).alias("block"),
        (F.col("cell") * (1 << 40) + F.pmod(F.xxhash64("g", F.lit(8)), F.ceil(F.greatest(F.col("asks"), F.lit(1)) / QUERIES))).alias("home"),
    )


def _meet(asking: DataFrame, trees: DataFrame, pairs: DataFrame, k: int, same: bool) -> DataFrame:
    """Queries of a block meet the rows of a tree, for all ``pairs`` of ``block, tree``."""
    left = asking.join(pairs, "block").select("block", "tree", "q", "label", "v", "low", "high", "floor")
    right = trees.join(pairs, "tree").select(
        *(F.col(c).alias(c) for c in ("block", "tree", "place", "g", "label", "ids", "v", "nodes", "longest"))
    )
    return left.groupBy("block", "tree").cogroup(right.groupBy("block", "tree")).applyInPandas(_meeting(k, same), FOUND)


def _block_bounds(block: pd.DataFrame) -> pd.DataFrame:
    """What a block of queries has in common: a ball around all, their lengths, and the widest window."""
    x = _matrix(block["v"]).astype(np.float64)
    lengths = (x * x).sum(axis=1)
    middle = x.mean(axis=0)
    least = [max(a, b) for lo, hi, fl in zip(block["low"], block["high"], block["floor"], strict=True) for a, b, h in zip(lo, fl, hi, strict=True) if a <= h]
    most = [h for lo, hi in zip(block["low"], block["high"], strict=True) for a, h in zip(lo, hi, strict=True) if a <= h]
    return pd.DataFrame(
        {
            "block": [block["block"].iloc[0]], "middle": [[*middle.tolist(), 0.0]],
            "around": [float(np.sqrt(((x - middle) ** 2).sum(axis=1).max()))],
            "short": [float(lengths.min())], "long": [float(lengths.max())],
            "least": [float(min(least, default=MOST))], "most": [float(max(most, default=LEAST))],
        }
    )


def _open_pairs(asking: DataFrame, roots: DataFrame) -> DataFrame:
    """``block, tree`` where some row of the tree may be a result of some query of the block.

    One row for each block on both sides, whatever the number of rows."""
    blocks = settled(
        asking.groupBy("block").applyInPandas(
            _block_bounds, "block long, middle array<double>, around double, short double, long double, least double, most double"
        ),
        "blocks",
    )
    gap = F.sqrt(
        F.aggregate(F.zip_with("middle", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e)
    )
    wide = F.col("around") + F.col("reach")
    near, far = F.greatest(gap - wide, F.lit(0.0)), gap + wide
    square = F.col("longest") * F.col("longest")
    slack = F.lit(1e-6) * (F.lit(1.0) + square + F.col("long"))
    upper = (square + F.col("long") - near * near) / 2 + slack
    lower = (square + F.col("short") - far * far) / 2 - slack
    met = blocks.join(roots, (upper >= F.col("least")) & (lower <= F.col("most")), "inner")
    return settled(met.select("block", "tree"), "open-pairs")


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """``q, w, rows``: of the candidates found, the best ``k`` rows (``score, vec_id, own``), best first.

    A candidate's first id stands before its others, so the best ``k`` rows are among those of the best
    ``k`` candidates: no list is longer than ``k`` candidates."""
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), F.get("ids", F.lit(0)), "g")
    best = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    rows = F.transform(
        "ids",
        lambda i: F.struct((-F.col("score")).alias("back"), i.alias("vec_id"), (F.col("g") == F.col("q")).alias("own")),
    )
    listed = F.slice(F.array_sort(F.flatten(F.collect_list(rows))), 1, k)
    return best.groupBy("q", "w").agg(
        F.transform(listed, lambda r: F.struct((-r["back"]).alias("score"), r["vec_id"], r["own"])).alias("rows")
    )


def _search(asking: DataFrame, trees: DataFrame, roots: DataFrame, k: int, same: bool) -> DataFrame:
    """``q, w, rows`` for every query and window with results.

    A query first meets one tree of its own cell. The ``k``-th best score there is a floor under what it
    then asks of all trees whose bounds reach it.
    """
    home = roots.groupBy("cell").agg(F.min("tree").alias("tree"))
    start = asking.drop("block").withColumnRenamed("home", "block")
    pairs = settled(start.select("block", "cell").distinct().join(home, "cell").select("block", "tree"), "home-pairs")
    near = _best_rows(_meet(start, trees, pairs, k, same), k)
    floors = near.select("q", "w", F.get("rows", F.lit(k - 1))["score"].alias("least")).where("least IS NOT NULL")
    floors = floors.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("floors"))
    known = F.coalesce(F.col("floors"), F.create_map().cast("map<int, bigint>"))
    raised = F.transform("floor", lambda f, w: F.coalesce(F.try_element_at(known, w), f))
    asking = settled(asking.join(floors, "q", "left").withColumn("floor", raised).drop("floors"), "asking")
    return _best_rows(_meet(asking, trees, _open_pairs(asking, roots), k, same), k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    column: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``label`` and vectors; ``anchors`` are some of its rows. Components become
    ``floor(256 * x)``, those beyond ``LARGEST`` count as ``LARGEST``; a shorter vector counts as filled up
    with zeros. A row's score is its inner product with the anchor; higher scores come first, ties by smaller
    ``vec_id``. An anchor's positives are its first other rows of its label; for each, the first rows of other
    labels with a score from ``low`` to ``high`` percent of the positive's are returned.

    Rows without an id, label or vector, or with a component that is null or not finite, take no part. Repeated
    rows count each; a repeated anchor has its results once for each. A positive of negative score has no
    negatives. An empty table, or no anchors, gives no rows; other columns are not looked at.
    """
    rows, anchors = _whole(rows, column), _whole(anchors, column)
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    if dims is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    dims = max(dims, 1)
    filled = F.concat("v", F.array_repeat(F.lit(0), F.lit(dims) - F.size("v")))
    rows, anchors = rows.withColumn("v", filled), anchors.withColumn("v", filled)
    copies = max(positives + 1, negatives)
    groups = _candidates(rows, anchors, copies)
    placed = settled(_dealt(groups, groups.count()), "placed")
    trees = settled(placed.select("tree", "g", "label", "ids", "v").groupBy("tree").applyInPandas(_grow, TREE), "trees")
    roots = settled(
        trees.where("place = 0").select("tree", F.shiftright("tree", 40).alias("cell"), "centre", "reach", "longest"), "roots"
    )
    everything = {"low": LEAST, "high": MOST, "floor": LEAST}
    asking = placed.where("asked").select(
        F.col("g").alias("q"), "label", "v", "cell", "block", "home", *(F.array(F.lit(e)).alias(n) for n, e in everything.items())
    )
    found = _search(asking, trees, roots, positives + 1, True).select("q", F.col("rows").alias("positives"))
    scores = F.filter(F.array_distinct(F.transform("positives", lambda r: r["score"])), lambda p: p >= 0)
    found = settled(found.withColumn("scores", scores), "positives")

    def part(p: Column, percent: int, more: int) -> Column:
        """``percent`` of ``p``, with the hundreds apart so that large scores do not overflow."""
        hundred = F.lit(100)
        return F.call_function("div", p, hundred) * percent + F.call_function("div", (p % hundred) * percent + more, hundred)

    windows = asking.drop("low", "high", "floor").join(found.where(F.size("scores") > 0), "q").select(
        "q", "label", "v", "cell", "block", "home",
        F.transform("scores", lambda p: part(p, low, 99)).alias("low"),
        F.transform("scores", lambda p: part(p, high, 0)).alias("high"),
        F.transform("scores", lambda p: F.lit(LEAST)).alias("floor"),
    )
    hard = _search(settled(windows, "windows"), trees, roots, negatives, False)
    hard = hard.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "rows"))).alias("hard"))
    results = groups.where("asked").select(F.col("g").alias("q"), "label", "v").join(found, "q").join(hard, "q")
    results = settled(results.drop("q"), "results")

    own = F.transform("positives", lambda r: r["own"] & (r["vec_id"] == F.col("vec_id")))
    itself = F.array_position(own, F.lit(True))
    others = F.filter("positives", lambda r, k: k + 1 != F.col("itself"))
    each = (
        anchors.join(results, ["label", "v"])
        .withColumn("itself", itself)
        .select(F.col("vec_id").alias("anchor_id"), "scores", "hard", F.explode(F.slice(others, 1, positives)).alias("p"))
    )
    place = (F.array_position("scores", F.col("p.score")) - 1).cast("int")
    return each.select(
        "anchor_id", "p", F.posexplode(F.try_element_at("hard", place)).alias("at", "n")
    ).select(
        "anchor_id",
        F.col("p.vec_id").alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("n.vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
