"""Suffix arrays of many texts at once, by linear grouping.

First phase: suffixes are grouped by their first symbols, and the groups of a text are taken from
the highest to the lowest. The suffixes of a group look for the nearest suffix on their left that
is in a lower group (the previous smaller one). The suffixes so found move behind the rest of their
own group, by how often they were found: a suffix's group then tells its Lyndon prefix. Second
phase: the groups are emitted from the lowest up. Every emitted suffix gives the one on its left
the next place of its group, and so on along the previous smaller ones. No text is renamed or
sorted again. All texts take their steps together, so that a step is a handful of array operations.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def lyndon_groups(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group (first place of the group) and previous smaller suffix (-1: none) of every suffix.

    ``bounds`` are the begins of the texts and the end of the last. Each text's last symbol is its
    smallest and occurs once in it.
    """
    n = len(symbols)
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    array = np.argsort(owner * (int(symbols.max(initial=0)) + 1) + symbols, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[array] = np.arange(n)
    sorted_symbols = symbols[array]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (sorted_symbols[1:] != sorted_symbols[:-1]) | (owner[array][1:] != owner[array][:-1])
    heads = np.flatnonzero(fresh)
    size = np.zeros(n, dtype=np.int64)
    size[heads] = np.diff(np.append(heads, n))
    group = np.empty(n, dtype=np.int64)
    group[array] = np.repeat(heads, size[heads])
    before = np.full(n, -1, dtype=np.int64)
    begin, end = bounds[:-1].copy(), bounds[1:].copy()
    moved_mark = np.zeros(n, dtype=bool)
    live = np.flatnonzero(end - begin > 1)
    while len(live):
        head = group[array[end[live] - 1]]
        length = end[live] - head
        member = array[_ranges(head, length)]
        own = np.repeat(head, length)
        low = np.repeat(begin[live], length)
        end[live] = head
        live = live[head - begin[live] > 1]

        at = member - 1
        seek = np.flatnonzero(at >= low)
        at[at < low] = -1
        while len(seek):  # over suffixes in higher groups, along their own previous smaller ones
            seek = seek[group[at[seek]] > own[seek]]
            at[seek] = before[at[seek]]
            seek = seek[at[seek] >= 0]
        before[member] = at
        same = np.flatnonzero(at >= 0)
        same = same[group[at[same]] == own[same]]
        while len(same):  # a member of the same group has the same previous smaller one
            at[same] = before[at[same]]
            before[member[same]] = at[same]
            same = same[at[same] >= 0]
            same = same[group[at[same]] == own[same]]

        found = np.sort(at[at >= 0])
        if not len(found):
            continue
        first = np.flatnonzero(np.diff(found, prepend=-1))
        times = np.diff(np.append(first, len(found)))
        found = found[first]
        old = group[found]
        order = np.lexsort((times, old))
        found, times, old = found[order], times[order], old[order]
        lead = np.flatnonzero(np.diff(old, prepend=-1))
        count = np.diff(np.append(lead, len(old)))
        heads = old[lead]
        tail = heads + size[heads] - count
        target = _ranges(tail, count)
        moved_mark[found] = True
        occupant = array[target]
        displaced = occupant[~moved_mark[occupant]]
        spot = place[found]
        vacated = spot[spot < np.repeat(tail, count)]
        moved_mark[found] = False
        array[vacated] = displaced
        place[displaced] = vacated
        array[target] = found
        place[found] = target
        split = np.ones(len(found), dtype=bool)
        split[1:] = (old[1:] != old[:-1]) | (times[1:] != times[:-1])
        lead = np.flatnonzero(split)
        run = np.diff(np.append(lead, len(found)))
        size[heads] -= count
        size[target[lead]] = run
        group[found] = np.repeat(target[lead], run)
    return group, before


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix arrays of all texts in one array, each at the places of its text."""
    group, before = lyndon_groups(symbols, bounds)
    n = len(symbols)
    out = np.full(n, -1, dtype=np.int64)
    placed = np.zeros(n, dtype=bool)
    free = np.arange(n)  # next free place of a group, by its first place
    begin, end = bounds[:-1], bounds[1:]
    live = np.flatnonzero(end > begin)
    out[begin[live]] = end[live] - 1
    placed[end[live] - 1] = True
    free[begin[live]] += 1
    read = begin[live].copy()
    low, stop = begin[live], end[live]
    at = np.full(len(live), -1, dtype=np.int64)  # the suffix to place now; -1: read the next one
    while len(read):
        need = np.flatnonzero(at < 0)
        suffix = out[read[need]] - 1
        at[need] = np.where(suffix >= low[need], suffix, -1)
        read[need] += 1
        go = np.flatnonzero(at >= 0)
        go = go[~placed[at[go]]]
        now = at[go]
        slot = group[now]
        out[free[slot]] = now
        free[slot] += 1
        placed[now] = True
        rest = np.full(len(at), -1, dtype=np.int64)
        rest[go] = before[now]
        at = rest
        keep = (at >= 0) | (read < stop)
        if not keep.all():
            read, low, stop, at = read[keep], low[keep], stop[keep], at[keep]
    return out
