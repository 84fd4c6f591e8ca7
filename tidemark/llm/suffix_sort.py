"""Suffix sorting by grouping, in linear time without recursion, for many strings
at once.

Phase one refines groups of suffixes by their Lyndon prefixes.  Groups are taken in
descending order; for every suffix of the group its previous smaller suffix (the
last position before it that lies in a lower group) is found along the pointers of
those done before, and the suffixes pointed to leave their group for new ones right
above it, those pointed to more often placed higher.  Phase two walks the suffixes
in their final order and puts each one's left neighbour, and along the same
pointers that one's previous smaller suffixes, to the next free place of their
groups.  Suffixes are never renamed and compared again.

The strings are independent, so each step takes the current group (phase one) or
suffix (phase two) of *every* string; the arrays of a step hold one entry or group
per string, and the number of steps is that of the longest one.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of several ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _group(text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase one: the group of every suffix (the first place of its group) and its
    previous smaller suffix (-1: none)."""
    n = len(text)
    lane = np.repeat(np.arange(len(lo)), hi - lo)
    order = np.lexsort((text, lane))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sorted_text, sorted_lane = text[order], lane[order]
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_text[1:] != sorted_text[:-1]) | (sorted_lane[1:] != sorted_lane[:-1])
    first = np.flatnonzero(fresh)
    size = np.zeros(n, np.int64)
    size[first] = np.diff(np.append(first, n))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, size[first])
    smaller = np.arange(-1, n - 1)
    smaller[lo] = -1
    marked = np.zeros(n, bool)
    top, base = hi.copy(), lo
    while True:
        open_ = top > base + 1
        if not open_.all():
            top, base = top[open_], base[open_]
        if not len(top):
            return group, smaller
        g = group[order[top - 1]]
        sizes = top - g
        members = order[_ranges(g, sizes)]
        own = np.repeat(g, sizes)
        at = smaller[members]
        chase = np.flatnonzero((at >= 0) & (group[at] >= own))
        while len(chase):
            at[chase] = smaller[at[chase]]
            chase = chase[(at[chase] >= 0) & (group[at[chase]] >= own[chase])]
        smaller[members] = at
        top = g
        at = at[at >= 0]
        if not len(at):
            continue
        at.sort()
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        heads = np.flatnonzero(new)
        hit, times = at[heads], np.diff(np.append(heads, len(at)))
        old = group[hit]
        by = np.lexsort((times, old))
        hit, times, old = hit[by], times[by], old[by]
        starts = np.ones(len(old), bool)
        starts[1:] = old[1:] != old[:-1]
        old_at = np.flatnonzero(starts)
        moved = np.diff(np.append(old_at, len(old)))
        stay = size[old[old_at]] - moved
        target = np.repeat(old[old_at] + stay - old_at, moved) + np.arange(len(old))
        limit = np.repeat(old[old_at] + stay, moved)
        was = place[hit]
        holder = order[target]
        marked[hit] = True
        out = holder[~marked[holder]]
        marked[hit] = False
        freed = was[was < limit]
        order[freed] = out
        place[out] = freed
        order[target] = hit
        place[hit] = target
        starts[1:] |= times[1:] != times[:-1]
        sub_at = np.flatnonzero(starts)
        sub_size = np.diff(np.append(sub_at, len(old)))
        size[old[old_at]] = stay
        size[target[sub_at]] = sub_size
        group[hit] = np.repeat(target[sub_at], sub_size)


def _emit(group: np.ndarray, smaller: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Phase two: the suffixes in order."""
    n = len(group)
    out = np.full(n, -1, np.int64)
    free = np.arange(n)
    done = np.zeros(n + 1, bool)
    done[n] = True  # stands for no suffix
    out[lo] = hi - 1
    done[hi - 1] = True
    smaller = np.append(np.where(smaller < 0, n, smaller), n)
    left = np.arange(-1, n)
    left[lo] = n
    i, j, end = lo.copy(), left[hi - 1], hi
    while len(i):
        go = ~done[j]
        put = j[go]
        g = group[put]
        slot = free[g]
        free[g] = slot + 1
        out[slot] = put
        done[put] = True
        j[go] = smaller[put]
        rest = np.flatnonzero(done[j])
        i[rest] += 1
        over = i[rest] >= end[rest]
        if over.any():
            keep = np.ones(len(i), bool)
            keep[rest[over]] = False
            nxt = rest[~over]
            j[nxt] = left[out[i[nxt]]]
            i, j, end = i[keep], j[keep], end[keep]
        else:
            j[rest] = left[out[i[rest]]]
    return out


def sort_suffixes(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix arrays of strings laid end to end; ``ends`` are where they end.  The
    last symbol of each string must be smaller than all its others.  Positions
    count from the start of ``text``; a string's suffixes take its places."""
    hi = np.asarray(ends, np.int64)
    lo = np.concatenate([[0], hi[:-1]]) if len(hi) else hi
    group, smaller = _group(np.asarray(text), lo, hi)
    return _emit(group, smaller, lo, hi)
