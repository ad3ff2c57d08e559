"""Suffix arrays of many short texts at once, by linear grouping.

Each text's suffixes are grouped by their longest prefix that is a Lyndon word (Baier, 2016). First all suffixes with the
same first letter are a group. Groups are taken from the highest to the lowest: each member points to the nearest suffix
on its left in a lower group (its previous smaller one), skipping what has been done along earlier pointers, and the
suffixes pointed to move to the high end of their own groups, by how many members point to them, as new groups. Then the
groups hold their final prefixes, and one pass over the order emits each group's members: a suffix goes to the first free
place of its group when the suffix behind its Lyndon word is emitted. No rank is ever renamed by recursion.

The texts are independent, so numpy takes one group of every text (in the second pass, one place) at a time: the number
of steps is that of the text with most groups, not the number of texts.
"""

from __future__ import annotations

import numpy as np


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges start, ..., start + count - 1, one after the other."""
    if not len(starts):
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(before[-1] + counts[-1]))


def lyndon_groups(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First pass: of each suffix, the place where its group begins and the length of its Lyndon prefix."""
    n, lengths = len(codes), np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    low = offsets[:-1][text]
    sa = np.argsort(text * 512 + codes, kind="stable") if n else np.empty(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = (codes[sa][1:] != codes[sa][:-1]) | (text[sa][1:] != text[sa][:-1])
    first = np.flatnonzero(new)
    size = np.zeros(n, np.int64)
    size[first] = np.diff(np.append(first, n))
    group, place = np.empty(n, np.int64), np.empty(n, np.int64)
    group[sa] = np.repeat(first, size[first])
    place[sa] = np.arange(n)
    length, previous, marked = np.ones(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, bool)
    end = offsets[1:].copy()
    active = np.flatnonzero(lengths)
    while len(active):
        start = group[sa[end[active] - 1]]
        count = end[active] - start
        members, own = sa[ragged(start, count)], np.repeat(start, count)
        p = members - 1
        p[p < low[members]] = -1
        previous[members] = p
        todo = np.flatnonzero(p >= 0)
        todo = todo[group[p[todo]] >= own[todo]]
        while len(todo):
            p[todo] = previous[p[todo]]
            previous[members[todo]] = p[todo]
            todo = todo[p[todo] >= 0]
            todo = todo[group[p[todo]] >= own[todo]]
        pointed = np.flatnonzero(p >= 0)
        if len(pointed):
            order = np.argsort(p[pointed], kind="stable")
            target = p[pointed[order]]
            head = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
            u, k = target[head], np.diff(np.append(head, len(target)))
            add = k * length[members[pointed[order[head]]]]
            home = group[u]
            order = np.lexsort((k, home))
            u, k, home, add = u[order], k[order], home[order], add[order]
            run = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1])))
            moved = np.diff(np.append(run, len(u)))
            border = np.repeat(home[run] + size[home[run]] - moved, moved)
            slot = border + np.arange(len(u)) - np.repeat(run, moved)
            marked[u] = True
            there = sa[slot]
            there = there[~marked[there]]
            free = place[u]
            free = free[free < border]
            sa[free], place[there] = there, free
            sa[slot], place[u] = u, slot
            marked[u] = False
            size[home[run]] -= moved
            part = np.flatnonzero(np.concatenate(([True], (home[1:] != home[:-1]) | (k[1:] != k[:-1]))))
            parts = np.diff(np.append(part, len(u)))
            group[u] = np.repeat(slot[part], parts)
            size[slot[part]] = parts
            length[u] += add
        end[active] = start
        active = active[start > offsets[:-1][active]]
    return group, length


def suffix_arrays(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's places in the order of their suffixes, text after text; ``codes`` are numbers below 512.

    A text's end is smaller than every code. An empty text has no place.
    """
    codes, offsets = codes.astype(np.int64), offsets.astype(np.int64)
    n, lengths = len(codes), np.diff(offsets)
    group, length = lyndon_groups(codes, offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    behind = np.arange(n) + length + text  # every text has one place more, for its end
    order = np.argsort(behind, kind="stable")
    count = np.bincount(behind, minlength=n + len(lengths) + 1)
    start = np.cumsum(count) - count
    out, free = np.empty(n, np.int64), np.arange(n)

    def emit(at: np.ndarray) -> None:
        p = order[ragged(start[at], count[at])]
        g = group[p]
        out[free[g]] = p
        free[g] += 1

    by_length = np.argsort(-lengths, kind="stable")
    begins, sizes = offsets[:-1][by_length], lengths[by_length]
    emit((offsets[1:][by_length] + by_length)[sizes > 0])
    left = len(sizes)
    for r in range(int(sizes[0]) if len(sizes) else 0):
        while left and sizes[left - 1] <= r:
            left -= 1
        emit(out[begins[:left] + r] + by_length[:left])
    return out
