"""Suffix arrays by linear grouping of suffixes (Lyndon prefixes), for texts of small integers.

First phase: suffixes are grouped by what is known of their longest Lyndon
prefix, at first its first symbol.  Groups are taken in descending order.  A
suffix of the group taken is the next child of its previous smaller suffix, the
nearest one before it in a lower group, and so extends that one's Lyndon prefix:
parents leave their groups for new ones just above, those with more children
in the group taken above those with fewer.  Every suffix is taken once.

Second phase: a group's suffixes are in the order of the suffixes that follow
their Lyndon prefixes.  The array is filled from the left; each suffix read
places those that end where it begins, one after another, in their groups.
Nothing is renamed, and there is no recursion.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in their order; a suffix comes before those that it begins."""
    n = len(text)
    if not n:
        return []
    symbols = sorted(set(text))
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    below, above = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
    above[-1] = -1

    smaller = list(range(-1, n - 1))  # previous smaller suffix, of those taken; before that the place to look from
    taken = bytearray(n)
    g = len(symbols) - 1
    while g >= 0:
        own = members[g]
        if len(own) != size[g]:
            own = [i for i in own if group[i] == g]
        if size[g] > 1:
            own.sort()
        for i in own:
            taken[i] = 1
        parents = []
        for i in own:
            p = i - 1
            while p >= 0 and taken[p]:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                parents.append(p)
        while parents:  # once for each further child that a parent has in this group
            more, made, last = [], {}, -1
            for p in parents:
                if p == last:
                    more.append(p)
                    continue
                last = p
                low = group[p]
                new = made.get(low)
                if new is None:
                    if size[low] == 1:  # alone it keeps its place
                        continue
                    new = made[low] = len(members)
                    members.append([])
                    size.append(0)
                    up = above[low]
                    above.append(up)
                    below.append(low)
                    above[low] = below[up] = new
                group[p] = new
                members[new].append(p)
                size[low] -= 1
                size[new] += 1
            parents = more
        g = below[g]

    free, at, g = [0] * len(members), 0, 0
    while g >= 0:
        free[g] = at
        at += size[g]
        g = above[g]
    out = [0] * n
    i = n - 1  # what stands before the end of the text comes first
    while i >= 0:
        g = group[i]
        out[free[g]] = i
        free[g] += 1
        i = smaller[i]
    for j in out:
        i, stop = j - 1, smaller[j]
        while i > stop:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            i = smaller[i]
    return out


def equal_windows(text: bytes, starts: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For starts in suffix order: numbers of the classes of equal strings of ``length`` bytes.

    ``starts`` marks the places where such a string begins; equal ones stand
    side by side in ``order``.
    """
    places = order[starts[order]]
    same = np.ones(max(0, len(places) - 1), bool)
    padded = np.frombuffer(text + bytes(8), np.uint8)
    words = np.lib.stride_tricks.as_strided(padded, (len(text) + 1, 8), (1, 1)).copy().view("<u8")[:, 0]
    live = np.flatnonzero(same)
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])] if length >= 8 else []
    for step in steps or range(length):
        of = words if steps else padded
        live = live[of[places[live] + step] == of[places[live + 1] + step]]
    same[:] = False
    same[live] = True
    return places, np.cumsum(np.concatenate([[True], ~same])[:len(places)]) - 1
