"""Suffix arrays by linear grouping.

The suffixes of a text are grouped by their Lyndon prefix, the part before the next smaller suffix. Groups are made in
descending order: when a group is taken, no larger one can change any more, and each member's word is appended to the word
of the suffix its previous-smaller pointer names. Those suffixes leave their groups upwards, further the more copies they
got. Afterwards the groups stand in order, and suffixes fall into their places in one pass: the suffixes whose next smaller
suffix is the one just placed are the chain of previous-smaller pointers before it, and each takes the next free place of
its group. No step renames characters or recurses.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes of a sequence of small non-negative integers, in order. The end is smaller than any symbol."""
    n = len(text)
    if not n:
        return []
    group, order, place, size = _by_symbol(text)
    before = [-1] * n
    top = n
    while top:
        start = group[order[top - 1]]
        if top - start == 1:
            s = order[start]
            p = s - 1
            while p >= 0 and group[p] > start:
                p = before[p]
            before[s] = p
            if p >= 0:
                g = group[p]
                if size[g] > 1:
                    _lift([p], g, group, order, place, size)
        else:
            _append_words(order[start:top], start, group, order, place, size, before)
        top = start
    return _emit(n, group, before)


def _by_symbol(text: Sequence[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """First groups: suffixes by their first symbol."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    group, place, size = [0] * n, [0] * n, [0] * n
    start, last = 0, None
    for k, s in enumerate(order):
        if text[s] != last:
            start, last = k, text[s]
        group[s] = start
        place[s] = k
        size[start] += 1
    return group, order, place, size


def _append_words(members: list[int], start: int, group: list[int], order: list[int], place: list[int], size: list[int], before: list[int]) -> None:
    """Append the word of a group of several suffixes, in text order, to the words before it."""
    members.sort()
    got: dict[int, int] = {}
    for s in members:
        p = s - 1
        while p >= 0 and group[p] > start:
            p = before[p]
        if p >= 0 and group[p] == start:
            p = before[p]  # a neighbour with the same word has the same previous smaller suffix
        before[s] = p
        if p >= 0:
            got[p] = got.get(p, 0) + 1
    by_count: dict[int, list[int]] = {}
    for p, k in got.items():
        by_count.setdefault(k, []).append(p)
    for k in sorted(by_count, reverse=True):
        by_group: dict[int, list[int]] = {}
        for p in by_count[k]:
            by_group.setdefault(group[p], []).append(p)
        for g, which in by_group.items():
            if len(which) < size[g]:
                _lift(which, g, group, order, place, size)


def _lift(which: list[int], g: int, group: list[int], order: list[int], place: list[int], size: list[int]) -> None:
    """Make some members of group g a group of their own at its upper end."""
    end = g + size[g]
    for p in which:
        end -= 1
        other, at = order[end], place[p]
        order[at], place[other] = other, at
        order[end], place[p] = p, end
    size[g] = end - g
    size[end] = len(which)
    for p in which:
        group[p] = end


def _emit(n: int, group: list[int], before: list[int]) -> list[int]:
    """Fill the groups' places in ascending order."""
    out, free, done = [0] * n, list(range(n)), bytearray(n + 1)
    for k in range(-1, n):
        s = (n if k < 0 else out[k]) - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = before[s]
    return out
