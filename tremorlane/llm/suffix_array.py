"""Suffix arrays by linear grouping of Lyndon prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray) -> list[int]:
    """Starts of all suffixes in ascending order; the last code must be the unique least one.

    First the suffixes are grouped by the longest Lyndon word they begin with.
    Groups start out by first code and are taken in descending order. For each
    suffix of a group, the pointer to the previous suffix of a lower group is
    found by following the pointers already set. The suffixes so pointed at
    continue with this group's word, those pointed at more often with more
    copies of it, and move in this order to new groups right behind the rest
    of their own. Then the order is read off from the front: the suffix before
    each one, and those its pointers lead to, take the next free places of
    their groups. No group is ever renamed or sorted by recursion.
    """
    total = len(codes)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[heads, total])
    head_of = np.empty(total, np.int64)
    head_of[order] = np.repeat(heads, sizes)
    places = np.empty(total, np.int64)
    places[order] = np.arange(total)
    slots, group, place = order.tolist(), head_of.tolist(), places.tolist()
    size = [0] * total
    for head, count in zip(heads.tolist(), sizes.tolist(), strict=True):
        size[head] = count
    lower = [-1] * total

    end = total
    while end:
        head = group[slots[end - 1]]
        if end - head == 1:
            suffix = slots[head]
            at = suffix - 1
            while at >= 0 and group[at] >= head:
                at = lower[at]
            lower[suffix] = at
            if at >= 0:
                own = group[at]
                count = size[own] - 1
                if count:  # alone behind the rest of its group
                    last, mine = own + count, place[at]
                    other = slots[last]
                    slots[mine], place[other] = other, mine
                    slots[last], place[at] = at, last
                    size[own], size[last], group[at] = count, 1, last
        else:
            pointed: dict[int, int] = {}
            for suffix in sorted(slots[head:end]):
                at = suffix - 1
                while at >= 0 and group[at] >= head:
                    at = lower[at]
                lower[suffix] = at
                if at >= 0:
                    pointed[at] = pointed.get(at, 0) + 1
            if pointed:
                by_count: dict[int, list[int]] = {}
                for at, count in pointed.items():
                    by_count.setdefault(count, []).append(at)
                for count in sorted(by_count, reverse=True):
                    _move(by_count[count], slots, group, place, size)
        end = head

    free = list(range(total))
    ordered = [-1] * total
    ordered[0] = total - 1
    placed = bytearray(total)
    placed[total - 1] = 1
    free[group[total - 1]] += 1
    for i in range(total):
        at = ordered[i] - 1
        while at >= 0 and not placed[at]:
            own = group[at]
            ordered[free[own]] = at
            free[own] += 1
            placed[at] = 1
            at = lower[at]
    return ordered


def _move(chosen: list[int], slots, group, place, size) -> None:
    """Put the chosen suffixes of each group into a new group behind the rest of it."""
    moved: dict[int, int] = {}
    for at in chosen:
        own = group[at]
        size[own] -= 1
        last, mine = own + size[own], place[at]
        other = slots[last]
        slots[mine], place[other] = other, mine
        slots[last], place[at] = at, last
        moved[own] = moved.get(own, 0) + 1
    for own, count in moved.items():
        if size[own]:
            size[own + size[own]] = count
        else:
            size[own] = count
            moved[own] = 0  # all of a group: it stays
    for at in chosen:
        own = group[at]
        if moved[own]:
            group[at] = own + size[own]
