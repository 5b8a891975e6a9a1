"""Suffix array of a list of integers by grouping (linear-time, without renaming).

Phase 1 puts suffixes into groups by their Lyndon prefix. Groups start as first
symbols and are handled in descending order: every suffix of the group points to
the nearest earlier suffix in a lower group, and suffixes so pointed at leave
their group for a new one right above the rest of it, once per pointer, because
what follows their prefix is the largest that can follow. Phase 2 emits the order
inside the groups: suffixes are taken in order, and the one before each, with its
chain of previous-smaller pointers, is the next of its group.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)  # by group; inside a group any order
    place, first, size = [0] * n, [0] * n, [0] * (n + 1)
    begin = 0
    for i, s in enumerate(order):
        if i and text[s] != text[order[i - 1]]:
            begin = i
        place[s], first[s] = i, begin
        size[begin] += 1

    before = [-1] * n
    end = n
    while end > 0:
        begin = first[order[end - 1]]
        group = order[begin:end]
        if len(group) > 1:
            group.sort()
        pointed = []
        for s in group:
            p = s - 1
            while p >= 0 and first[p] >= begin:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed.append(p)
        end = begin
        # Once per pointer: out of the group, into a new one above what is left of it.
        while pointed:
            again, last = [], -1
            moved: dict[int, int] = {}
            for p in pointed:  # ascending, so equal ones are neighbours
                if p == last:
                    again.append(p)
                    continue
                last = p
                home = first[p]
                count = moved.get(home, 0) + 1
                moved[home] = count
                spot = home + size[home] - count
                here = place[p]
                if here != spot:
                    other = order[spot]
                    order[here], order[spot] = other, p
                    place[other], place[p] = here, spot
            for home, count in moved.items():
                start = home + size[home] - count
                if start != home:
                    size[home] -= count
                    size[start] = count
                    for i in range(start, start + count):
                        first[order[i]] = start
            pointed = again

    result, done = [0] * n, bytearray(n)
    free: dict[int, int] = {}
    s = n - 1  # the empty suffix comes first
    at = -1
    while True:
        while s >= 0 and not done[s]:
            group = first[s]
            spot = free.get(group, group)
            free[group] = spot + 1
            result[spot] = s
            done[s] = 1
            s = before[s]
        at += 1
        if at >= n:
            return result
        s = result[at] - 1
