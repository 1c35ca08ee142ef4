"""Suffix arrays by linear grouping construction.

Phase one sorts suffixes into groups of equal Lyndon prefix. Groups are processed
in descending order; each member's previous-smaller pointer names the suffix whose
Lyndon prefix it extends, and the suffixes named are split off to the upper end of
their own group. Phase two walks the array from the least suffix up and puts each
suffix found through the pointers at the front of its group, so that no group is
renamed and sorted again.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of ``text``, integers from 0; an empty list gives an empty list.

    Symbols up to a few times the length are put in order by counting; larger ones are numbered first.
    """
    if not text:
        return []
    if max(text) > 4 * len(text):
        rank = {c: i for i, c in enumerate(sorted(set(text)))}
        text = [rank[c] for c in text]
    s = [c + 1 for c in text]
    s.append(0)  # the unique least symbol
    n = len(s)
    order = [0] * n
    place = [0] * n  # where a suffix stands in order
    group = [0] * n  # first place of the suffix's group
    size = [0] * n  # by a group's first place
    first = [0] * (max(s) + 2)
    for c in s:
        first[c + 1] += 1
    for c in range(len(first) - 1):
        first[c + 1] += first[c]
    free = first[:]
    for p, c in enumerate(s):
        order[free[c]] = p
        place[p] = free[c]
        group[p] = first[c]
        free[c] += 1
        size[first[c]] += 1
    unknown = -2
    before = [unknown] * n

    end = n - 1
    while end >= 0:
        begin = group[order[end]]
        members = order[begin : end + 1]
        # A member that stands on another of its group waits for that one's pointer, so that the group needs no order.
        for p in members:
            waiting, q = [], p - 1
            if before[p] != unknown:
                continue
            while True:
                while q >= 0 and group[q] >= begin and before[q] != unknown:
                    q = before[q]
                if q >= 0 and group[q] >= begin:
                    waiting.append(p)
                    p, q = q, q - 1
                    continue
                before[p] = q
                if not waiting:
                    break
                p = waiting.pop()
        named = {}
        for p in members:
            q = before[p]
            if q >= 0:
                named[q] = named.get(q, 0) + 1
        if len(named) == 1:
            (q,) = named
            g = group[q]
            rest = size[g] - 1
            if rest:
                _to(order, place, q, g + rest)
                size[g] = rest
                group[q] = g + rest
                size[g + rest] = 1
        elif named:
            # A longer run of this group after a suffix makes it larger: the longest runs are split off first.
            # All runs together have no more members than the group, so that counting down is linear in it.
            by_run: dict[int, list[int]] = {}
            for q, run in named.items():
                by_run.setdefault(run, []).append(q)
            for run in range(max(by_run), 0, -1):
                moved = by_run.get(run, ())
                for q in moved:
                    g = group[q]
                    size[g] -= 1
                    _to(order, place, q, g + size[g])
                fresh = [group[q] + size[group[q]] for q in moved]
                for q, g in zip(moved, fresh):
                    group[q] = g
                    size[g] = 0
                for g in fresh:
                    size[g] += 1
        end = begin - 1

    free = list(range(n))  # next free place of each group, by its first place
    out = [-1] * n
    put = [False] * n
    out[0] = n - 1
    put[n - 1] = True
    for i in range(n):
        q = out[i] - 1
        while q >= 0 and not put[q]:
            g = group[q]
            out[free[g]] = q
            free[g] += 1
            put[q] = True
            q = before[q]
    return out[1:]


def _to(order: list[int], place: list[int], p: int, where: int) -> None:
    """Exchange p with what stands at ``where``."""
    here = place[p]
    other = order[where]
    order[here], order[where] = other, p
    place[other], place[p] = here, where


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """For each place, the common prefix with the suffix one place above (0 at the first)."""
    n = len(text)
    rank = [0] * n
    for i, p in enumerate(order):
        rank[p] = i
    out, h = [0] * n, 0
    for p in range(n):
        if rank[p]:
            q = order[rank[p] - 1]
            most = n - max(p, q)
            while h < most and text[p + h] == text[q + h]:
                h += 1
            out[rank[p]] = h
            h = h - 1 if h else 0
        else:
            h = 0
    return out
