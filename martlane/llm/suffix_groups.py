"""Suffix array by linear grouping of Lyndon prefixes.

First suffixes are gathered by their longest Lyndon prefix. Groups are worked
through from the greatest down; the suffixes of a group find their nearest smaller
suffix to the left (everything greater is already done, so pointers skip it), and
the prefix of each suffix that is found grows by the group's prefix, as often as it
was found, which moves it to a new group just above its old one. Then the groups'
inner order is read off from the smallest suffix up: each suffix that is put in
place names those whose Lyndon prefix ends just before it as next of their groups.
Nothing is renamed and nothing is sorted but the symbols.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """The order of the suffixes; the symbol 0 ends a part.

    Suffixes are compared up to the end of their part; equal ones stand by no rule.
    Ends of parts come first. The last symbol must be 0.
    """
    n = len(text)
    members: list[list[int]] = []
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        by_symbol.setdefault(symbol, []).append(i)
    group = [0] * n
    length: list[int] = []
    above: list[int] = []
    below: list[int] = []
    for number, symbol in enumerate(sorted(by_symbol)):
        own = by_symbol[symbol]
        members.append(own)
        length.append(1)
        below.append(number - 1)
        above.append(number + 1)
        for i in own:
            group[i] = number
    ends = members[0]
    before = [-1] * n
    done = bytearray(n)
    now = len(members) - 1
    above[now] = -1
    while now > 0:
        own = [i for i in members[now] if group[i] == now]
        members[now] = own
        if own:
            for i in own:
                done[i] = 1
            found: dict[int, int] = {}
            for i in own:
                j = i - 1
                while j >= 0 and done[j]:
                    j = before[j]
                before[i] = j
                if j >= 0:
                    found[j] = found.get(j, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for j, times in found.items():
                if group[j]:
                    moves.setdefault((group[j], times), []).append(j)
            own_length = length[now]
            at, last = 0, -1
            for old, times in sorted(moves):
                if old != last:
                    at, last = old, old
                new = len(members)
                moved = moves[old, times]
                moved.sort()
                members.append(moved)
                length.append(length[old] + times * own_length)
                over = above[at]
                above.append(over)
                below.append(at)
                above[at] = new
                below[over] = new
                for j in moved:
                    group[j] = new
                at = new
        now = below[now]
    # Where each group's next suffix goes.
    place = [0] * len(members)
    size = len(ends)
    now = above[0]
    while now != -1:
        place[now] = size
        size += len(members[now])
        now = above[now]
    order = [0] * n
    order[: len(ends)] = ends
    for k in order:
        j = k - 1
        while j >= 0:
            own = group[j]
            if not own or j + length[own] != k:
                break
            order[place[own]] = j
            place[own] += 1
            j = before[j]
    return order
