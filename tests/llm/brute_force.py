"""Brute-force results that several tests compare with."""

from itertools import combinations

import numpy as np


def components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} - {()}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near(sets, percent):
    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            yield a, b


def covered(texts):
    """Each document's bytes that an earlier one has too; by id."""
    first = {}
    for i in sorted(texts):
        b = texts[i]
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    out = {}
    for i, b in texts.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        out[i] = gone
    return out
