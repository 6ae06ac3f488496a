"""Simple-8b coding of whole numbers: 64-bit words that hold as many as their widest allows.

The top four bits of a word select how many numbers of how many bits follow; an
escape word says that the next word is one plain 64-bit number. Numbers are coded
in stretches of fixed length, and the word at which each stretch begins is kept,
so any stretch can be decoded by itself and all of them side by side.
"""

from __future__ import annotations

import numpy as np

# (numbers in a word, bits of each) of the selectors in order.
LAYOUTS = [(60 // bits, bits) for bits in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)]
ESCAPE = 15
STRETCH = 1024
_COUNT = np.array([n for n, _ in LAYOUTS] + [0, 1], dtype=np.int64)


def encode(values: np.ndarray, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """The words, and the first word of each stretch."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # Each stretch is a row that ends in zeros, so a word's numbers may reach beyond it.
    rows, width = -(-n // stretch), stretch + 64
    whole = np.zeros(rows * stretch, np.uint64)
    whole[:n] = values
    padded = np.zeros((rows, width), np.uint64)
    padded[:, :stretch] = whole.reshape(rows, stretch)
    padded = padded.ravel()
    firsts = np.arange(rows) * width
    ends = np.repeat(firsts + np.minimum(stretch, n - np.arange(rows) * stretch), width)
    # The first selector that is wide enough for a number, then for all that a word would hold:
    # the first of these, so the fullest word, is taken.
    level = np.zeros(len(padded), np.uint8)
    top = int(values.max())
    for _, bits in LAYOUTS:
        if top >> bits:
            level += padded >> np.uint64(bits) != 0
    widest = {1: level}
    for step in (1, 2, 4, 8, 16):
        widest[2 * step] = np.maximum(widest[step][:-step], widest[step][step:])
    chosen = np.zeros(len(padded), np.uint8)
    inner = len(padded) - 64
    for selector, (count, bits) in enumerate(LAYOUTS):
        if not top >> bits:
            break
        step = 1 << (count.bit_length() - 1)
        most = widest[step][count - step :][:inner]
        chosen[:inner] += np.maximum(widest[step][:inner], most) > selector
    chosen[chosen == len(LAYOUTS)] = ESCAPE
    after = np.minimum(np.arange(len(padded)) + _COUNT[chosen], ends)
    # Words of all stretches at once: those found, and as many words on from each.
    starts, jump = firsts, after
    while True:
        found = jump[starts]
        found = found[found < ends[found]]
        if not len(found):
            break
        starts = np.concatenate([starts, found])
        jump = jump[jump]
    starts = np.sort(starts)
    selectors = chosen[starts]
    size = 1 + (selectors == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for selector in np.unique(selectors):
        own = selectors == selector
        first, to = starts[own], place[own]
        if selector == ESCAPE:
            words[to] = np.uint64(ESCAPE << 60)
            words[to + 1] = padded[first]
            continue
        count, bits = LAYOUTS[selector]
        word = np.full(len(first), int(selector) << 60, np.uint64)
        for k in range(count):
            word |= padded[first + k] << np.uint64(k * bits)
        words[to] = word
    return words, place[np.searchsorted(starts, firsts)]


def decode(words: np.ndarray, firsts: np.ndarray, n: int, stretch: int = STRETCH) -> np.ndarray:
    """The n numbers that the words hold."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selectors = (words >> np.uint64(60)).astype(np.int64)
    headers = np.ones(len(words), bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():
        if headers[at]:
            headers[at + 1] = False
    held = np.where(headers, _COUNT[selectors], 0)
    before = np.cumsum(held) - held
    own = np.searchsorted(firsts, np.arange(len(words)), side="right") - 1
    place = before - before[firsts][own] + own * stretch
    end = np.minimum((own + 1) * stretch, n)
    for selector in np.unique(selectors[headers]):
        at = np.flatnonzero(headers & (selectors == selector))
        if selector == ESCAPE:
            out[place[at]] = words[at + 1]
            continue
        count, bits = LAYOUTS[selector]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            to = place[at] + k
            inside = to < end[at]
            out[to[inside]] = (words[at[inside]] >> np.uint64(k * bits)) & mask
    return out
