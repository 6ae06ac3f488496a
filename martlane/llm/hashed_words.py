"""Words and word n-grams of many texts as 64-bit numbers, by numpy over whole runs of texts.

Words are maximal runs of bytes other than ASCII white space, with A-Z lower-cased.
A word's number is a polynomial in its bytes, found from prefix sums over the run,
and mixed; equal words have equal numbers, and two different ones share a number
with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from martlane.llm.common import kept_by_worker

RUN_BYTES = 400_000  # texts that are worked on together; small enough for the processor's cache
_BASE = 0x9E3779B97F4A7C15
# Odd multipliers of the words of an n-gram, by place.
_PLACES = [pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(16)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    held = kept_by_worker("powers", dict)
    if len(held.get("up", ())) < n:
        size = max(n, RUN_BYTES * 2)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            held[name] = np.multiply.accumulate(steps)
    return held["up"][:n], held["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base**place before each place; one longer than the data."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def runs(texts: Iterable[bytes], size: int = RUN_BYTES) -> Iterator[list[bytes]]:
    run: list[bytes] = []
    held = 0
    for text in texts:
        run.append(text)
        held += len(text)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def words(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words of the texts, and where each text's words begin (and the end)."""
    data = np.frombuffer(b"\n".join(run).lower() + b"\n", np.uint8)
    inside = ((data - np.uint8(9)) > 4) & (data != 32)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    sums = prefix_sums(data)
    _, down = powers(len(data))
    numbers = mixed((sums[ends] - sums[starts]) * down[starts])
    sizes = np.array([len(x) + 1 for x in run])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return numbers, np.searchsorted(starts, offsets)


def grams(numbers: np.ndarray, n: int) -> np.ndarray:
    """The numbers of all n-grams of a row of words (of fewer words: of all of them together)."""
    n = min(n, len(numbers))
    if not n:
        return numbers
    last = len(numbers) - n + 1
    total = np.full(last, n, np.uint64)
    for k in range(n):
        total = total + numbers[k : k + last] * np.uint64(_PLACES[k])
    return mixed(total)


def distinct(numbers: np.ndarray) -> np.ndarray:
    ordered = np.sort(numbers)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def shingle_sets(texts: Iterable[bytes], size: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles of so many words, sorted."""
    for run in runs(texts):
        numbers, cuts = words(run)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield distinct(grams(numbers[a:b], size))
