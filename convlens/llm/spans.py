"""Hashes of many short runs of characters at once, from the code points of whole texts."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Odd multiplier of the polynomial; arithmetic is modulo 2^64.
BASE = 0x9E3779B97F4A7C15


@cache
def powers(n: int) -> np.ndarray:
    """The first `n` powers of the base."""
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def codes(text: str) -> np.ndarray:
    """The code points of a text, in bytes where they all fit."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def sums(points: np.ndarray, starts: np.ndarray, stops: np.ndarray, longest: int) -> np.ndarray:
    """The polynomial of each run of code points; no run is empty or longer than `longest`."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    terms = (points[np.repeat(starts, sizes) + place].astype(np.uint64) + np.uint64(1)) * powers(longest)[place]
    return np.add.reduceat(terms, first)


def together(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """(first, behind) of consecutive groups of at most `limit` in all, or of one."""
    out, at, held = [], 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > limit:
            out.append((at, i))
            at, held = i, 0
        held += size
    return [*out, (at, len(sizes))] if sizes else out
