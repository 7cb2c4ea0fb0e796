"""Suffix order of a block of short texts, by prefix doubling in numpy."""

from __future__ import annotations

import numpy as np


def dense_ranks(keys: np.ndarray) -> np.ndarray:
    """Ranks from 0 in the order of the keys; equal keys share one."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.empty(len(keys), dtype=np.int64)
    if len(keys):
        new[0] = 0
        np.cumsum(ranked[1:] != ranked[:-1], out=new[1:])
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = new
    return out


def deeper(ranks: np.ndarray, shift: int) -> np.ndarray:
    """Ranks of the suffixes by (rank, rank of the suffix ``shift`` symbols on); ends count as smallest."""
    then = np.zeros(len(ranks), dtype=np.int64)
    if shift < len(ranks):
        then[:-shift] = ranks[shift:] + 1
    return dense_ranks(ranks * (len(ranks) + 2) + then)


def rank_levels(first: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, ... symbols, up to the largest power of two that is at most ``depth``."""
    levels = [first]
    while 2 << (len(levels) - 1) <= depth:
        levels.append(deeper(levels[-1], 1 << (len(levels) - 1)))
    return levels


def ranks_at(levels: list[np.ndarray], depth: int) -> np.ndarray:
    """Ranks by the first ``depth`` symbols: two overlapping powers of two cover them."""
    power = 1 << (len(levels) - 1)
    return levels[-1] if power == depth else deeper(levels[-1], depth - power)


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes a and b (texts end in unlike separators, so it stays inside them)."""
    n = len(levels[0])
    got = np.zeros(len(a), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        for _ in range(2 if level == len(levels) - 1 else 1):
            x, y = a + got, b + got
            inside = (x < n) & (y < n)
            same = inside & (ranks[np.minimum(x, n - 1)] == ranks[np.minimum(y, n - 1)])
            got += same * (1 << level)
    return got


def with_separators(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the symbols with a separator of its own after each text, and where each text begins."""
    texts = len(bounds) - 1
    begins = bounds[:-1] + np.arange(texts)
    keys = np.empty(len(symbols) + texts, dtype=np.int64)
    place = np.arange(len(symbols)) + np.repeat(np.arange(texts), np.diff(bounds))
    keys[place] = dense_ranks(symbols) + texts
    keys[bounds[1:] + np.arange(texts)] = np.arange(texts)
    return keys, begins
