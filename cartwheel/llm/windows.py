"""Vectorised kernels for repeated windows of symbols (words or bytes).

A *window* is ``length`` consecutive symbols of one document. Its *anchor* is
the smallest hash of the ``seed``-symbol strings inside it, so equal windows
have equal anchors wherever they stand. Neighbouring windows that share an
anchor form a *phrase*; a phrase is described by its first window, its number
of windows and the hash of all its symbols. About ``2 / (length - seed)`` of
the positions start a phrase, which is what makes an index over a whole corpus
affordable. No window is left out.

Everything works on one flat ``uint64`` array of symbol hashes for many
documents; windows never cross a document end.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)
#: Longest phrase in windows; longer runs (periodic text) are cut, which only sends them to the check of single windows.
MAX_RUN = 4096

WHITE = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept between calls."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[int(base)] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def prefix_hash(symbols: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Prefix sums of symbol * base**position; ``range_hash`` reads any range from them."""
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * powers(base, len(symbols)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice, base: np.uint64 = BASE) -> np.ndarray:
    """Hashes of the ranges [start, end) that depend on their symbols alone."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    scale = powers(inverse, len(prefix))
    return mix((prefix[end] - prefix[start]) * scale[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(values) - width + 1], out[width - have :])
    return out


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts and word ends, split at ASCII white space only."""
    raw = np.frombuffer(text, dtype=np.uint8)
    solid = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return raw, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_CODES = byte_codes(0x51)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of ``raw``."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    return range_hash(prefix_hash(_CODES[raw], BASE_2), starts, ends, BASE_2)


def phrases(symbols: np.ndarray, bounds: np.ndarray, length: int, seed: int) -> dict[str, np.ndarray]:
    """Phrases of the documents symbols[bounds[d]:bounds[d+1]].

    Columns: doc (index), start (symbol in the document), windows, anchor, phrase (hashes), again (1 if
    the anchor stands in the phrase more than once, so that the phrase may hold one window twice).
    """
    width = length - seed + 1
    n = len(symbols)
    if n < length:
        empty = np.zeros(0, dtype=np.int64)
        return {"doc": empty, "start": empty, "windows": empty, "anchor": empty, "phrase": empty, "again": empty}
    prefix = prefix_hash(symbols)
    seeds = range_hash(prefix, slice(0, n - seed + 1), slice(seed, n + 1))
    lowest = sliding_min(seeds, width)                       # one for each window start
    sizes = np.diff(bounds)
    valid = np.zeros(n + 1, dtype=np.int8)                    # +1/-1 at the ends of each document's window starts
    long = sizes >= length
    np.add.at(valid, bounds[:-1][long], 1)
    np.add.at(valid, bounds[1:][long] - length + 1, -1)
    valid = np.cumsum(valid, dtype=np.int8)[: len(lowest)].astype(bool)
    new = np.empty(len(lowest), dtype=bool)
    new[0] = True
    np.not_equal(lowest[1:], lowest[:-1], out=new[1:])
    new[bounds[:-1][bounds[:-1] < len(new)]] = True
    cut = np.flatnonzero(new | ~valid)
    cut = np.append(cut[valid[cut]], 0)[:-1]
    # the end of a run: the next start of a run or the end of the document's windows
    stop = np.flatnonzero(new | ~valid)
    stop = np.append(stop, len(new))
    end = stop[np.searchsorted(stop, cut, side="right")]
    run = end - cut
    if len(run) and run.max() > MAX_RUN:
        parts = -(-run // MAX_RUN)
        first = np.repeat(cut, parts)
        step = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
        last = np.repeat(end, parts)
        cut = first + step * MAX_RUN
        run = np.minimum(last - cut, MAX_RUN)
    doc = np.searchsorted(bounds, cut, side="right") - 1
    anchor = lowest[cut]
    again = run > width
    for at in range(0, len(cut), 1 << 13):                    # left-most anchor of the first window, right-most of the last
        few = slice(at, at + (1 << 13))
        left = (seeds[cut[few, None] + np.arange(width)] == anchor[few, None]).argmax(1)
        back = (seeds[(cut + run - 1)[few, None] + np.arange(width - 1, -1, -1)] == anchor[few, None]).argmax(1)
        again[few] |= cut[few] + left != cut[few] + run[few] - 1 + width - 1 - back
    return {
        "doc": doc,
        "start": cut - bounds[doc],
        "windows": run,
        "anchor": anchor.view(np.int64),
        "phrase": range_hash(prefix, cut, cut + run + length - 1).view(np.int64),
        "again": again.astype(np.int64),
    }
