"""Substring dedup by relative Lempel-Ziv parsing over words.

The reference that documents are parsed against is the whole corpus, cut into blocks: the phrases of the anchor
index (``repeats``), dealt out by anchor, so that a stretch of a document meets every block that can hold one of
its windows and no other. A phrase that stands elsewhere unchanged is a factor as it is. Of the others, each block
is parsed greedily: from the current word the longest match elsewhere in the block is the next factor. A factor of
``length`` words or more is a duplicate span; the windows that cross the end of a factor are looked up as well,
since a greedy factor can end inside a longer repeat.

A word is a run of anything but ASCII white space, taken unchanged. A window of ``length`` words that starts
anywhere else, the same document included, marks all its words; windows are judged on the input.

Defined results: null or empty text has no words; a text shorter than ``length`` keeps all; repeated rows (same id
and text) are copies of each other; null and repeated ids are fine; extra columns are ignored, or kept by
``dedup_substrings``; an empty table gives an empty result. Memory in a task is bounded by the longest text and by
``block_phrases`` phrases of one anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwheel.llm.common import flat, steps, words_flat
from cartwheel.llm.repeats import merged, with_repeats
from cartwheel.llm.suffixes import common_prefix, rank_levels, with_separators

LENGTH, SEED = 35, 15
#: Distinct phrases of one anchor that are compared in one block; beyond it windows are counted by hash, with the same result.
BLOCK_PHRASES = 300


def longest_matches(symbols: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix of the block, the length of its longest match elsewhere in it; and where each text begins.

    The longest match of a suffix is with a neighbour in suffix order.
    """
    keys, begins = with_separators(symbols, bounds)
    levels = rank_levels(keys, 2 * length)
    order = np.argsort(levels[-1], kind="stable")
    near = common_prefix(levels, order[:-1], order[1:])
    out = np.zeros(len(keys), dtype=np.int64)
    out[order[:-1]] = near
    out[order[1:]] = np.maximum(out[order[1:]], near)
    return out, begins


def parse(matches: list[int], length: int) -> list[tuple[int, int]]:
    """Duplicate spans of one text from its greedy factors, and from the windows across the factors' ends."""
    spans, at, n = [], 0, len(matches)
    while at < n:
        size = matches[at]
        end = at + max(size, 1)
        if size >= length:
            spans.append((at, end))
        # the first window across the factor's end that stands elsewhere begins the next factor
        at = next((s for s in range(max(at + 1, end - length + 1), min(end, n)) if matches[s] >= length), end)
    return spans


def resolve(symbols: np.ndarray, bounds: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    found, begins = longest_matches(symbols, bounds, length)
    return [parse(found[b : b + size].tolist(), length) for b, size in zip(begins, np.diff(bounds), strict=True)]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED, block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """(k1, k2, id, text, spans): spans of words that stand elsewhere in the corpus."""
    return with_repeats(docs, id_col, text_col, "word", length, seed, resolve, block_phrases)


def kept_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        raw, offsets = flat(batch.column("text"))
        starts, ends, bounds = words_flat(raw, offsets)
        data = raw.tobytes()
        total, removed, kept = [], [], []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            a, b = bounds[i], bounds[i + 1]
            gone = merged(spans, b - a)
            words = [data[s:e] for s, e, g in zip(starts[a:b].tolist(), ends[a:b].tolist(), gone.tolist(), strict=True) if not g]
            total.append(b - a)
            removed.append(int(gone.sum()))
            kept.append(b" ".join(words).decode())
        rows = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(rows, [batch.schema.names[0], "n_words", "n_removed", "kept_text"])


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in kept_words(batches):
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in batch.column("kept_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sha, pa.string())], [*batch.schema.names[:3], "kept_sha256"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_words, n_removed and kept_text, the words that are not repeated."""
    found = repeated_spans(docs, id_col, text_col, **options).select(id_col, "text", "spans")
    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(kept_words, f"`{id_col}` {kind}, n_words long, n_removed long, kept_text string")


def dedup_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``dedup_substrings`` with the hash of the kept text in its place."""
    found = repeated_spans(docs, id_col, text_col, **options).select(id_col, "text", "spans")
    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(digest, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string")
