"""Suffix-array dedup over bytes with longest-previous-factor arrays.

The anchor index (``repeats``) finds the stretches that can hold a repeated string. Blocks of them are put in suffix
order, compared to the depth of ``length`` bytes. For a suffix, the nearest entries before and after it in that order
that begin earlier in the block are the only candidates for its longest earlier match; the match reaches ``length``
when they agree to the full depth, and then the later copy goes. The mirrored array (longest next factor) marks the
copy that comes first as well, so that every byte of a string that also starts anywhere else is removed; the two masks
are kept apart in ``repeated_starts``.

Texts are UTF-8 bytes; matches never cross documents; overlapping matches count; strings are judged on the input.

Defined results: null text is empty; a text of fewer than ``length`` bytes keeps all; repeated rows are copies of each
other; null and repeated ids are fine; an empty table gives an empty result. Remaining bytes may cut a character, so
they are returned as binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwheel.llm.common import flat, steps
from cartwheel.llm.repeats import merged, spans_of, with_repeats
from cartwheel.llm.suffixes import rank_levels, ranks_at, with_separators

LENGTH, SEED = 200, 64
BLOCK_PHRASES = 300


def repeated_starts(symbols: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Masks over the block (with separators): a string of ``length`` starts here that starts earlier; that starts later."""
    keys, begins = with_separators(symbols, bounds)
    ranks = ranks_at(rank_levels(keys, length), length)
    order = np.argsort(ranks, kind="stable")                  # suffix order to that depth, ties by position
    tie = ranks[order[1:]] == ranks[order[:-1]]
    earlier = np.zeros(len(keys), dtype=bool)
    later = np.zeros(len(keys), dtype=bool)
    earlier[order[1:]] = tie                                  # in a tie the previous smaller position is the entry before,
    later[order[:-1]] = tie                                   # and the next larger one the entry after
    return earlier, later, begins


def resolve(symbols: np.ndarray, bounds: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    earlier, later, begins = repeated_starts(symbols, bounds, length)
    both = earlier | later
    out = []
    for b, size in zip(begins, np.diff(bounds), strict=True):
        out.append(spans_of(np.flatnonzero(both[b : b + size - length + 1]), length))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED, block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """(k1, k2, id, text, spans): spans of bytes that stand elsewhere in the corpus."""
    return with_repeats(docs, id_col, text_col, "byte", length, seed, resolve, block_phrases)


def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        raw, offsets = flat(batch.column("text"))
        sizes, removed, runs, kept = [], [], [], []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            own = raw[offsets[i] : offsets[i + 1]]
            gone = merged(spans, len(own))
            sizes.append(len(own))
            removed.append(int(gone.sum()))
            runs.append(int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=0) == 1)))
            kept.append(own[~gone].tobytes())
        rows = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, [batch.schema.names[0], "n_bytes", "n_removed", "n_spans", "kept_bytes"])


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in remaining(batches):
        sha = [hashlib.sha256(b).hexdigest() for b in batch.column("kept_bytes").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sha, pa.string())], [*batch.schema.names[:4], "kept_sha256"])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans and kept_bytes."""
    found = repeated_spans(docs, id_col, text_col, **options).select(id_col, "text", "spans")
    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(remaining, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_bytes binary")


def dedup_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``dedup_bytes`` with the hash of the remaining bytes in their place."""
    found = repeated_spans(docs, id_col, text_col, **options).select(id_col, "text", "spans")
    kind = found.schema[id_col].dataType.simpleString()
    return found.mapInArrow(digest, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
