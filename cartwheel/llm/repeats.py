"""Which stretches of documents stand elsewhere in the corpus: the index that both substring operators use.

1. Every document is cut into phrases (see ``windows``); the index rows go to the shared folder.
2. One pre-aggregated count by anchor drops the anchors that occur once. If all occurrences of an anchor are the
   same phrase, every window in them is repeated: done without looking at a text again.
3. The rest are anchors with different phrases, the borders of repeated stretches. Their distinct phrases, with
   their text, are dealt out by anchor, and ``resolve`` compares the phrases of whole anchors window by window.
4. Anchors with more than ``block_phrases`` distinct phrases (a very common line in ever new surroundings) would
   make one task too large. They are cut into runs of windows, which are compared by 128-bit hashes and narrowed down
   (``narrowed``). That spreads them over all tasks and gives the same result.

Equal windows have equal anchors, so no repeat is lost in any step, and there is no cap on copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import flat, row_key, steps, stored, text_or_empty, words_flat
from cartwheel.llm.windows import BASE_2, byte_codes, phrases, prefix_hash, range_hash, word_hashes

INDEX = "k1 long, k2 long, anchor long, phrase long, place long"
#: place = start * PLACE + windows * 2 + again; windows are at most 4096.
PLACE = 1 << 14
#: Windows in a run of ``narrowed``, from the first cut to the last.
WIDTHS = (64, 16, 4, 1)
_BYTES = byte_codes(0x77)


def symbols(raw: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbol hashes, the documents' bounds in them, and the first and last byte of each symbol."""
    if unit == "byte":
        at = np.arange(len(raw) + 1)
        return _BYTES[raw], offsets, at[:-1], at[1:]
    starts, ends, bounds = words_flat(raw, offsets)
    return word_hashes(raw, starts, ends), bounds, starts, ends


def index_rows(unit: str, length: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            raw, offsets = flat(batch.column("text"))
            syms, bounds, _, _ = symbols(raw, offsets, unit)
            got = phrases(syms, bounds, length, seed)
            k1, k2 = (np.asarray(batch.column(k))[got["doc"]] for k in ("k1", "k2"))
            place = got["start"] * PLACE + got["windows"] * 2 + got["again"]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k1, k2, got["anchor"], got["phrase"], place)], ["k1", "k2", "anchor", "phrase", "place"])

    return run


def phrase_texts(unit: str, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (k1, k2, text, wanted) to one row for each wanted phrase, with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            raw, offsets = flat(batch.column("text"))
            _, bounds, first, last = symbols(raw, offsets, unit)
            data = raw.tobytes()
            out: list[tuple] = []
            for i, (k1, k2, wanted) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "wanted")), strict=True)):
                for w in wanted:
                    a = bounds[i] + w["place"] // PLACE
                    b = a + w["place"] % PLACE // 2 + length - 2
                    out.append((k1, k2, w["anchor"], w["place"], w["copies"], w["large"], data[first[a] : last[b]]))
            for at in range(0, len(out), 4096):
                rows = list(zip(*out[at : at + 4096], strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds, strict=True)], ["k1", "k2", "anchor", "place", "copies", "large", "body"])

    return run


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged spans covered by the windows that begin at the (sorted) starts."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    first = np.append(starts[0], starts[gap + 1])
    last = np.append(starts[gap], starts[-1]) + length
    return list(zip(first.tolist(), last.tolist(), strict=True))


def resolved(unit: str, length: int, resolve: Callable, block_bytes: int = 1 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows arrive sorted by anchor; whole anchors are gathered into a block of about ``block_bytes``.

    ``resolve(symbols, bounds, length)`` gives one list of (start, end) spans per phrase of the block.
    """

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        raw, offsets = flat(block.column("body"))
        syms, bounds, _, _ = symbols(raw, offsets, unit)
        k1, k2, place, copies = (np.asarray(block.column(c)) for c in ("k1", "k2", "place", "copies"))
        out = []
        for i, spans in enumerate(resolve(syms, bounds, length)):
            if copies[i] == 1:                               # phrases with more copies are repeated as a whole
                out += [(k1[i], k2[i], place[i] // PLACE + a, place[i] // PLACE + b) for a, b in spans]
        got = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], ["k1", "k2", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, open_anchor = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchors = np.asarray(batch.column("anchor"))
            new = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
            at = 0
            for cut in [0, *new.tolist()]:
                if anchors[cut] == open_anchor:
                    continue
                if cut > at:
                    held.append(part := batch.slice(at, cut - at))
                    size += int(flat(part.column("body"))[1][-1])
                    at = cut
                open_anchor = anchors[cut]
                if size >= block_bytes:
                    yield solve(held)
                    held, size = [], 0
            held.append(part := batch.slice(at))
            size += int(flat(part.column("body"))[1][-1])
        if held:
            yield solve(held)

    return run


def cut_runs(unit: str, length: int, seed: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each run of neighbouring windows whose (left-most) anchor stands in the same ``width`` places.

    Equal windows hold the anchor at the same place, so they fall into runs of the same places. (h1, h2) is the hash of
    the symbols that all windows of such places share, whether the run has all of them or not; (u1, u2) that of the run.
    """
    names = ["h1", "h2", "u1", "u2", "k1", "k2", "anchor", "place", "copies", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "body", 1 << 18):
            raw, offsets = flat(batch.column("body"))
            syms, bounds, first_byte, last_byte = symbols(raw, offsets, unit)
            k1, k2, anchor, place, copies = (np.asarray(batch.column(c)) for c in ("k1", "k2", "anchor", "place", "copies"))
            one, two = prefix_hash(syms), prefix_hash(syms, BASE_2)
            seeds = range_hash(one, slice(0, len(syms) - seed + 1), slice(seed, len(syms) + 1)).view(np.int64)
            of = np.repeat(np.arange(len(place)), np.diff(bounds))[: len(seeds)]
            at = np.where(seeds == anchor[of], np.arange(len(seeds)), len(seeds))
            anchored = np.minimum.accumulate(at[::-1])[::-1]              # the next anchor from each symbol on
            count = place % PLACE // 2
            row = np.repeat(np.arange(len(count)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            window = bounds[:-1][row] + step
            group = (anchored[window] - window) // width
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1]) | (anchored[window[1:]] != anchored[window[:-1]])
            head = np.flatnonzero(new)
            size = np.diff(head, append=len(row))
            begin, end = window[head], window[head] + size - 1 + length
            core = anchored[begin] - group[head] * width
            core_end = core - width + 1 + length
            hashes = [range_hash(one, core, core_end), range_hash(two, core, core_end, BASE_2), range_hash(one, begin, end), range_hash(two, begin, end, BASE_2)]
            row = row[head]
            data = raw.tobytes()
            body = [data[a:b] if width > 1 else b"" for a, b in zip(first_byte[begin].tolist(), last_byte[end - 1].tolist(), strict=True)]
            cols = [*(h.view(np.int64) for h in hashes), k1[row], k2[row], anchor[row], (place[row] // PLACE + step[head]) * PLACE + size * 2, copies[row]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array(body, pa.binary())], names)

    return run


def narrowed(phrases_: DataFrame, unit: str, length: int, seed: int) -> DataFrame:
    """(k1, k2, start, end) of the repeated windows of phrases with very common anchors, without a row per window.

    Phrases are cut into runs of up to 64 windows, then 16, 4 and 1. A run that stands elsewhere as a whole is repeated;
    one whose shared symbols stand nowhere else holds no repeated window; only what neither settles is cut further.
    """
    core, whole = ["h1", "h2"], ["h1", "h2", "u1", "u2"]
    carried = ["k1", "k2", "anchor", "place", "body"]
    kinds = "h1 long, h2 long, u1 long, u2 long, k1 long, k2 long, anchor long, place long, copies long, body binary"
    open_, found = phrases_, []
    for width in [w for w in WIDTHS if w <= length - seed]:
        runs = stored(open_.mapInArrow(cut_runs(unit, length, seed, width), kinds), f"{unit}-runs")
        same = runs.groupBy(*whole).agg(F.count("*").alias("n"), F.first("copies").alias("copies"), *(F.first(c).alias(c) for c in carried))
        same = stored(same.withColumn("copies", F.when(F.col("n") > 1, F.col("n")).otherwise(F.col("copies"))), f"{unit}-run-kinds")
        found.append(runs.where("copies = 1").join(same.where("n > 1").select(whole), whole).select("k1", "k2", *_span(length)))
        if width > 1:
            unsettled = same.groupBy(*core).agg(F.count("*").alias("kinds"), F.min("copies").alias("fewest")).where("kinds > 1 and fewest = 1").select(core)
            open_ = same.join(stored(unsettled, f"{unit}-cores"), core).select(*carried, "copies")
    return reduce(DataFrame.unionByName, found)


def _span(length: int) -> list[Column]:
    return [F.expr(f"place div {PLACE}").alias("start"), F.expr(f"place div {PLACE} + place % {PLACE} div 2 + {length - 1}").alias("end")]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(*row_key(id_col, text), F.col(id_col), text.alias("text"))


def with_repeats(docs: DataFrame, id_col: str, text_col: str, unit: str, length: int, seed: int, resolve: Callable, block_phrases: int) -> DataFrame:
    """(k1, k2, id, text, spans) per document; spans are the repeated stretches in symbols, not yet merged."""
    rows = keyed(docs, id_col, text_col)
    index = stored(rows.select("k1", "k2", "text").mapInArrow(index_rows(unit, length, seed), INDEX), f"{unit}-index")
    # the counts are stored, so that the join below deals out both of its sides and a hot anchor can be split
    shared = stored(
        index.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("phrase").alias("least"), F.max("phrase").alias("most"), F.max(F.col("place") % 2).alias("again"))
        .where("n > 1 or again = 1")
        .select("anchor", F.expr("least <> most or again = 1").alias("mixed")),
        f"{unit}-anchors",
    )
    hits = stored(index.join(shared, "anchor"), f"{unit}-hits")
    span = _span(length)
    whole = hits.where("not mixed").select("k1", "k2", *span)
    mixed = hits.where("mixed")
    one = [F.first(c).alias(c) for c in ("k1", "k2", "place")]
    distinct = stored(mixed.groupBy("anchor", "phrase").agg(F.count("*").alias("copies"), *one), f"{unit}-phrases")
    copied = mixed.join(distinct.where("copies > 1").select("anchor", "phrase"), ["anchor", "phrase"]).select("k1", "k2", *span)
    groups = stored(distinct.groupBy("anchor").agg(F.count("*").alias("phrases"), F.min("copies").alias("fewest")).where("fewest = 1"), f"{unit}-groups")
    wanted = (
        distinct.join(groups, "anchor")
        .select("k1", "k2", F.struct("anchor", "place", "copies", F.expr(f"phrases > {block_phrases}").alias("large")).alias("w"))
        .groupBy("k1", "k2")
        .agg(F.collect_list("w").alias("wanted"))            # at most the phrases of one document
    )
    bodies = stored(
        rows.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "wanted").mapInArrow(phrase_texts(unit, length), "k1 long, k2 long, anchor long, place long, copies long, large boolean, body binary"),
        f"{unit}-borders",
    )
    found = "k1 long, k2 long, start long, end long"
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))   # much work on few bytes: not to be coalesced
    small = bodies.where("not large").repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(resolved(unit, length, resolve), found)
    counted = narrowed(bodies.where("large"), unit, length, seed)
    spans = (
        whole.unionByName(copied).unionByName(small).unionByName(counted)
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    return rows.join(spans, ["k1", "k2"], "left")


def merged(spans: list[dict] | None, size: int) -> np.ndarray:
    """Mask of the symbols covered by any span."""
    mark = np.zeros(size + 1, dtype=np.int64)
    if spans:
        np.add.at(mark, np.fromiter((s["start"] for s in spans), np.int64), 1)
        np.add.at(mark, np.fromiter((s["end"] for s in spans), np.int64), -1)
    return np.cumsum(mark)[:size] > 0
