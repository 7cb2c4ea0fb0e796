"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents are lower-cased (A-Z only) and cut into words: runs of digits, letters a-z and anything beyond
ASCII. The automaton holds every run of words of every item; a document's words stream through it once, and the state
gives the longest item substring that ends at each word. Where that reaches ``window`` words, the last ``window`` words
are hit; an item of fewer words is one window of its own and is found through the suffix links. A document is
contaminated when it has hits and they cover at least ``coverage`` of its words: ``clean_documents`` drops those,
``remove_spans`` keeps all documents and takes the hit spans out of their texts.

The automaton is broadcast. Its size is bounded: a benchmark of more than ``block_words`` words is dealt into blocks of
items, each with its own automaton and pass over the documents, and the hits are joined afterwards.

Defined results: null and empty texts have no words and no hits; items without words have no window; items with a null
id mark words but are not listed; repeated items count once by id; repeated documents are judged one by one; extra
columns are kept by ``clean_documents``; empty tables give no hits or an empty result. Memory per task: the automaton
and the longest text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import absent, flat, row_key, steps, stored, text_or_empty, without_rows

WINDOW, COVERAGE = 13, 20           # words; hits times COVERAGE reach the words of a document
BLOCK_WORDS = 500_000

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int]] = []                      # (state of an item's prefix, item)
        whole: list[tuple[int, int, int]] = []                # (state, words, item) of short items
        self.ids = [i for i, _ in items]
        for k, (_, tokens) in enumerate(items):
            at = 0
            for token in tokens:
                at = self._extend(at, token)
                ends.append((at, k))
            if 0 < len(tokens) < window:
                whole.append((at, len(tokens), k))
        self._find_items(ends, whole)

    def _extend(self, last: int, token: bytes) -> int:
        have = self.next[last].get(token)
        if have is not None:
            return have if self.length[have] == self.length[last] + 1 else self._clone(last, have, token)
        state = self._state({}, self.length[last] + 1, 0)
        at = last
        while at != -1 and token not in self.next[at]:
            self.next[at][token] = state
            at = self.link[at]
        if at != -1:
            to = self.next[at][token]
            self.link[state] = to if self.length[to] == self.length[at] + 1 else self._clone(at, to, token)
        return state

    def _state(self, edges: dict[bytes, int], length: int, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, at: int, to: int, token: bytes) -> int:
        copy = self._state(dict(self.next[to]), self.length[at] + 1, self.link[to])
        self.link[to] = copy
        while at != -1 and self.next[at].get(token) == to:
            self.next[at][token] = copy
            at = self.link[at]
        return copy

    def _find_items(self, ends: list[tuple[int, int]], whole: list[tuple[int, int, int]]) -> None:
        """owners: the items in which the strings of a state occur, for the states that hold a string of ``window`` words.
        short: the short items that are suffixes of a state's strings, as (words, item)."""
        self.owners: dict[int, frozenset[int]] = {}
        seen: dict[int, set[int]] = {}
        for state, item in ends:
            while self.length[state] >= self.window:
                if self.length[self.link[state]] < self.window:
                    seen.setdefault(state, set()).add(item)
                state = self.link[state]
        self.owners = {s: frozenset(v) for s, v in seen.items()}
        direct: dict[int, list[tuple[int, int]]] = {}
        for state, size, item in whole:
            direct.setdefault(state, []).append((size, item))
        self.short: dict[int, tuple[tuple[int, int], ...]] = {}
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__) if direct else ():
            got = (*direct.get(state, ()), *self.short.get(self.link[state], ()))
            if got:
                self.short[state] = got

    def hits(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words inside occurrences of windows, in order of their ends, and the items they belong to."""
        following, link, length, window, short, owners = self.next, self.link, self.length, self.window, self.short, self.owners
        root = following[0]
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state, size = 0, 0
        for j, token in enumerate(tokens):
            to = following[state].get(token)
            if to is None:
                if not state:
                    continue
                while state and to is None:
                    state = link[state]
                    to = following[state].get(token) if state else root.get(token)
                if to is None:
                    size = 0
                    continue
                size = length[state] + 1
            else:
                size += 1
            state = to
            if size >= window:
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                items |= owners[at]
                spans.append((j + 1 - window, j + 1))
            if state in short:
                for words_in, item in short[state]:
                    if words_in <= size:
                        spans.append((j + 1 - words_in, j + 1))
                        items.add(item)
        return spans, items


def union_size(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, -1
    for a, b in sorted(spans):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _scan(automaton, with_key: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton.value
        for batch in steps(batches):
            raw, offsets = flat(batch.column("text"))
            data = raw.tobytes()
            total, spans, items = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                tokens = words(data[a:b])
                s, i = auto.hits(tokens) if tokens else ([], set())
                total.append(len(tokens))
                spans.append([{"start": x, "end": y} for x, y in s])
                items.append(sorted({auto.ids[k] for k in i if auto.ids[k] is not None}))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            out = [pa.array(total, pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))]
            if with_key:
                keep = np.array([len(s) > 0 for s in spans])
                rows = pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *out[1:]], ["k1", "k2", "spans", "items"])
                yield rows.filter(pa.array(keep))
            else:
                rest = [c for c in range(batch.num_columns) if batch.schema.names[c] != "text"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *out], [*(batch.schema.names[c] for c in rest), "n_words", "spans", "items"])

    return run


def _count_words(text: str) -> F.Column:
    return F.size(F.filter(F.split(F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != ""))


SPANS = "spans array<struct<start:long,end:long>>, items array<string>"


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """id, n_words, spans (hit words as [start, end), overlapping) and items (ids, sorted) of every document."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("string").alias("item_id"), text_or_empty("text").alias("text")).distinct()
    total = items.agg(F.sum(_count_words("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))

    def automaton(block: int):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()      # one block: about block_words words
        return spark.sparkContext.broadcast(Automaton([(r.item_id, words(r.text.encode())) for r in rows], window))

    text = text_or_empty(text_col).alias("text")
    kind = docs.schema[id_col].dataType.simpleString()
    if blocks == 1:
        return docs.select(F.col(id_col).alias("_id"), text).mapInArrow(_scan(automaton(0), False), f"_id {kind}, n_words long, {SPANS}").withColumnRenamed("_id", id_col)
    keyed = docs.select(*row_key(id_col, text_or_empty(text_col)), text)
    parts = [stored(keyed.mapInArrow(_scan(automaton(b), True), f"k1 long, k2 long, {SPANS}"), "items-block") for b in range(blocks)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    joined = every.groupBy("k1", "k2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    rows = docs.select(F.col(id_col), *row_key(id_col, text_or_empty(text_col)), _count_words(text_col).cast("long").alias("n_words"))
    return rows.join(joined, ["k1", "k2"], "left").select(id_col, "n_words", F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def covered_words(spans: str = "spans") -> F.Column:
    """Words in the union of the spans."""
    order = F.array_sort(F.col(spans))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("reach"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], acc["reach"]))).alias("n"), F.greatest(acc["reach"], s["end"]).alias("reach")
    )
    return F.aggregate(order, zero, step, lambda acc: acc["n"])


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * COVERAGE >= F.col("n_words"))


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The digest of ``contamination``: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, items, id_col, text_col, **options)
    return found.select(id_col, "n_words", covered_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn("contaminated", is_contaminated())


def _cut(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = []
            for text, spans, whole in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "whole")), strict=True):
                texts.append(without_spans(text, [(s["start"], s["end"]) for s in spans], 0 if whole else least))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(texts, pa.string())], ["k1", "k2", "cut"])

    return run


def without_spans(text: str, spans: list[tuple[int, int]], least: int) -> str:
    """``text`` without the words of the spans [start, end) and what stands between them. Spans that overlap or touch count
    as one; those of fewer than ``least`` words stay."""
    joined: list[list[int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_TABLE))]
    kept, at = [], 0
    for a, b in joined:
        if b - a >= least:
            kept.append(raw[at : places[a][0]])
            at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = WINDOW, **options) -> DataFrame:
    """``docs`` with hit spans taken out of their texts: spans of ``least_words`` words or more, and in contaminated documents
    all spans. Other texts, and all other columns, are left as they are."""
    names = [absent(docs, n) for n in ("_k1", "_k2", "_cut")]
    rows = docs.select(*row_key(id_col, text_or_empty(text_col)), text_or_empty(text_col).alias("text"))
    keyed = rows.select(F.struct("k1", "k2").alias("_key"), "text")
    found = contamination(keyed, items, "_key", "text", **options).where(F.size("spans") > 0).withColumn("n_hit", covered_words())
    hits = stored(found.select("_key.k1", "_key.k2", "spans", is_contaminated().alias("whole")).dropDuplicates(["k1", "k2"]), "hit-spans")
    texts = rows.join(hits, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).mapInArrow(_cut(least_words), "k1 long, k2 long, cut string")
    marked = docs.withColumns(dict(zip(names, row_key(id_col, text_or_empty(text_col)), strict=False)))
    out = marked.join(texts.toDF(*names), names[:2], "left")
    return out.select(*(F.coalesce(F.col(names[2]), F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones, all columns unchanged; other documents are left as they are."""
    text = docs.select(F.struct(*row_key(id_col, text_or_empty(text_col))).alias("_key"), text_or_empty(text_col).alias("text"))
    found = contamination(text, items, "_key", "text", **options).withColumn("n_hit", covered_words())
    gone = stored(found.where(is_contaminated()).select("_key.k1", "_key.k2").distinct(), "contaminated")
    return without_rows(docs, gone, id_col, text_col)
