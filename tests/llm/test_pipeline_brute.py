"""Each stage of the corpus pipeline against a plain version of its rule, on its own input (whole tables, sf0.001)."""

import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from cartwheel.llm import packing, quality

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
WHITE = re.compile(r"[\x20\x09-\x0D]")
LOWER = {i: i + 32 for i in range(65, 91)}
STAGES = dict(corpus_pipeline.STAGES)


def good(spark, rows):
    """The documents whose score, from a model that is trained again on the same input, reaches the threshold."""
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    scores = quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    return {r.doc_id for r in scores if r.score >= 0.3}


def longest_of_equal(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[WHITE.sub("", r.text or "")].append((-len(r.text or ""), r.doc_id))
    return {min(g)[1] for g in groups.values()}


def lowest_of_near(rows):
    sets = {}
    for r in rows:
        w = (r.text or "").translate(LOWER).encode().split()
        sets[r.doc_id] = {tuple(w[i : i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d for d in ids if top(d) == d}


def uncontaminated(spark, rows):
    cut = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").translate(LOWER).encode())
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = cut(r.text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[n].add(tuple(w[i : i + n]))
    left = set()
    for r in rows:
        w, hit = cut(r.text), set()
        for n, known in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            left.add(r.doc_id)
    return left


def test_stages_against_plain_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    rules = {"quality": lambda r: good(spark, r), "exact_dedup": longest_of_equal, "near_dedup": lowest_of_near, "decontamination": lambda r: uncontaminated(spark, r)}
    for name, rule in rules.items():
        expected = rule(rows)
        before = {r.doc_id: r for r in rows}
        rows = STAGES[name](spark, spark.createDataFrame(rows, docs.schema), SF).collect()
        assert Counter(r.doc_id for r in rows) == Counter(expected), name
        assert all(r == before[r.doc_id] for r in rows), name
        assert len(rows) < len(before) or name == "decontamination", name

    encode = packing.encoder()
    pieces = STAGES["packing"](spark, spark.createDataFrame(rows, docs.schema), SF).collect()
    of = defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
    assert set(of) == {r.doc_id for r in rows}
    for r in rows:
        ids = np.append(np.frombuffer(encode.reference(r.text or ""), dtype="<u4"), 0).astype("<u4")
        mine = sorted(of[r.doc_id], key=lambda p: p.piece)
        assert [p.start for p in mine] == [0, *np.cumsum([p.length for p in mine])[:-1]] and sum(p.length for p in mine) == len(ids)
        assert all(p.length == 2048 for p in mine[1:]) and mine[0].length <= 2048 and (len(mine) == 1 or len(ids) > 2048)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in mine)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(p.length for p in pieces) // 2048)
    assert least <= len(sequences) <= 1.05 * least + 1
