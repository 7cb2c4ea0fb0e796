"""Packing: tokens against the tokenizer, placement against its rules and a lower bound."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from cartwheel.llm import packing

WEIRD = [" ", "\n", "\t", "a", "The", "é", "1", ".", "'s", "\x1c", "中", "  ", "\r\n", "\x85", "​", "%%%", "²", "'LL", "<|endoftext|>", "\x00", "😀"]


def reference_ids(text):
    ids = np.frombuffer(packing.encoder().reference(text or ""), dtype="<u4")
    return [*ids.tolist(), 0]


def test_ids_are_the_tokenizers():
    rnd = random.Random(2)
    encode = packing.encoder()
    for _ in range(4000):
        text = "".join(rnd.choice(WEIRD) for _ in range(rnd.randint(0, 9)))
        assert encode(text) == encode.reference(text), repr(text)


def test_sum_of_squares_rule():
    # after 6 and 6 (gaps 4, 4) a 4 closes one gap; a 2 goes where the counts stay least
    sequence, offset = packing.sum_of_squares(np.array([6, 6, 4, 2]), 10)
    assert sequence.tolist() == [0, 1, 1, 0] or sequence.tolist() == [0, 1, 0, 1]
    assert offset[2] == 6 and offset[3] == 6


def brute(lengths, capacity):
    """The rule, written plainly: try every open gap and a new sequence."""
    gaps, made = Counter(), 0
    for size in lengths:
        def after(gap, size=size):
            c = Counter(gaps)
            if gap != capacity:
                c[gap] -= 1
            if gap > size:
                c[gap - size] += 1
            return sum(v * v for v in c.values())
        options = [(after(g), g == capacity, g) for g in [*sorted(g for g in gaps if gaps[g] > 0 and g >= size), capacity]]
        best = min(options)[2]
        made += best == capacity
        if best != capacity:
            gaps[best] -= 1
        if best > size:
            gaps[best - size] += 1
    return made


def test_against_plain_rule():
    rnd = random.Random(4)
    for _ in range(40):
        lengths = sorted((rnd.randint(1, 30) for _ in range(rnd.randint(1, 60))), reverse=True)
        sequence, offset = packing.sum_of_squares(np.array(lengths), 30)
        assert sequence.max() + 1 == brute(lengths, 30)
        ends = defaultdict(int)
        for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths, strict=True)):
            assert o == ends[s]
            ends[s] += n
        assert max(ends.values()) <= 30


def test_pack_every_kind_of_row(spark):
    rnd = random.Random(9)
    words = ["stone", "tree", "é1", "running,", "of\n", "<|endoftext|>"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 90, 400, 3000]))) for _ in range(80)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1), (3, texts[3], "x", 1), (None, texts[7], "", 2), (None, None, None, None), (5, None, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string, shard long").repartition(3)
    got = [r.asDict() for r in packing.pack(df, shard=40).collect()]
    pieces = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    want = Counter()
    for doc, text, *_ in rows:
        ids = reference_ids(text)
        first = (len(ids) - 1) % 2048 + 1
        at = [0, *range(first, len(ids), 2048)]
        for k, (a, b) in enumerate(zip(at, [*at[1:], len(ids)], strict=True)):
            want[doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert pieces == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 2048) + 6
    assert packing.pack(df.limit(0)).count() == 0
