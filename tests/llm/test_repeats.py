"""Substring dedup (words) and suffix-array dedup (bytes) against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm import substring, suffix
from cartwheel.llm.windows import BASE, phrases, prefix_hash, range_hash, sliding_min

SCHEMA = "doc_id long, text string, lang string, spans string"


def covered(seqs, length):
    seen = Counter(tuple(s[i : i + length]) for s in seqs for i in range(len(s) - length + 1))
    out = []
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if seen[tuple(s[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def corpus(seed, docs=60, vocabulary=400):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdé€") + str(int(rnd.paretovariate(0.5)) % vocabulary)
    passages = [[word() for _ in range(rnd.choice([20, 34, 35, 36, 50, 90, 300]))] for _ in range(6)]
    common = [word() for _ in range(60)]
    rows = []
    for i in range(docs):
        kind = rnd.random()
        if kind < 0.15 and rows:
            words = rnd.choice(rows)[1].split()
        else:
            words = [word() for _ in range(rnd.choice([0, 3, 30, 40, 120]))]
            for _ in range(rnd.randint(0, 3)):
                part = list(rnd.choice(passages))
                if rnd.random() < 0.4:
                    part[rnd.randrange(len(part))] = "edit"
                at = rnd.randint(0, len(words))
                words[at:at] = part
            words[len(words) // 2 : len(words) // 2] = common
        if rnd.random() < 0.1:
            words += [word()] * rnd.choice([30, 36, 80])
        if rnd.random() < 0.1:
            words += [word(), word(), word()] * 40
        rows.append((i, rnd.choice([" ", "\n", "  ", "\t"]).join(words), "en", "x"))
    return rows + [(None, None, None, None), (7, None, None, None), (None, "", "", ""), (None, "x \x1c y z w", "", ""), *rows[:3], rows[4]]


def words(text):
    return (text or "").encode().split()


@pytest.mark.parametrize(("seed", "block"), [(1, 2000), (2, 2000), (3, 1)])
def test_words_against_brute_force(spark, seed, block):
    rows = corpus(seed)
    seqs = [words(r[1]) for r in rows]
    want = []
    for r, s, gone in zip(rows, seqs, covered(seqs, 35), strict=True):
        kept = b" ".join(w for w, g in zip(s, gone, strict=True) if not g)
        want.append((r[0], len(s), sum(gone), hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in substring.dedup_digest(spark.createDataFrame(rows, SCHEMA).repartition(3), block_phrases=block).collect()]
    assert Counter(got) == Counter(want)
    assert sum(w[2] for w in want) > 0 and any(0 < w[2] < w[1] for w in want)


@pytest.mark.parametrize(("seed", "block"), [(1, 2000), (2, 1)])
def test_bytes_against_brute_force(spark, seed, block):
    rows = corpus(seed, docs=40)
    seqs = [(r[1] or "").encode() for r in rows]
    want = []
    for r, s, gone in zip(rows, seqs, covered(seqs, 200), strict=True):
        kept = bytes(b for b, g in zip(s, gone, strict=True) if not g)
        runs = sum(g and not p for p, g in zip([False, *gone], gone, strict=False))
        want.append((r[0], len(s), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix.dedup_digest(spark.createDataFrame(rows, SCHEMA).repartition(3), block_phrases=block).collect()]
    assert Counter(got) == Counter(want)
    assert any(0 < w[2] < w[1] for w in want)


def test_text_outputs_and_empty_table(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"a {passage} b"), (2, f"c {passage}")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in substring.dedup_substrings(df).collect()}
    assert got == {1: (40, "a b"), 2: (40, "c")}
    long = "".join(chr(97 + (i * i) % 23) + str(i) for i in range(120))
    df2 = spark.createDataFrame([(1, f"x{long}y"), (2, f"p{long}q")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept_bytes) for r in suffix.dedup_bytes(df2).collect()} == {1: b"xy", 2: b"pq"}
    assert substring.dedup_digest(df.limit(0)).count() == 0
    assert suffix.dedup_digest(df.limit(0)).count() == 0


def test_kernels():
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 1 << 63, 500, dtype=np.uint64)
    assert (sliding_min(x, 37) == [x[i : i + 37].min() for i in range(464)]).all()
    y = np.concatenate([x, x])
    p = prefix_hash(y)
    i = np.arange(300)
    assert (range_hash(p, i, i + 50) == range_hash(p, i + 500, i + 550)).all()
    got = phrases(y, np.array([0, 500, 500, 1000]), 35, 15)
    assert got["windows"].sum() == 2 * 466 and sorted(set(got["doc"].tolist())) == [0, 2]
    assert BASE & np.uint64(1)


def test_factors_cross_checked_at_their_ends():
    # the greedy factor at 0 has 40 words; a longer repeat begins inside it
    matches = [40 - i for i in range(30)] + [60 - i for i in range(60)]
    assert substring.parse(matches, 35) == [(0, 40), (30, 90)]
    assert substring.parse([10, 50, *[49 - i for i in range(48)]], 35)[0] == (1, 51)
