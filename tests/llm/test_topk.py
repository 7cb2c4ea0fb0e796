"""The exact search against brute force on whole numbers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, k=10, every=100):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def whole(x):
        x *= 1024
        return (2**63 - 1 if x > 0 else -(2**63)) if abs(x) >= 2.0**63 else math.floor(x)

    good = [(i, r[0], [whole(x) for x in r[1]]) for i, r in enumerate(rows) if usable(r[1])]
    out = []
    for i, q, a in good:
        if q is None or q % every:
            continue
        got = [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), c is None, c or 0, c) for j, c, b in good if j != i]
        out += [(q, n + 1, c, -s) for n, (s, _, _, c) in enumerate(sorted(got, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def found(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in topk.exact_top_k(df, **kw).collect()), key=repr)


def vectors(rng, n, dim, size=1.0):
    return [(i, [rng.gauss(0, size) for _ in range(dim)]) for i in range(n)]


def test_brute_force_and_small_blocks(spark, monkeypatch):
    rows = vectors(random.Random(1), 450, 7)
    expected = brute(rows)
    assert found(spark, rows) == expected
    got = found(spark, rows, parts=9)
    assert got == expected


def test_ties_copies_and_common_vector(spark):
    rng = random.Random(2)
    rows = vectors(rng, 300, 4) + [(i, [1.0, 1.0, 0.5, 0.0]) for i in range(1000, 1400)] + [(None, [1.0, 1.0, 0.5, 0.0])] * 3
    rows += [(1000, [1.0, 1.0, 0.5, 0.0])] * 5
    assert found(spark, rows, parts=7) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [3.0]), (100, [2.0, 1.0, 7.0]),
            (200, None), (300, [nan]), (-100, [-1.0, -1.0]), (7, [1.0, 2.0]), (None, [0.25, 0.125])]
    assert found(spark, rows) == brute(rows)
    assert len(found(spark, rows, k=2)) == 6


@pytest.mark.parametrize("size", [1e6, 1e14, 1e18, 1e300])
def test_large_components(spark, size):
    rows = vectors(random.Random(3), 120, 3, size) + vectors(random.Random(4), 20, 3)
    assert found(spark, rows) == brute(rows)


def test_empty_and_no_query(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert found(spark, [(100, [1.0])]) == []


def test_other_queries_and_k(spark):
    rows = vectors(random.Random(5), 60, 5)
    assert found(spark, rows, asked=F.col("vec_id") % 20 == 0, k=3) == brute(rows, 3, 20)


def test_a_block_never_outgrows_its_bytes():
    import numpy as np

    lengths = np.array([10] * 5000 + [400_000] + [3] * 10)
    cuts = list(topk._cuts(lengths, topk.BLOCK_ROWS))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(lengths) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(b - a == 1 or (b - a) * lengths[a:b].max() * 8 <= topk.BLOCK_BYTES for a, b in cuts)
