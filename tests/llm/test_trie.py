"""The prefix trie against one built turn by turn, and the ranking of lists against a walk."""

import hashlib
import random
import zlib

import pytest

from cartwheel.llm import listrank, trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, k1 string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_nodes", "n_leaves", "saved_tokens", "ends_sha256")


def conversations(rows):
    out = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def mixed(rows):
    convs, out = conversations(rows), {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    def under(p):
        yield p
        for q in kids.get(p, []):
            yield from under(q)
    out = []
    for p, m in members.items():
        sub = list(under(p))
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), len(sub), sum(q not in kids for q in sub),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in sub if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def some(seed, n, span):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-span, span), n):
        for t in range(rng.randrange(1, 8)):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", "system", None, ""]), rng.choice(["a", "bb", "ccc é😀", None, "", " "])))
    return rows + rng.sample(rows, len(rows) // 5) + [(None, 1, "user", "x"), (None, None, None, None)]


@pytest.mark.parametrize("seed,n,span", [(1, 150, 400), (2, 40, 5000)])
def test_mixed_conversations(spark, seed, n, span):
    rows = some(seed, n, span)
    assert found(trie.mixed_trie(frame(spark, rows))) == brute(mixed(rows))


def test_pieces_and_small_chunks_give_the_same(spark, monkeypatch):
    rows = some(3, 60, 300)
    rows += [(7, i, "user", "long" * (i % 3)) for i in range(100, 400)]
    monkeypatch.setattr(trie, "keyed_scan", lambda *a, **kw: __import__("cartwheel.operators.scan").operators.scan.keyed_scan(*a, **kw, direct_max_rows=0))
    monkeypatch.setattr(trie, "ranked", lambda e, w: listrank.ranked(e, w, chunk=50))
    assert found(trie.mixed_trie(frame(spark, rows))) == brute(mixed(rows))


def test_conversations_as_they_are(spark):
    far = 1 << 62
    rows = [(1, t, "user", str(t)) for t in (far + 5, -far - 7, -far - 9, None, 3, far + 2)] + [(2, None, "user", "None"), (2, 1, "user", "None")]
    rows = [(c, t, r, "t" if c == 1 and t is None else x) for c, t, r, x in rows] + [(3, 0, "user", "퟿" * 100_000), (4, 9, "user", "퟿" * 100_000)]
    assert found(trie.conversation_trie(frame(spark, rows))) == brute(conversations(rows))


def test_same_conversation_many_times(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 100_000, 100) for t in range(3)]
    assert found(trie.mixed_trie(frame(spark, rows))) == brute(mixed(rows))


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "only") for c in range(101, 140)]    # conversation 100 is absent
    expected = brute(mixed(rows))
    assert found(trie.mixed_trie(frame(spark, rows))) == expected and expected[0][3] == 39
    assert found(trie.mixed_trie(frame(spark, []))) == []
    assert found(trie.mixed_trie(frame(spark, [(None, 1, "user", "x")]))) == []


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_list_ranking(spark, chunk):
    rng = random.Random(chunk)
    ids = rng.sample(range(10_000), 300)
    lists = [ids[:200], ids[200:201], ids[201:]]
    rows, expected = [], {}
    for one in lists:
        total = (0, 0)
        for i, after in zip(reversed(one), [-1, *reversed(one)], strict=False):
            w = (1, rng.randrange(-5, 6))
            total = (total[0] + w[0], total[1] + w[1])
            expected[i] = total
            rows.append((i, after, *w))
    df = spark.createDataFrame(rows, "id long, next long, arcs long, w long").repartition(5)
    assert {r[0]: tuple(r[1:]) for r in listrank.ranked(df, ["arcs", "w"], chunk).collect()} == expected
