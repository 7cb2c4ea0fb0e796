"""Repairs against a search through all edits, and the digest against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from cartwheel.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, at string, audit string"
WS = "\x20\t\n\x0b\f\r"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def everything(rows, most=2):
    """(cost, audit) least of all edits, tried one by one; rows of (initial, must go, truncated)."""
    best = None
    options = []
    for initial, gone, cut in rows:
        options.append([("D", "", 3)] + ([] if gone else [("K", initial or "?", cut), ("R", "u", 2 + cut), ("R", "a", 2 + cut)]))
    fills = [f for n in range(most + 1) for f in itertools.product("ua", repeat=n)]
    for picks in itertools.product(*options):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            roles, audit, cost = "", "", 0
            for i, gap in enumerate(gaps):
                roles, audit, cost = roles + "".join(gap), audit + "I" * len(gap), cost + 2 * len(gap)
                if i < len(rows):
                    letter, role, c = picks[i]
                    roles, audit, cost = roles + role, audit + letter, cost + c
            if PATTERN.match(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def plain(rows):
    """The same by a fold over (cost, audit) pairs, checked against ``everything``; good for long rows."""
    add = lambda p, c, a: p and (p[0] + c, p[1] + a)
    least = lambda *p: min((x for x in p if x), default=None)
    e, s, u, a = (0, ""), None, None, None

    def filled():
        up = least(u, *(add(x, 2, "I") for x in (e, s, a)))
        return up, least(a, add(up, 2, "I"))

    for initial, gone, cut in rows:
        u, a = filled()
        new = [add(x, 3, "D") for x in (e, s, u, a)]
        if not gone:
            k = lambda x, i: add(x, cut, "K") if i == initial else None
            new[1] = least(new[1], k(e, "s"))
            new[2] = least(new[2], *(k(x, "u") for x in (e, s, a)), *(add(x, 2 + cut, "R") for x in (e, s, a)))
            new[3] = least(new[3], k(u, "a"), add(u, 2 + cut, "R"))
        e, s, u, a = new
    return least(e, filled()[1])


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def digest(original, rows):
    out = []
    for c in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults, codes = set(), [], []
        for _, _, role, text in mine:
            bare = text.strip(WS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            codes.append((role[:1], faults[-1] in ("blank", "duplicate"), int(faults[-1] == "truncated")))
        cost, audit = plain(codes)
        turns = [r[1] for r in mine if r[1] is not None]
        state, lines, left = "", [], iter(mine)
        for letter in audit:
            _, _, role, text = next(left) if letter != "I" else (0, 0, "", "")
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{text}")
        initials = [r[2][:1] for r in mine]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def some(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "What? ", "a.b", "", " \n", "é!", "x" * 5000 + ".", None, ". ", "\x0b", "\xa0", "End.\n\n"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([t, t, t, t, None, t + 3]), rng.choice(["user", "assistant"] * 3 + ["system", "tool", None, "", "User"]), rng.choice(texts)))
    return rows + rng.sample(rows, len(rows) // 6) + [(None, 0, "user", "Hi."), (None, None, None, None), (n, 4, "assistant", "Alone.")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_plain_fold_is_the_search_through_all_edits():
    rng = random.Random(1)
    rows = [("u", False, 0), ("a", False, 1), ("s", False, 0), ("t", False, 0), ("u", True, 0), ("", False, 1)]
    for n in range(4):
        for _ in range(12 if n == 3 else 30):
            case = [rng.choice(rows) for _ in range(n)]
            assert plain(case) == everything(case), case


def through_pieces(rows, size):
    paths = repair.Paths(repair.EMPTY, 0)
    for i in range(0, len(rows), size):
        part = rows[i : i + size]
        paths.joined(repair.most_letters(len(part)), repair.solved(part, repair.STATES if i else (repair.EMPTY,)))
    paths.width += 2 * repair.BITS
    paths.best = [p and (p[0] << (2 * repair.BITS), p[1]) for p in paths.best]
    paths.inserts()
    return min(paths.read(s) for s in repair.GOAL if paths.best[s] is not None)


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_whole_number_weights_at_any_cut(size):
    rng = random.Random(size)
    kinds = [("u", False, 0), ("a", False, 0), ("a", False, 1), ("u", False, 1), ("s", False, 0), ("t", False, 0), ("u", True, 0), ("", False, 1)]
    for n in (0, 1, 2, 3, 6, 12, 40, 200):
        for _ in range(20):
            rows = [rng.choice(kinds) for _ in range(n)]
            assert through_pieces([(i, g, bool(c)) for i, g, c in rows], size) == plain(rows), rows


def test_damage_and_digest(spark):
    rows = some(2, 300)
    assert found(repair.damage_and_repair(frame(spark, rows))) == digest(rows, damage(rows))


def test_long_conversation_in_pieces(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["One.", f"n {t}", f"n {t}.", ""])) for t in range(3000)] + some(5, 20)
    expected = digest(rows, damage(rows))
    assert found(repair.damage_and_repair(frame(spark, rows))) == expected
    monkeypatch.setattr(repair, "keyed_scan", lambda *a, **kw: __import__("cartwheel.operators.scan").operators.scan.keyed_scan(*a, **kw, direct_max_rows=0))
    assert found(repair.damage_and_repair(frame(spark, rows))) == expected


def test_repaired_conversations(spark):
    rows = [(1, 0, "system", "Be nice."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "assistant", "Cut"), (2, 0, "user", " ")]
    got = [tuple(r) for r in repair.repair(frame(spark, rows)).orderBy("conv_id", "place").collect()]
    assert got == [(1, 0, "K", "system", "Be nice."), (1, 1, "I", "user", ""), (1, 2, "K", "assistant", "Hello."), (1, 3, "K", "user", "Hi."), (1, 4, "K", "assistant", "Cut")]
    for c in (3, 4):
        for t in range(3):
            rows.append((c, t, "tool", "odd."))
    roles = {}
    for r in repair.repair(frame(spark, rows)).orderBy("conv_id", "place").collect():
        roles[r.conv_id] = roles.get(r.conv_id, "") + r.role[:1]
    assert all(PATTERN.match(x) for x in roles.values())


def test_nothing_left_and_empty(spark):
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(repair.damage_and_repair(frame(spark, [(*gone, "user", "Hi.")]))) == [(gone[0], 0, 0, 0, 0, 0, 0, "", empty)]
    assert found(repair.damage_and_repair(frame(spark, []))) == []
    assert found(repair.repair(frame(spark, []))) == []
