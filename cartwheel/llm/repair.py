"""Repair of conversation structure: the cheapest edits that make the roles of a conversation read ``(s?(ua)+)?``.

Edits: Keep a row (0), Rerole it to user or assistant (2), Delete it (3; a must for blank and repeated rows), Insert an
empty user or assistant row (2). A truncated row that stays adds 1. Of the cheapest edits the one whose letters read first
in ASCII order is taken.

Method: a shortest path through the DAG of (rows done, state of the role pattern), with whole numbers as weights. The high
digits of a weight are its cost; below them stands one digit of fixed width per letter (D < I < K < R), the first letter
highest and zeros at the end. An edge adds its cost and its letter, and the smaller number is the cheaper path or, at equal
cost, the earlier letters. Two paths to one node that cost the same never have one's letters as the start of the other's:
they hold as many row letters, so the longer one has more inserts and costs more. Hence the smaller weight at a node stays
the smaller one however the path goes on, and the plain minimum decides everything.

A conversation is cut into pieces of ``PIECE`` rows. A task solves single pieces, for each state at their start (the first
piece has one), so long conversations are spread over tasks; the pieces' weights are then joined up in order, by the same
sums and minima. Rows are numbered and repeated ones found by scans over range pieces (``operators.scan``). The repaired
texts are streamed in order; a task holds one batch of rows and the letters of one conversation, whatever its length.

Defined results: a null role or text is one space, a null conv_id is a conversation of its own; rows go by turn, null first,
then role, then text. A role that is empty or has another initial than s, u or a fits nowhere: the row is reroled or deleted. An empty table, and a
conversation without rows, have empty repairs of cost 0. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored
from cartwheel.llm.trie import EMPTY_SHA
from cartwheel.operators.scan import Scan, keyed_scan

PIECE = 256
#: Letters of the audit; the digit of a letter is its place here, from 1, and letters stand in ASCII order.
LETTERS = "DIKR"
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED_COST = 1
#: States of the role pattern: nothing yet, after the system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
GOAL = (EMPTY, ASSISTANT)
#: The state that the role with this initial leads to.
STEP = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that a reroled or inserted row takes.
WANTED = {EMPTY: ("u", "user"), SYSTEM: ("u", "user"), USER: ("a", "assistant"), ASSISTANT: ("u", "user")}
BITS = 3
_TO_DIGITS, _TO_LETTERS = str.maketrans(LETTERS, "1234"), str.maketrans("1234", LETTERS)
_FAR = 1 << 62
SPACE = "[^ \\t\\n\\x0B\\f\\r]"


class Paths:
    """The cheapest path to every state: a weight and its number of letters, or None. ``width`` bits hold the letters."""

    def __init__(self, start: int, width: int) -> None:
        self.width = width
        self.best: list[tuple[int, int] | None] = [None] * len(STATES)
        self.best[start] = (0, 0)

    def plus(self, path: tuple[int, int], letter: str, more: int = 0) -> tuple[int, int]:
        weight, n = path
        digit = (LETTERS.index(letter) + 1) << (self.width - BITS * (n + 1))
        return weight + ((COST[letter] + more) << self.width) + digit, n + 1

    @staticmethod
    def offer(best: list, state: int, path: tuple[int, int]) -> None:
        if best[state] is None or path < best[state]:
            best[state] = path

    def inserts(self) -> None:
        """Rows put in at this place: a user row at most, then an assistant row at most."""
        for state in (EMPTY, SYSTEM, ASSISTANT, USER):
            if self.best[state] is not None:
                self.offer(self.best, STEP[state][WANTED[state][0]], self.plus(self.best[state], "I"))

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.inserts()
        after: list = [None] * len(STATES)
        more = TRUNCATED_COST if truncated else 0
        for state, path in enumerate(self.best):
            if path is None:
                continue
            self.offer(after, state, self.plus(path, "D"))
            if not must_go:
                self.offer(after, STEP[state][WANTED[state][0]], self.plus(path, "R", more))
                if initial in STEP[state]:
                    self.offer(after, STEP[state][initial], self.plus(path, "K", more))
        self.best = after

    def joined(self, letters: int, piece: dict[tuple[int, int], tuple[int, str]]) -> None:
        """Go on through a piece, given the cost and letters of its cheapest path between any two states; ``letters`` is the
        most that it can have."""
        self.width += BITS * letters
        after: list = [None] * len(STATES)
        for (a, b), (cost, audit) in piece.items():
            if self.best[a] is not None:
                weight, n = self.best[a]
                digits = int(audit.translate(_TO_DIGITS) or "0", 8) << (self.width - BITS * (n + len(audit)))
                self.offer(after, b, ((weight << (BITS * letters)) + (cost << self.width) + digits, n + len(audit)))
        self.best = after

    def read(self, state: int) -> tuple[int, str]:
        """Cost and letters."""
        weight, n = self.best[state]
        digits = (weight & ((1 << self.width) - 1)) >> (self.width - BITS * n)
        return weight >> self.width, (f"{digits:o}" if n else "").translate(_TO_LETTERS)


def most_letters(rows: int) -> int:
    """Letters of rows and of the inserts before each of them, of which two make sense."""
    return 3 * rows


def solved(rows: list[tuple[str, bool, bool]], starts: range | tuple[int, ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and letters of the cheapest path through (initial, must go, truncated) from each start to each state."""
    out = {}
    for start in starts:
        paths = Paths(start, BITS * most_letters(len(rows)))
        for row in rows:
            paths.row(*row)
        out |= {(start, end): paths.read(end) for end in STATES if paths.best[end] is not None}
    return out


PIECES = "conv_id long, piece long, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, starts array<int>, ends array<int>, costs array<long>, audits array<string>"
_LEGAL = {"su", "ua", "au"}


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with one key, over batch ends."""
    now, held = None, []
    for batch in batches:
        for r in batch.to_pylist():
            k = tuple(r[c] for c in key)
            if held and k != now:
                yield now, held
                held = []
            now = k
            held.append(r)
    if held:
        yield now, held


def _frames(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == 1000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        for (conv, piece), rows in _groups(batches, ["conv_id", "piece"]):
            faults = [r["fault"] for r in rows]
            paths = solved([(r["initial"], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults, strict=True)], STATES if piece else (EMPTY,))
            initials = [r["initial"] for r in rows]
            yield {"conv_id": conv, "piece": piece, "n": len(rows), "illegal": _illegal(initials), "first": initials[0], "last": initials[-1],
                   "starts": [a for a, _ in paths], "ends": [b for _, b in paths], "costs": [c for c, _ in paths.values()],
                   "audits": [x for _, x in paths.values()], **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}}

    yield from _frames(each(), _schema(PIECES))


REPORT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one row a conversation. One piece is held at a time."""

    def finish(report: dict, paths: Paths) -> dict:
        paths.width += BITS * 2
        paths.best = [p and (p[0] << (BITS * 2), p[1]) for p in paths.best]
        paths.inserts()
        _, end = min((paths.best[s], s) for s in GOAL if paths.best[s] is not None)
        cost, audit = paths.read(end)
        return report | {"cost": cost, "audit": audit}

    def each() -> Iterator[dict]:
        report, paths, last = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if report is None or r["conv_id"] != report["conv_id"]:
                    if report is not None:
                        yield finish(report, paths)
                    report, paths, last = {"conv_id": r["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, Paths(EMPTY, 0), None
                for f in ("blank", "duplicate", "truncated", "illegal"):
                    report[f] += r[f]
                report["illegal"] += last is not None and last + r["first"] not in _LEGAL
                last = r["last"]
                paths.joined(most_letters(r["n"]), dict(zip(zip(r["starts"], r["ends"], strict=True), zip(r["costs"], r["audits"], strict=True), strict=True)))
        if report is not None:
            yield finish(report, paths)

    yield from _frames(each(), _schema(REPORT))


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of every row after the edits; ``rows`` are the (role, text) of the conversation."""
    state = EMPTY
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = WANTED[state][1]
        state = STEP[state][role[:1]]
        yield letter, role, text


HASHES = "conv_id long, repaired_sha256 string"
REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, Iterator[tuple[str, str]]]]:
    """(conv_id, audit, rows), streamed: each conversation's first row holds its audit."""
    flat = (r for batch in batches for r in batch.to_pylist())
    ahead = next(flat, None)

    def rows(conv: int | None) -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead["conv_id"] == conv and ahead["at"] is not None:
            r, ahead = ahead, next(flat, None)
            yield r["role"], r["text"]

    while ahead is not None:
        conv, audit = ahead["conv_id"], ahead["text"]
        ahead = next(flat, None)
        mine = rows(conv)
        yield conv, audit, mine
        for _ in mine:
            pass


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        for conv, audit, rows in _conversations(batches):
            sha, glue = hashlib.sha256(), ""
            for _, role, text in edited(audit, rows):
                sha.update(f"{glue}{role}:{text}".encode())
                glue = "\n"
            yield {"conv_id": conv, "repaired_sha256": sha.hexdigest()}

    yield from _frames(each(), _schema(HASHES))


def _write_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        for conv, audit, rows in _conversations(batches):
            for place, (letter, role, text) in enumerate(edited(audit, rows)):
                yield {"conv_id": conv, "place": place, "edit": letter, "role": role, "text": text}

    yield from _frames(each(), _schema(REPAIRED))


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """Stored (conv_id, turn, role, text, at, tie): (at, tie) orders the rows of a conversation."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = rows.withColumn("at", F.when(F.col("turn").isNull(), -_FAR).otherwise(F.greatest(F.least("turn", F.lit(_FAR)), F.lit(1 - _FAR))))
    tie = Window.partitionBy("conv_id", "at").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return stored(rows.withColumn("tie", F.row_number().over(tie).cast("long")), "repair-rows")


def _fault(text: Column, seen: Column) -> Column:
    last = F.regexp_extract(text, f"({SPACE})[ \\t\\n\\x0B\\f\\r]*\\z", 1)
    return F.when(~text.rlike(SPACE), "blank").when(seen, "duplicate").when(~last.isin(".", "!", "?"), "truncated")


def report(rows: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of every conversation that has ``ordered_rows``."""
    marks = rows.select("conv_id", "at", "tie", F.substring("role", 1, 1).alias("initial"), _fault(F.col("text"), F.lit(False)).alias("fault"),
                        F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"))
    placed = keyed_scan(stored(marks, "repair-marks"), ["conv_id"], "at", [Scan("before", F.lit(1).cast("long"))])
    placed = stored(placed.withColumn("place", F.col("before") + F.col("tie") - 1).drop("before", "at", "tie"), "repair-places")
    seen = keyed_scan(placed, ["conv_id", "t1", "t2"], "place", [Scan("seen", F.lit(1).cast("long"))])
    fault = F.when(F.col("fault") == "blank", F.col("fault")).when(F.col("seen") > 0, "duplicate").otherwise(F.col("fault"))
    pieces = seen.select("conv_id", F.floor(F.col("place") / PIECE).cast("long").alias("piece"), "place", "initial", fault.alias("fault"))
    pieces = pieces.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "place").drop("place").mapInArrow(_solve_pieces, PIECES)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_join_pieces, REPORT)


def _with_audits(rows: DataFrame, reports: DataFrame, run: Callable, ddl: str) -> DataFrame:
    """Rows streamed in order, each conversation behind its audit (``at`` null, which sorts first)."""
    none = F.lit(None).cast("long")
    audits = reports.select("conv_id", none.alias("at"), none.alias("tie"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = audits.unionByName(rows.select("conv_id", "at", "tie", "role", "text"))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("at"), "tie").select("conv_id", "at", "role", "text").mapInArrow(run, ddl)


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place from 0, edit K, R or I, role, text)."""
    rows = ordered_rows(conversations)
    return _with_audits(rows, stored(report(rows), "repair-report"), _write_repaired, REPAIRED)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32(conv_id:turn) % 20: dropped, emptied, without end marks, repeated, or made a user row."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")


def repair_digest(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: what was found in ``rows`` (its rows, maybe damaged) and the repair."""
    ordered = ordered_rows(rows)
    reports = stored(report(ordered), "repair-report")
    hashes = _with_audits(ordered, reports, _hash_repaired, HASHES)
    wide = [F.col(c).cast("decimal(20)") for c in ("high", "low", "turns")]
    gaps = ordered.groupBy("conv_id").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count_distinct("turn").alias("turns"))
    between = F.least(wide[0] - wide[1] + 1 - wide[2], F.lit(2**63 - 1).cast("decimal(20)")).cast("long")
    gaps = gaps.select("conv_id", F.when(F.col("high").isNotNull(), between).alias("gaps"))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (gaps, reports, hashes):
        got = part.withColumnRenamed("conv_id", "_id")
        every = every.join(got, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    zero = F.lit(0).cast("long")
    return every.select("conv_id", *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    return repair_digest(conversations, damaged(conversations))
