"""Secret scan with a linear-chain conditional random field.

Three patterns give the base findings (``assign``, ``access``, ``hex``); the field adds findings of its own (``field``) that
touch no base finding, and takes none away.

Tokens are runs of the characters that secrets are made of (letters, digits, ``+ / _ . -`` and anything beyond ASCII) or
runs of other visible characters. Each is tagged as the beginning of a secret, inside one, or outside, from its shape
(kinds of characters, changes between letters and digits, length class), the words around it and a feature of the
whole text (its share of tokens with digits), with weights for neighbouring tags. Viterbi gives the best tags of the
whole text: where a token is outside by a margin that no neighbour can outweigh, it is fixed, and the stretches
between are decoded exactly.

The field is trained by stochastic gradient on stretches around base findings, on plain stretches, and on copies whose
secret and key word are replaced by made-up ones of other formats. At most ``TRAIN_STRETCHES`` texts and stretches of each kind are taken,
those with the lowest hash, whatever the partitioning. Each of these texts gives a stretch of 80 characters more on both
sides of every base finding, and one plain stretch of at most ``PLAIN_WORDS`` words without a finding, from a place anywhere
in the text that its hash chooses. Decoding covers every whole text.

Defined results: null and empty texts have no findings; repeated rows and null ids are judged one by one; extra columns
are ignored; an empty table gives an empty result. Without any stretch to train on the field finds nothing. Offsets are
code points.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import flat, lowest_texts, steps, text_or_empty
from cartwheel.llm.windows import BASE_2, byte_codes, prefix_hash, range_hash

# The base patterns and the least number of characters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Holds in every text with a base finding; for Spark's rlike, to find texts to train on.
HINT = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
KINDS = ("assign", "access", "hex", "field")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

TRAIN_STRETCHES, PLAIN_WORDS, PLAIN_CHARS = 1500, 40, 4000
EPOCHS, RATE, TOGETHER = 8, 0.5, 32
WORDS = 1 << 12
SHAPES = 32 * 5 * 8
FILE_CLASSES = 4
#: Least characters of a finding of the field, and it must hold a digit.
FIELD_LEAST = 12

_CLASS = np.full(256, 2, dtype=np.uint8)                     # 0 white space and controls, 1 secret characters, 2 others
_CLASS[:33] = 0
_CLASS[127] = 0
_CLASS[128:] = 1
_BITS = np.zeros(256, dtype=np.uint8)
for _chars, _bit in ((string.digits, 1), (string.ascii_lowercase, 2), (string.ascii_uppercase, 4), ("+/_.-", 8)):
    for _c in _chars.encode():
        _CLASS[_c], _BITS[_c] = 1, _bit
_BITS[128:] = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = byte_codes(0x33)
_HEX = np.zeros(256, dtype=np.int8)
_HEX[48:58] = _HEX[97:103] = 1


class Tokens:
    """Tokens of texts as numbers: shape, word, file class, first and end byte, and each text's first token."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        kind = _CLASS[raw]
        n = len(raw)
        first = np.zeros(n + 1, dtype=bool)
        if n:
            first[0] = True
            np.not_equal(kind[1:], kind[:-1], out=first[1:n])
            first[offsets] = True
            edge = np.flatnonzero(first[:n])
            stop = np.append(edge[1:], n)
            keep = kind[edge] > 0
            self.starts, self.ends = edge[keep], stop[keep]
        else:
            self.starts = self.ends = np.zeros(0, dtype=np.int64)
        self.bounds = np.searchsorted(self.starts, offsets)
        size = self.ends - self.starts
        if not len(size):
            self.shape = self.word = self.file = np.zeros(0, dtype=np.int64)
            return
        bits = _BITS[raw]
        pairs = np.empty((len(size), 2), dtype=np.int64)
        pairs[:, 0], pairs[:, 1] = self.starts, np.minimum(self.ends, n - 1)
        pairs = pairs.ravel()
        has = np.bitwise_or.reduceat(bits, pairs)[::2]
        if self.ends[-1] == n:
            has[-1] = np.bitwise_or.reduce(bits[self.starts[-1] :])
        digit = (bits == 1).astype(np.int8)
        turns = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(np.abs(np.diff(digit, prepend=digit[:1])), out=turns[1:])
        changes = np.minimum(np.ceil(np.log2(turns[self.ends] - turns[self.starts + 1] + 1)).astype(np.int64), 4)
        length = np.minimum(np.log2(size).astype(np.int64), 7)
        self.shape = (np.minimum(has, 31).astype(np.int64) * 5 + changes) * 8 + length
        self.word = (range_hash(prefix_hash(_CODES[_LOWER[raw]], BASE_2), self.starts, self.ends, BASE_2) % np.uint64(WORDS)).astype(np.int64)
        counts = np.diff(self.bounds)
        of = np.repeat(np.arange(len(counts)), counts)
        share = np.bincount(of, weights=(has & 1), minlength=len(counts)) / np.maximum(counts, 1)
        self.file = np.digitize(share, [0.001, 0.02, 0.1])[of]

    def rows(self) -> np.ndarray:
        """Weight numbers of each token: shape, the two words before, the word after, file class."""
        w = self.word
        edge = np.full(2, WORDS)
        before = np.concatenate([edge[:1], w[:-1]])
        before2 = np.concatenate([edge, w[:-2]]) if len(w) > 1 else edge[: len(w)]
        after = np.concatenate([w[1:], edge[:1]])
        lo, hi = self.bounds[:-1], self.bounds[1:]
        some = hi > lo
        before[lo[some]] = WORDS
        before2[lo[some]] = WORDS
        before2[np.minimum(lo[some] + 1, hi[some] - 1)] = WORDS
        after[hi[some] - 1] = WORDS
        base = np.array([0, SHAPES, SHAPES + WORDS + 1, SHAPES + 2 * (WORDS + 1), SHAPES + 3 * (WORDS + 1)])
        return np.stack([self.shape, before, before2, after, self.file], axis=1) + base


FEATURES = SHAPES + 3 * (WORDS + 1) + FILE_CLASSES
OUT, BEGIN, IN = 0, 1, 2
NEVER = -1e4


def viterbi(emit: np.ndarray, moves: np.ndarray) -> list[int]:
    """The best tags of one stretch whose neighbours are outside (or the ends of the text)."""
    best = emit[0] + moves[OUT]
    back = np.zeros((len(emit), 3), dtype=np.int64)
    for t in range(1, len(emit)):
        step = best[:, None] + moves
        back[t] = step.argmax(0)
        best = step.max(0) + emit[t]
    at = int((best + moves[:, OUT]).argmax())
    tags = [at]
    for t in range(len(emit) - 1, 0, -1):
        at = int(back[t, at])
        tags.append(at)
    return tags[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(stretches: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights (FEATURES x 3, then the 3 x 3 moves) from (rows, tags), by stochastic gradient of the log likelihood,
    ``TOGETHER`` stretches at a time, with a learning rate per weight. The row FEATURES pads short stretches."""
    weights, moves = np.zeros((FEATURES + 1, 3)), np.zeros((3, 3))
    past, past_moves = np.full((FEATURES + 1, 3), 1e-2), np.full((3, 3), 1e-2)
    rule = np.zeros((3, 3))
    rule[OUT, IN] = NEVER
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        shuffled = order.permutation(len(stretches))
        for at in range(0, len(shuffled), TOGETHER):
            some = [stretches[k] for k in shuffled[at : at + TOGETHER]]
            long = max(len(t) for _, t in some)
            rows = np.full((len(some), long, some[0][0].shape[1]), FEATURES)
            tags = np.zeros((len(some), long), dtype=np.int64)
            live = np.zeros((len(some), long), dtype=bool)
            for k, (r, t) in enumerate(some):
                rows[k, : len(t)], tags[k, : len(t)], live[k, : len(t)] = r, t, True
            emit = weights[rows].sum(2)
            step = moves + rule
            ahead, behind = np.empty_like(emit), np.empty_like(emit)
            ahead[:, 0] = emit[:, 0] + step[OUT]
            for t in range(1, long):
                ahead[:, t] = np.where(live[:, t, None], emit[:, t] + _log_sum(ahead[:, t - 1, :, None] + step, 1), ahead[:, t - 1])
            behind[:, -1] = step[:, OUT]
            for t in range(long - 2, -1, -1):
                behind[:, t] = np.where(live[:, t + 1, None], _log_sum(step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2), step[:, OUT])
            total = _log_sum(ahead[:, -1] + step[:, OUT], 1)[:, None, None]
            wrong = np.exp(ahead + behind - total)            # marginals, less the truth
            np.add.at(wrong, (*np.nonzero(live), tags[live]), -1)
            wrong = wrong[live]
            pair = np.exp(ahead[:, :-1, :, None] + step + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[..., None])[live[:, 1:]].sum(0)
            np.add.at(pair, (tags[:, :-1][live[:, 1:]], tags[:, 1:][live[:, 1:]]), -1)
            slope = np.zeros_like(weights)
            np.add.at(slope, rows[live], wrong[:, None, :])
            past += slope * slope
            weights -= RATE * slope / np.sqrt(past)
            past_moves += pair * pair
            moves -= RATE * pair / np.sqrt(past_moves)
    return np.concatenate([weights[:FEATURES].ravel(), (moves + rule).ravel()])


def least_loss(moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the moves lose at most when a tag BEGIN or IN is put outside: if the next tag is not IN; and if it is, so
    that it has to become BEGIN."""
    plain, linked = np.zeros(2), np.zeros(2)
    for k, tag in enumerate((BEGIN, IN)):
        before = (OUT, BEGIN, IN) if tag == BEGIN else (BEGIN, IN)
        enter = min(moves[a, OUT] - moves[a, tag] for a in before)
        plain[k] = enter + min(moves[OUT, b] - moves[tag, b] for b in (OUT, BEGIN))
        linked[k] = enter + moves[OUT, BEGIN] - moves[tag, IN] + min(moves[BEGIN, c] - moves[IN, c] for c in (OUT, BEGIN, IN))
    return plain, linked


def decode(model: np.ndarray, tokens: Tokens) -> list[tuple[int, int, int]]:
    """(text, first byte, end byte) of the secrets that the best tags mark."""
    n = len(tokens.starts)
    if not n:
        return []
    weights, moves = model[: FEATURES * 3].reshape(FEATURES, 3), model[FEATURES * 3 :].reshape(3, 3)
    rows = tokens.rows()
    emit = weights[rows[:, 0]]
    for c in range(1, rows.shape[1]):
        emit = emit + weights[rows[:, c]]
    plain, linked = least_loss(moves)
    turn = np.append(emit[1:, BEGIN] - emit[1:, IN], np.inf)[:, None]       # the next token would have to begin anew
    outside = (emit[:, :1] - emit[:, 1:] + np.minimum(plain, linked + turn) > 0).all(1)
    of = np.repeat(np.arange(len(tokens.bounds) - 1), np.diff(tokens.bounds))
    loose = np.flatnonzero(~outside)
    found = []
    if not len(loose):
        return found
    cut = np.flatnonzero((np.diff(loose) > 1) | (of[loose[1:]] != of[loose[:-1]])) + 1
    for part in np.split(loose, cut):
        tags = viterbi(emit[part], moves)
        k = 0
        while k < len(tags):
            if tags[k] == BEGIN:
                end = k + 1
                while end < len(tags) and tags[end] == IN:
                    end += 1
                found.append((int(of[part[0]]), int(tokens.starts[part[k]]), int(tokens.ends[part[end - 1]])))
                k = end
            else:
                k += 1
    return found


def with_hex_runs(raw: np.ndarray, offsets: np.ndarray, least: int = 24) -> set[int]:
    """The texts that hold ``least`` hexadecimal digits in a row. A text's end ends a run, as the texts lie side by side."""
    kind, n = _HEX[raw], len(raw)
    border = np.ones(n, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=border[1:])
    border[offsets[offsets < n]] = True
    edge = np.flatnonzero(border)
    long = edge[(kind[edge] == 1) & (np.append(edge[1:], n) - edge >= least)]
    return set((np.searchsorted(offsets, long, side="right") - 1).tolist())


def base_findings(text: str, data: bytes, hex_runs: bool = True) -> list[tuple[int, int, int, int, int]]:
    """(start, kind number, start, end, start of the secret) of the three patterns, in code points."""
    out = []
    low = data.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in data:
        out += [(m.start(), 1, m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if hex_runs:
        out += [(m.start(), 2, m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _made_up(rnd: random.Random) -> tuple[str, str]:
    """A key word and a secret of some other format."""
    pick = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))
    word = string.ascii_letters + string.digits
    kind = rnd.randrange(6)
    if kind == 0:
        return rnd.choice(["key", "credential", "auth", "access"]), pick(word, rnd.randint(20, 44))
    if kind == 1:
        return rnd.choice(["bearer", "authorization", "jwt"]), f"eyJ{pick(word, 17)}.eyJ{pick(word, 30)}.{pick(word + '_-', 43)}"
    if kind == 2:
        return rnd.choice(["key", "github", "deploy"]), rnd.choice(["ghp_", "sk_live_", "xoxb-", "glpat-"]) + pick(word, 36)
    if kind == 3:
        return rnd.choice(["aws", "key", "access"]), "AKIA" + pick(string.ascii_uppercase + string.digits, 16)
    if kind == 4:
        return rnd.choice(["pwd", "pass", "credential"]), pick(word, 8) + rnd.choice("_-.") + pick(string.digits + word, 10)
    return rnd.choice(["signature", "private", "hmac"]), pick("0123456789ABCDEF", 40)


def _plain(text: str, hits: list[tuple[int, int, int, int, int]]) -> str:
    """At most ``PLAIN_WORDS`` words (and ``PLAIN_CHARS`` characters) in a row that touch no finding, at a place that the text's hash chooses."""
    words = [m.span() for m in re.finditer(r"\S+", text)]
    ends = np.maximum.accumulate([0, *(h[3] for h in hits)])  # of the findings so far, by their start
    starts = np.array([h[2] for h in hits], dtype=np.int64)
    first, last = np.array(words, dtype=np.int64).reshape(-1, 2).T
    free = np.flatnonzero(ends[np.searchsorted(starts, last)] <= first)
    if not len(free):
        return ""
    chosen = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")
    k = chosen % len(free)
    runs = np.cumsum(np.diff(free, prepend=free[0]) > 1)
    left, right = np.searchsorted(runs, runs[k]), np.searchsorted(runs, runs[k], side="right")
    at = max(int(left), min(k, int(right) - PLAIN_WORDS))
    part = text[words[free[at]][0] : words[free[min(at + PLAIN_WORDS, int(right)) - 1]][1]]
    cut = chosen % max(1, len(part) - PLAIN_CHARS + 1)
    return part[cut : cut + PLAIN_CHARS]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, order, text, first, end): a stretch of text around each finding, and (kind 0) a plain one."""
    for batch in steps(batches):
        out = []
        for text in batch.column("text").to_pylist():
            hits = base_findings(text, text.encode())
            plain = _plain(text, hits)
            if plain:
                out.append((0, plain, -1, -1))
            within = [f for f in hits if f[1] != 2]
            ends = np.maximum.accumulate([0, *(f[3] for f in within)])
            starts = [f[0] for f in within]
            for _, kind, _, end, first in hits:
                if kind == 2 and ends[bisect.bisect_right(starts, first)] > first:
                    continue                                  # a part of another finding
                a, b = max(0, first - 80), min(len(text), end + 80)
                out.append((1, text[a:b], first - a, end - a))
        rows = [(k, int.from_bytes(hashlib.blake2b(f"{t}|{s}".encode(), digest_size=8).digest(), "little", signed=True), t, s, e) for k, t, s, e in out]
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["kind", "at", "text", "first", "end"])


def _tagged(text: str, first: int, end: int) -> tuple[np.ndarray, np.ndarray] | None:
    data = text.encode()
    a, b = (len(text[:x].encode()) if x >= 0 else -1 for x in (first, end))
    tokens = Tokens(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    if not len(tokens.starts):
        return None
    tags = np.zeros(len(tokens.starts), dtype=np.int64)
    if first >= 0:
        own = np.flatnonzero((tokens.starts >= a) & (tokens.ends <= b))
        tags[own] = IN
        tags[own[:1]] = BEGIN
    return tokens.rows(), tags


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lowest: dict[int, list] = {0: [], 1: []}                  # of each kind, and no more is held
    for batch in steps(batches):
        new = {(r["at"], r["kind"], r["text"], r["first"], r["end"]) for r in batch.to_pylist()}
        lowest = {kind: sorted({*rows, *(r for r in new if r[1] == kind)})[:TRAIN_STRETCHES] for kind, rows in lowest.items()}
    rows = [*lowest[0], *lowest[1]]
    rnd = random.Random(11)
    examples = []
    plain = [r[2] for r in rows if r[1] == 0]
    for _, kind, text, first, end in rows:
        examples.append(_tagged(text, first, end))
        if kind and rnd.random() < 0.5:
            word, secret = _made_up(rnd)
            head = re.sub(r"\w+(\W*)$", lambda m: word + m[1], text[:first], count=1) if rnd.random() < 0.7 else text[:first]  # noqa: B023
            examples.append(_tagged(head + secret + text[end:], len(head), len(head) + len(secret)))
        elif not kind and rnd.random() < 0.3:
            word, secret = _made_up(rnd)
            parts = text.split(" ")
            at = rnd.randrange(len(parts))
            mark = rnd.choice([" ", ": ", " = ", "="])
            head = " ".join([*parts[:at], word]) + mark
            examples.append(_tagged(head + secret + " " + " ".join(parts[at:]), len(head), len(head) + len(secret)))
    for text in plain[:300]:                                   # long numbers and key words without a secret
        parts = text.split(" ")
        parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(["token", "password reset", "secret", "4" + "".join(rnd.choice(string.digits) for _ in range(15)), "+49 30 1234567", "192.168.0.1", "a@b.example.org"]))
        examples.append(_tagged(" ".join(parts), -1, -1))
    model = fit([e for e in examples if e is not None]) if rows else np.zeros(FEATURES * 3 + 9)
    yield pa.RecordBatch.from_arrays([pa.array([model.astype("<f8").tobytes()], pa.binary())], ["model"])


def train(docs: DataFrame, text_col: str = "text", most: int = TRAIN_STRETCHES) -> np.ndarray:
    """The model from the stretches of at most ``most`` different texts with a base finding and as many of any kind."""
    texts = docs.select(text_or_empty(text_col).alias("text")).where("text <> ''")
    both = lowest_texts(texts.where(F.col("text").rlike(HINT)), most).unionByName(lowest_texts(texts, most))
    rows = both.mapInArrow(_stretches, "kind int, at long, text string, first int, end int")
    got = rows.repartition(1).mapInArrow(_fit, "model binary").collect()
    return np.frombuffer(got[0].model, dtype="<f8") if got else np.zeros(FEATURES * 3 + 9)


def _scan(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.value
        for batch in steps(batches, "_text"):
            raw, offsets = flat(batch.column("_text"))
            extra: dict[int, list[tuple[int, int]]] = {}
            for k, a, b in decode(weights, Tokens(raw, offsets)):
                extra.setdefault(k, []).append((a - int(offsets[k]), b - int(offsets[k])))
            hexed = with_hex_runs(raw, offsets)
            found = []
            for k, text in enumerate(batch.column("_text").to_pylist()):
                data = text.encode()
                base = base_findings(text, data, k in hexed)
                rows = [{"kind": KINDS[kind], "start": s, "end": e} for _, kind, s, e, _ in base]
                for a, b in extra.get(k, ()):
                    own = data[a:b]
                    s = len(data[:a].decode())
                    e = s + len(own.decode())
                    if e - s >= FIELD_LEAST and re.search(rb"\d", own) and not any(s < r["end"] and r["start"] < e for r in rows[: len(base)]):
                        rows.append({"kind": KINDS[3], "start": s, "end": e})
                found.append(sorted(rows, key=lambda r: (r["start"], KINDS.index(r["kind"]))))
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            rest = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(found, kind)], [*rest.schema.names, "findings"])

    return run


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and findings (kind, start, end) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(_scan(model), f"`{id_col}` {kind}, findings array<struct<kind:string,start:long,end:long>>")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = findings(docs, id_col, text_col)
    of = lambda k: F.filter("findings", lambda f: f["kind"] == k)
    joined = lambda rows: F.array_join(F.transform(rows, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    base = F.filter("findings", lambda f: f["kind"] != KINDS[3])
    return found.select(id_col, *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))
