"""Rolling behaviour features per user over 1 h, 24 h, 7 d and 30 d.

Semantics (per output row = one labelled event at time ``t``, in epoch ms):
the frame of window ``W`` holds the same user's rows with
``t - W <= ts <= t - 1 ms`` -- the current row and all rows in the same
millisecond are excluded, so no feature sees the present or the future.
Empty frames give counts 0, sums 0.0, distinct 0, avg/max NULL, ratio 1.0.
``count_sessions_24h`` counts events with a session id (not distinct
sessions); label duplicates from the one-to-many label join count as rows.

Plan. A sliding RANGE frame re-aggregates its whole frame per row (cost
rows x frame rows) and puts each user in one task. Instead every frame
aggregate is rewritten as a running aggregate over *enter/leave* rows,
evaluated by one skew-safe :func:`keyed_scan`:

- count / sum / conditional counts: each event enters at ``ts`` (seen by
  later milliseconds only) and leaves at ``ts + W``; frame value = running
  sum of deltas. Cart values are summed exactly as LONG digits of base 2**32
  (from 2**64 down to 2**-64), so enter/leave differences carry no
  floating-point drift, a result depends on the frame's rows alone and not on
  their order or on the plan, and every aggregate stays fixed-width. NaN and
  infinite values are counted beside the digits: a sum is NaN or infinite
  exactly while such a value is in the frame. Finite values of 2**64
  (1.8e19) and beyond count as infinite; parts below 2**-64 (5e-20) are rounded.
- distinct categories: per (user, category, ms) occurrence with next
  occurrence ``n``: +1 at ``ts``, -1 at ``min(n, ts + W)``. ``n`` comes from
  a second keyed scan (min over later rows), again skew-safe.
- max over 24 h: time is cut into aligned 24 h (UTC day) blocks; the frame
  spans at most two blocks, so max = max(forward per-block running max of
  the events earlier in the current block, backward per-block running max of
  the "tails" of the previous day's events, which end inside this block).
- leak-free abandonment count: +1 when the label becomes available,
  -1 at ``ts + 30 d``.

All of it stays in Catalyst expressions (no Python on the data path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .scan import DIRECT_MAX_ROWS, Scan, key_sizes, keyed_scan

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
# ---------------------------------------------------------------------------
# Window lengths and the ratio's epsilon.
# ---------------------------------------------------------------------------
WINDOWS = {"1h": HOUR_MS, "24h": DAY_MS, "7d": 7 * DAY_MS, "30d": 30 * DAY_MS}
EPSILON = 1e-6

# Base-2**32 digits of a cart value: exponents of their units, highest first.
DIGITS = (32, 0, -32, -64)
ABANDON_MODES = ("reference", "point_in_time")

FEATURE_COLUMNS = (
    "user_id", "event_timestamp",
    "count_events_1h", "sum_cart_value_1h", "avg_cart_value_1h", "distinct_categories_1h",
    "count_sessions_24h", "sum_cart_value_24h", "avg_cart_value_24h", "max_cart_value_24h",
    "distinct_categories_24h", "count_add_to_cart_24h",
    "count_events_7d", "sum_cart_value_7d", "distinct_categories_7d",
    "count_events_30d", "sum_cart_value_30d", "avg_cart_value_30d",
    "num_abandoned_confirmed_30d", "cart_value_24h_vs_avg_30d_ratio",
)

# What an event adds to its frames, as it stands in one row of the enter/leave table:
# c session id present, s0..s3 digits of the cart value, odd NaN and +Inf (2**31 apart), neg -Inf,
# n cart value present, a add-to-cart, b abandoned.
_PARTS = [*(f"s{k}" for k in range(len(DIGITS))), "odd", "neg"]
_BASE = ["c", *_PARTS, "n", "a", "b"]
# Kinds of rows: 0 the event enters; 1-4 it leaves a window; 5 its label becomes known;
# 6 a category occurs, 7-10 that occurrence ends in a window; 11 and 12-15 the same for a session.
_ENTER, _KNOWN = 0, 5
_LEAVE = {w: i + 1 for i, w in enumerate(WINDOWS)}
_FIRST = {"item_category": 6, "session_id": 11}
_DISTINCT = {"item_category": ("d", ("1h", "24h", "7d")), "session_id": ("e", ("24h",))}


def _deltas(pit: bool, sessions: bool) -> dict[str, str]:
    """Running sums: name -> SQL of one row's contribution (NULL counts as none)."""

    def span(column: str, w: str, enter: int = _ENTER) -> str:
        return f"CASE kind WHEN {enter} THEN {column} WHEN {_LEAVE[w]} THEN -{column} END"

    out = {f"c_{w}": span("c", w) for w in WINDOWS}
    out |= {f"{p}_{w}": span(p, w) for p in _PARTS for w in WINDOWS}
    out |= {f"n_{w}": span("n", w) for w in ("1h", "24h", "30d")}
    out |= {"a_24h": span("a", "24h"), "b_30d": span("b", "30d", _KNOWN if pit else _ENTER)}
    for column, (short, windows) in _DISTINCT.items():
        first = _FIRST[column]
        if column == "item_category" or sessions:
            out |= {f"{short}_{w}": f"CASE kind WHEN {first} THEN 1L WHEN {first + _LEAVE[w]} THEN -1L END" for w in windows}
    return out


def _split_exact(v: str) -> dict[str, str]:
    """SQL of ``v`` (a double) as signed base-2**32 digits plus the counters of values without digits, all LONG; NULL -> 0.

    Scaling by powers of two, ``%`` and ``floor`` are exact on doubles, so the digits add up to ``v`` but for what lies
    below the last one. Running sums of digits stay exact over 2**31 rows.
    """
    plain = f"{v} IS NOT NULL AND NOT isnan({v}) AND abs({v}) < {2.0 ** 64!r}D"
    out = {}
    for k, e in enumerate(DIGITS):
        rest = f"abs({v})" if k == 0 else f"abs({v}) % {2.0 ** (e + 32)!r}D"
        digit = f"floor({rest} * {2.0 ** -e!r}D + {0.5 if e == DIGITS[-1] else 0.0}D)"
        out[f"s{k}"] = f"CASE WHEN {plain} THEN CAST({digit} * CASE WHEN {v} < 0 THEN -1 ELSE 1 END AS BIGINT) ELSE 0L END"
    out["odd"] = f"CASE WHEN isnan({v}) THEN 1L WHEN {v} > 0 AND NOT ({plain}) THEN {2 ** 31}L ELSE 0L END"
    out["neg"] = f"CASE WHEN {v} < 0 AND NOT isnan({v}) AND NOT ({plain}) THEN 1L ELSE 0L END"
    return out


def _exact_total(prefix: str, w: str) -> str:
    """SQL of the double that digit sums ``<prefix>s0_<w>`` ... stand for."""
    odd, neg = f"{prefix}odd_{w}", f"{prefix}neg_{w}"
    total = "0.0D"
    for k in reversed(range(len(DIGITS))):
        total = f"({total} + CAST({prefix}s{k}_{w} AS DOUBLE) * {2.0 ** DIGITS[k]!r}D)"
    return (f"CASE WHEN {odd} % {2 ** 31}L > 0 OR ({odd} >= {2 ** 31}L AND {neg} > 0) THEN double('NaN') "
            f"WHEN {odd} >= {2 ** 31}L THEN double('Infinity') WHEN {neg} > 0 THEN double('-Infinity') ELSE {total} END")


def _inputs() -> list[str]:
    """SQL of what the features read of a labelled event, few bytes a row."""
    return ["unix_millis(event_timestamp) AS _ms", "unix_millis(label_available_date) AS _label_ms",
            "CAST(session_id IS NOT NULL AS BIGINT) AS c", "CAST(cart_value IS NOT NULL AS BIGINT) AS n",
            "CAST(coalesce(event_type = 'add_to_cart', false) AS BIGINT) AS a",
            "CAST(coalesce(will_abandon = 1, false) AS BIGINT) AS b", "CAST(cart_value AS DOUBLE) AS v"]


_DIGITS = [f"{x} AS {k}" for k, x in _split_exact("v").items()]
_VALUES = ["c", *_DIGITS, "n", "a", "b", "v"]


def _occurrences(events: DataFrame, column: str, num_partitions: int | None,
                 direct_max_rows: int = DIRECT_MAX_ROWS, sizes: tuple[int | None, int] | None = None) -> DataFrame:
    """Each (user, non-NULL value of ``column``, ms) with the value's next occurrence ``_next``."""
    occ = events.filter(F.col(column).isNotNull()).select("user_id", column, "_ms").distinct()
    top, total = sizes or (None, None)
    occ = keyed_scan(occ, ["user_id", column], "_ms",
                     [Scan("_next", F.col("_ms"), "min", "after")],
                     num_partitions=num_partitions, direct_max_rows=direct_max_rows,
                     max_rows_hint=top, rows_hint=total)
    return occ.select("user_id", "_ms", "_next", F.lit(_FIRST[column]).alias("_first"))


def _changes(pit: bool, columns: tuple[str, ...]) -> str:
    """SQL of the (kind, pos) of the rows that stand for one event or occurrence: an event enters and leaves each window;
    an occurrence counts from its millisecond until the value's next one or until it leaves the window, whichever is first."""

    def rows(at: list[tuple[int, str]]) -> str:
        return f"array({', '.join(f'named_struct({chr(39)}kind{chr(39)}, {kind}, {chr(39)}pos{chr(39)}, {pos})' for kind, pos in at)})"

    at = [(_ENTER, "_ms")] + [(_LEAVE[w], f"_ms + {width}L") for w, width in WINDOWS.items()]
    out = f"CASE WHEN b <> 0 THEN {rows([*at, (_KNOWN, 'coalesce(_label_ms, _ms)')])} ELSE {rows(at)} END" if pit else rows(at)
    for column in columns:
        first = _FIRST[column]
        ends = [(first + _LEAVE[w], f"least(_next, _ms + {WINDOWS[w]}L)") for w in _DISTINCT[column][1]]
        out = f"CASE WHEN _first = {first} THEN {rows([(first, '_ms'), *ends])} ELSE {out} END"
    return f"inline({out})"


def user_sizes(events: DataFrame) -> tuple[int, int]:
    """Row counts of the busiest user and of all users."""
    return key_sizes(events, ["user_id"])


def _order(df: DataFrame, distinct_sessions: bool, carried: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*FEATURE_COLUMNS, *(["distinct_sessions_24h"] if distinct_sessions else []), *carried)


def behavior_features(events: DataFrame, abandon_mode: str = "reference",
                      num_partitions: int | None = None,
                      direct_max_rows: int = DIRECT_MAX_ROWS,
                      distinct_sessions: bool = False,
                      sizes: tuple[int, int] | None = None, stored: bool = False,
                      carried: tuple[str, ...] = ()) -> DataFrame:
    """The 20-column behaviour feature table, one row per input row (see module docstring).

    One plan at every size; ``direct_max_rows`` (0 forces range pieces) only decides how :func:`keyed_scan` runs it,
    and all its sums are of LONG columns, so the results agree bit for bit. ``sizes``: :func:`user_sizes` of the events
    if the caller measured them already. ``distinct_sessions`` appends ``distinct_sessions_24h``, the number of distinct
    sessions in the 24 h frame (``count_sessions_24h`` keeps its original meaning: events with a session id).

    ``events``: labelled events (``user_id, session_id, event_timestamp,
    cart_value, event_type, item_category, will_abandon,
    label_available_date``); read once, eagerly, unless ``stored`` says that they
    are a table and not a plan. ``abandon_mode``: ``reference``
    counts abandoned events by event time; ``point_in_time`` only counts
    labels already available one millisecond before the row. ``carried``: more
    columns of ``events``, returned with each row as they are.
    """
    if abandon_mode not in ABANDON_MODES:
        raise ValueError(f"abandon_mode must be one of {ABANDON_MODES}")
    pit = abandon_mode == "point_in_time"
    # the (label join's) rows are read three times below: stored once, in the few columns that count
    narrow = events.selectExpr("user_id", "event_timestamp", "item_category", *(["session_id"] if distinct_sessions else []), *_inputs(), *carried)
    if not stored:
        path = scratch_path(events.sparkSession, "feature-inputs")
        narrow.write.parquet(path)
        narrow = events.sparkSession.read.schema(narrow.schema).parquet(path)
    events = narrow
    top, total = sizes or user_sizes(events)
    columns = ("item_category", "session_id") if distinct_sessions else ("item_category",)
    # per labelled row at most: 1 query + 4 leave + 1 label row, and per
    # (value, ms) occurrence 4 category + 2 session rows -> 12 delta rows
    delta_rows = 9 + pit + 2 * distinct_sessions
    rows = events.select("user_id", "event_timestamp", "_ms", "_label_ms", *(c for c in _BASE if c not in _PARTS), "v", *carried)
    for column in columns:
        rows = rows.unionByName(_occurrences(events, column, num_partitions, direct_max_rows, (top, total)), allowMissingColumns=True)
    scans = [Scan(f"r_{k}", F.expr(x)) for k, x in _deltas(pit, distinct_sessions).items()]
    # Max piece starting inside the event's own block: it covers the rest of
    # that block, unless ts is the block's last millisecond (then the whole
    # next block is covered by the 24 h leave row).
    own_block = F.expr(f"CASE WHEN kind = {_ENTER} AND pmod(pos + 1, {DAY_MS}L) <> 0 THEN v END")
    tail = F.expr(f"CASE WHEN kind = {_LEAVE['24h']} THEN v END")
    scans += [Scan("r_mx_pre", own_block, "max", "before", per_block=True),
              Scan("r_mx_suf", tail, "max", "from", per_block=True)]
    scanned = keyed_scan(rows, ["user_id"], "pos", scans, num_partitions=num_partitions,
                         block=F.expr(f"floor(pos / {DAY_MS}D)"), direct_max_rows=direct_max_rows,
                         max_rows_hint=12 * top, rows_hint=delta_rows * total, keep=["kind", "event_timestamp", *carried],
                         inputs=[*_BASE, "v"], expand=[*_DIGITS, _changes(pit, columns)])
    out = _frame_values(scanned.filter(F.col("kind") == _ENTER), "r_", "greatest(r_mx_pre, r_mx_suf)",
                        [*(["CAST(r_e_24h AS INT) AS distinct_sessions_24h"] if distinct_sessions else []), *carried])
    return _order(out, distinct_sessions, carried)


def _frame_values(sums: DataFrame, p: str, highest: str, more: list[str] = ()) -> DataFrame:
    """The feature columns from the sums of every frame (columns ``<p><delta name>``)."""

    def total(w: str) -> str:
        return _exact_total(p, w)

    def mean(w: str) -> str:
        return f"CASE WHEN {p}n_{w} > 0 THEN {total(w)} / {p}n_{w} END"

    out = sums.selectExpr(
        "user_id", "event_timestamp",
        f"{p}c_1h AS count_events_1h",
        f"{total('1h')} AS sum_cart_value_1h",
        f"{mean('1h')} AS avg_cart_value_1h",
        f"CAST({p}d_1h AS INT) AS distinct_categories_1h",
        f"{p}c_24h AS count_sessions_24h",
        f"{total('24h')} AS sum_cart_value_24h",
        f"{mean('24h')} AS avg_cart_value_24h",
        f"{highest} AS max_cart_value_24h",
        f"CAST({p}d_24h AS INT) AS distinct_categories_24h",
        f"{p}a_24h AS count_add_to_cart_24h",
        f"{p}c_7d AS count_events_7d",
        f"{total('7d')} AS sum_cart_value_7d",
        f"CAST({p}d_7d AS INT) AS distinct_categories_7d",
        f"{p}c_30d AS count_events_30d",
        f"{total('30d')} AS sum_cart_value_30d",
        f"{mean('30d')} AS avg_cart_value_30d",
        f"{p}b_30d AS num_abandoned_confirmed_30d",
        *more)
    return out.withColumn("cart_value_24h_vs_avg_30d_ratio", spend_ratio())


def latest_behavior_features(events: DataFrame, abandon_mode: str = "reference",
                             unlabelled: DataFrame | None = None) -> DataFrame:
    """The feature row of every user's newest event, the same values as in :func:`behavior_features`.

    Where one row per user is asked for, its frames are fixed by the newest
    time, so each is a conditional sum: events are joined with their user's
    newest time and aggregated twice, by (user, category) and by user, with
    partial aggregation. No sort and no running frame. ``unlabelled``: the events
    before the label join, which know the newest times without it.
    """
    pit = abandon_mode == "point_in_time"
    newest = (events if unlabelled is None else unlabelled).groupBy(F.col("user_id").alias("_u")).agg(F.max("event_timestamp").alias("_at"))
    rows = events.selectExpr("user_id", "item_category", *_inputs()).selectExpr("user_id", "item_category", "_ms", "_label_ms", *_VALUES).join(newest, F.col("user_id").eqNullSafe(F.col("_u")))
    rows = rows.withColumn("_end", F.unix_millis("_at")).filter(f"_ms >= _end - {max(WINDOWS.values())}L")
    seen = {w: f"(_ms < _end AND _ms >= _end - {width}L)" for w, width in WINDOWS.items()}
    known = f"({seen['30d']} AND coalesce(_label_ms, _ms) < _end)" if pit else seen["30d"]
    sums = {f"c_{w}": ("c", seen[w]) for w in WINDOWS} | {f"{p}_{w}": (p, seen[w]) for p in _PARTS for w in WINDOWS}
    sums |= {f"n_{w}": ("n", seen[w]) for w in ("1h", "24h", "30d")} | {"a_24h": ("a", seen["24h"]), "b_30d": ("b", known)}
    first = [F.expr(f"sum(CASE WHEN {when} THEN {c} ELSE 0L END) AS {k}") for k, (c, when) in sums.items()]
    first += [F.expr(f"max(CASE WHEN {seen[w]} AND item_category IS NOT NULL THEN 1L ELSE 0L END) AS d_{w}") for w in ("1h", "24h", "7d")]
    first += [F.expr(f"max(CASE WHEN {seen['24h']} THEN v END) AS highest")]
    by_category = rows.groupBy("user_id", F.col("_at").alias("event_timestamp"), "item_category").agg(*first)
    names = [*sums, "d_1h", "d_24h", "d_7d"]
    by_user = by_category.groupBy("user_id", "event_timestamp").agg(*(F.sum(k).alias(k) for k in names), F.max("highest").alias("highest"))
    return _order(_frame_values(by_user, "", "highest"), False)


def spend_ratio(sum_24h: str = "sum_cart_value_24h", avg_30d: str = "avg_cart_value_30d") -> Column:
    """Last-24 h spend relative to the 30-day mean; 1.0 without 30-day history."""
    return F.coalesce(F.col(sum_24h) / (F.col(avg_30d) + F.lit(EPSILON)), F.lit(1.0))
