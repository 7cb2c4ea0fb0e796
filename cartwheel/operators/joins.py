"""Label attachment and point-in-time lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import DIRECT_MAX_ROWS, Scan, _non_null_keys, dealt, key_sizes, keyed_scan

LABEL_HORIZON = "30 days"


def label_interval_join(events: DataFrame, labels: DataFrame,
                        horizon: str = LABEL_HORIZON) -> DataFrame:
    """Attach every label of the event's session that becomes available
    within ``[event time, event time + horizon]`` (both ends inclusive).

    Left outer: events without such a label are kept with NULL label
    columns. One event can match several labels (one row each). The session
    key is the equi-join key, so Catalyst plans a shuffle (or broadcast) hash
    / sort-merge join with the interval as a residual predicate; on a
    stream the same expression becomes a watermark-bounded symmetric join.
    Hot sessions are split by AQE's skew-join handling (left side of a
    left outer join is splittable).
    """
    ev = events.alias("ev")
    lb = labels.select("session_id", "will_abandon", "label_available_date").alias("lbl")
    cond = [
        F.col("ev.session_id") == F.col("lbl.session_id"),
        F.col("lbl.label_available_date") >= F.col("ev.event_timestamp"),
        F.col("lbl.label_available_date") <= F.col("ev.event_timestamp") + F.expr(f"INTERVAL {horizon}"),
    ]
    return (ev.join(lb, cond, "left")
              .select(F.col("ev.*"), F.col("lbl.will_abandon"), F.col("lbl.label_available_date")))


#: Width of a slice in days; a label meets events of as many slices as its horizon touches.
SLICE_DAYS = 30


def label_interval_join_sliced(events: DataFrame, labels: DataFrame, horizon_days: int = 30, slice_days: int = SLICE_DAYS) -> DataFrame:
    """The batch :func:`label_interval_join` for sessions of any size: joined on (session, time slice).

    An event lies in one slice. A label is copied to the slices of the events it can meet -- two, where a slice is as long
    as the horizon -- so every pair meets exactly once, and the events and the labels of one long session are both dealt out
    by slice. Skewed sessions inside one slice are left to AQE, which splits the events' side.
    """
    day = F.lit(86_400_000).cast("long")

    def slice_of(time: Column, back: int = 0) -> Column:
        return F.floor((F.unix_millis(time) - day * back) / (day * slice_days)).cast("long")

    lb = labels.select("session_id", "will_abandon", "label_available_date").withColumn(
        "_slice", F.explode(F.sequence(slice_of(F.col("label_available_date"), horizon_days), slice_of(F.col("label_available_date")))))
    ev = events.withColumn("_slice", slice_of(F.col("event_timestamp"))).alias("ev")
    lb = lb.alias("lbl")
    cond = [F.col("ev.session_id") == F.col("lbl.session_id"), F.col("ev._slice") == F.col("lbl._slice"),
            F.col("lbl.label_available_date") >= F.col("ev.event_timestamp"),
            F.col("lbl.label_available_date") <= F.col("ev.event_timestamp") + F.expr(f"INTERVAL {horizon_days} DAYS")]
    return ev.join(lb, cond, "left").select(*(F.col(f"ev.{c}") for c in events.columns), F.col("lbl.will_abandon"), F.col("lbl.label_available_date"))


def asof_lookup(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                value_cols: list[str], prefix: str = "",
                num_partitions: int | None = None,
                direct_max_rows: int = DIRECT_MAX_ROWS,
                sizes_hint: tuple[int, int] | None = None) -> DataFrame:
    """For every left row, the right row with the same key and the latest
    ``right_ts <= left_ts`` (NULLs when there is none). Left rows are kept
    one-for-one.

    Built as one skew-safe keyed scan over the union of both sides: a running
    max of the right times gives every left row the time of its hit, and an
    equi-join on (key, time) brings the values, so no wide row is compared or
    carried in the scan. Right rows that share key and time count as one, the
    greatest by ``value_cols``. No range join and no per-key collection, so a
    key holding a third of all rows is still spread over many tasks.
    ``sizes_hint``: proven bounds of the rows per key and of all rows over both
    sides (skips the plan choice's counting pass). The join is dealt out by the
    number of rows, too.
    """
    r = right.select(F.col(key).alias("_rkey"), F.unix_micros(F.col(right_ts)).alias("_at"),
                     F.struct(*[F.col(c) for c in value_cols]).alias("_val")).filter("_at IS NOT NULL")
    left_cols = left.columns
    lt = left.select(F.col(key).alias("_key"), F.unix_micros(F.col(left_ts)).alias("_pos"),
                     F.struct(*[F.col(c) for c in left_cols]).alias("_left"))
    u = lt.unionByName(r.select(F.col("_rkey").alias("_key"), F.col("_at").alias("_pos"), F.col("_at")), allowMissingColumns=True)
    top, rows = sizes_hint or key_sizes(u, ["_key"])
    scanned = keyed_scan(u, ["_key"], "_pos", [Scan("_hit", F.col("_at"), "max", "upto")],
                         num_partitions=num_partitions, direct_max_rows=direct_max_rows,
                         max_rows_hint=top, rows_hint=rows, keep=["_left"]).filter(F.col("_left").isNotNull())
    r, rkeys, _ = _non_null_keys(r, ["_rkey"], always=True)
    r = r.withColumnsRenamed({k: f"_r{k}" for k in rkeys})
    scanned, keys, _ = _non_null_keys(scanned, ["_key"], always=True)
    rkeys = [f"_r{k}" for k in rkeys]
    values = dealt(r, rows, [*rkeys, "_at"]).groupBy(*rkeys, "_at").agg(F.max("_val").alias("_val"))
    # rows without a hit look for their own time, which no right row of their key has: so they do not all meet in one task
    scanned = dealt(scanned.withColumn("_hit", F.coalesce("_hit", "_pos")), rows, [*keys, "_hit"])
    on = [F.col(a) == F.col(b) for a, b in zip([*keys, "_hit"], [*rkeys, "_at"], strict=True)]
    out = scanned.join(values, on, "left")
    return out.select(*[F.col(f"_left.{c}").alias(c) for c in left_cols],
                      *[F.col(f"_val.{c}").alias(prefix + c) for c in value_cols])


def version_lookup(left: DataFrame, history: DataFrame, key: str, ts: str, value_cols: list[str],
                   start: str = "__START_AT", end: str = "__END_AT", **options) -> DataFrame:
    """The SCD2 version valid at ``left.ts`` (``start <= ts < end``, open ends
    included), as an as-of lookup on the version's start: the versions of a key
    do not overlap, so the latest one that began is the valid one unless it
    has ended. Time linear in the rows, also for one hot key."""
    own = [c for c in left.columns]
    hit = asof_lookup(left, history, key, ts, start, [*value_cols, end], prefix="_v_", **options)
    valid = F.col(f"_v_{end}").isNull() | (F.col(ts) < F.col(f"_v_{end}"))
    return hit.select(*own, *(F.when(valid, F.col(f"_v_{c}")).alias(c) for c in value_cols))


def validity_join(left: DataFrame, history: DataFrame, key: str, ts: str,
                  start: str = "__START_AT", end: str = "__END_AT",
                  value_cols: list[str] | None = None, prefix: str = "") -> DataFrame:
    """Interval (SCD2) form of the point-in-time lookup:
    ``left.ts >= start AND (left.ts < end OR end IS NULL)``; left outer.
    Plain equi-join on the key with a residual range predicate; kept for
    small dimensions and as the oracle of :func:`asof_lookup`."""
    cols = value_cols or [c for c in history.columns if c not in (key,)]
    h = history.select(F.col(key).alias("_hk"), *[F.col(c).alias(prefix + c) for c in cols],
                       F.col(start).alias("_hs"), F.col(end).alias("_he"))
    cond = [(left[key] == h["_hk"]), (left[ts] >= h["_hs"]),
            (h["_he"].isNull() | (left[ts] < h["_he"]))]
    return left.join(h, cond, "left").drop("_hk", "_hs", "_he")
