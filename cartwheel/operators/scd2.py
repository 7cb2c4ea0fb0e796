"""Slowly changing dimension, type 2, derived from a change log.

Input: every observed record of every key (snapshots, re-deliveries, late
arrivals, in any order). Output: one row per (key, version) with
``__START_AT`` (the version's sequence value) and ``__END_AT`` (the next
version's start; NULL for the open version). Because history is recomputed
from the log, out-of-order arrivals re-stitch their neighbours and
re-ingesting a file never creates a version.

Plan: one aggregation collapses equal (key, sequence) records (partial
aggregation, skew-safe); ``__END_AT`` is a skew-safe keyed scan ("min of the
later sequences") rather than ``lead`` over a per-key window, so a key with
millions of versions is not one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import DIRECT_MAX_ROWS, Scan, keyed_scan

START, END = "__START_AT", "__END_AT"


def scd2_history(changes: DataFrame, keys: list[str], sequence_by: str,
                 except_columns: list[str] | tuple[str, ...] = (),
                 tie_breaker: str | None = None, collapse_unchanged: bool = False,
                 num_partitions: int | None = None,
                 direct_max_rows: int = DIRECT_MAX_ROWS) -> DataFrame:
    """Versioned history.

    - ``except_columns`` are dropped before anything else (lineage columns
      must not make versions).
    - Records sharing ``(keys, sequence_by)`` collapse to one: the highest
      ``tie_breaker`` wins, remaining ties go to the greatest row, so the
      result does not depend on arrival order.
    - ``collapse_unchanged``: a version whose payload equals the previous
      version's is folded into it (only the sequence changed).
    - Records without a sequence value cannot be placed and are skipped
      (the ``valid_update_date`` rule quarantines them upstream).
    """
    cols = [c for c in changes.columns if c not in set(except_columns)]
    payload = [c for c in cols if c not in set(keys) | {sequence_by}]
    src = changes.select(*cols).filter(F.col(sequence_by).isNotNull())
    rank = F.struct(*([F.col(tie_breaker)] if tie_breaker else []), *[F.col(c) for c in payload])
    dedup = (src.groupBy(*keys, sequence_by)
                .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), rank).alias("_p"))
                .select(*keys, sequence_by, *[F.col(f"_p.{c}").alias(c) for c in payload])
                .withColumn("_pos", F.unix_micros(F.col(sequence_by))))
    if collapse_unchanged:
        compare = [c for c in payload if c != tie_breaker]
        body = F.struct(*[F.col(c) for c in compare])
        dedup = keyed_scan(dedup, keys, "_pos",
                           [Scan("_prev", F.struct(F.col("_pos").alias("p"), body.alias("b")),
                                 "max", "before")],
                           num_partitions=num_partitions, direct_max_rows=direct_max_rows)
        dedup = (dedup.filter(F.col("_prev").isNull() | ~F.col("_prev.b").eqNullSafe(body))
                      .drop("_prev"))
    hist = keyed_scan(dedup, keys, "_pos",
                      [Scan(END, F.col(sequence_by), "min", "after")],
                      num_partitions=num_partitions, direct_max_rows=direct_max_rows)
    return hist.select(*keys, sequence_by, *payload,
                       F.col(sequence_by).alias(START), F.col(END))


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions only (one per key)."""
    return history.filter(F.col(END).isNull())


def as_of(history: DataFrame, ts) -> DataFrame:
    """The version of every key valid at one instant (a datetime, or text
    read as UTC wall clock)."""
    from ..functions.timestamps import as_instant
    t = as_instant(F.lit(ts).cast("timestamp_ntz")) if isinstance(ts, str) else F.lit(ts)
    return history.filter((F.col(START) <= t) & (F.col(END).isNull() | (F.col(END) > t)))


def scd2_merge(history: DataFrame, changes: DataFrame, keys: list[str], sequence_by: str,
               except_columns: list[str] | tuple[str, ...] = (),
               tie_breaker: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Apply a batch of changes to an existing (uncollapsed) history.

    Only keys present in ``changes`` are rebuilt -- from their stored
    versions plus the new records -- and the other keys' versions pass
    through untouched. Versions carry their full payload (including the
    tie-breaker), so the result equals :func:`scd2_history` over the whole
    change log. Two joins on the key against the distinct touched keys
    (semi/anti), no per-key collection.
    """
    cols = [c for c in changes.columns if c not in set(except_columns)]
    touched = changes.select(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys))).distinct()
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)))
    stored = history.drop(START, END)
    affected = stored.join(touched, same, "left_semi")
    untouched = history.join(touched, same, "left_anti")
    rebuilt = scd2_history(affected.select(*cols).unionByName(changes.select(*cols)), keys,
                           sequence_by, tie_breaker=tie_breaker, num_partitions=num_partitions)
    return untouched.unionByName(rebuilt.select(*history.columns))
