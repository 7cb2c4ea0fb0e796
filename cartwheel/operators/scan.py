"""Skew-safe running aggregates per key (a distributed prefix scan).

``Window.partitionBy(key).orderBy(pos)`` sends every row of a key to one
task; when one key holds a third of the data, that task holds a third of
the data. ``keyed_scan`` computes the same running sum / max / min without
that:

1. ``repartitionByRange(keys, pos)``: Spark samples the composite key, so a
   hot key is cut into many contiguous, balanced range partitions, and
   ``spark_partition_id()`` numbers those pieces in (key, pos) order. The
   pieces are written once as a table in the shared checkpoint folder: two
   consumers of one lazy range exchange would each sample their own bounds,
   and the stored piece ids are also what makes recomputation after an
   executor loss consistent.
2. Local pass: a window over ``(piece, keys)`` -- each group is at most one
   range partition -- gives the running value inside the piece.
3. Carry pass, only for keys that lie in more than one piece (fewer than there
   are pieces): one row per ``(piece, keys)`` with the piece total (partial
   aggregation keeps this shuffle small); a window over those totals gives
   each piece the aggregate of all earlier (or later) pieces of its key.
4. Carries, at most a row or two per piece, are joined back on
   ``(piece, keys)`` -- the columns the local window is already
   hash-partitioned by, so the big side is not shuffled again.

Frames (relative to the current row's ``pos``; equal positions are peers):

- ``before``: rows with ``pos <`` current  (RANGE UNBOUNDED PRECEDING .. 1 PRECEDING)
- ``upto``:   rows with ``pos <=`` current
- ``from``:   rows with ``pos >=`` current
- ``after``:  rows with ``pos >`` current

Rows with equal ``(keys, pos)`` always share a range partition, so peer
semantics are exact. Sums never return NULL (empty frame -> 0); max/min
return NULL on an empty frame. ``pos`` must be a non-null integral column.

Plan choice: the busiest key's row count is measured first (one partially
aggregated pass, one number to the driver). Up to ``direct_max_rows`` rows a
key fits one task comfortably, so the direct plan -- one
``Window.partitionBy(keys)`` with running frames, O(n) -- is used; beyond
that (a hot key) the range-piece plan above. ``direct_max_rows=0`` forces
pieces.

Memory: rows are dealt out to tasks of about ``ROWS_PER_TASK`` rows, however
many that makes; ``spark.sql.shuffle.partitions`` is the least number. So what
a task sorts does not grow with the table, and nothing spills.

``block`` optionally sub-divides each key (e.g. a day number); it must be a
non-decreasing function of ``pos``. A scan with ``per_block=True`` restarts
at every block, the others run across blocks. Keep scanned values
fixed-width (long, double, timestamp) where possible: the carry aggregation
then runs as a hash aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..session import scratch_path

# Every frame is evaluated as a *running* frame (UNBOUNDED PRECEDING .. n),
# which Spark computes incrementally. Backward frames run over a descending
# order instead of using UNBOUNDED FOLLOWING, a frame Spark re-aggregates for
# every row (quadratic in the group size).
FRAMES = {
    "before": "BETWEEN UNBOUNDED PRECEDING AND 1L PRECEDING",
    "upto": "BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
    "from": "BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
    "after": "BETWEEN UNBOUNDED PRECEDING AND 1L PRECEDING",
}
FORWARD = ("before", "upto")
OPS = ("sum", "max", "min")
DIRECT_MAX_ROWS = 1_000_000
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class Scan:
    name: str
    value: Column
    op: str = "sum"
    frame: str = "before"
    per_block: bool = False

    def __post_init__(self):
        if self.op not in OPS:
            raise ValueError(f"op must be one of {sorted(OPS)}")
        if self.frame not in FRAMES:
            raise ValueError(f"frame must be one of {sorted(FRAMES)}")


def _non_null_keys(df: DataFrame, keys: list[str], always: bool = False) -> tuple[DataFrame, list[str], list[str]]:
    """Join-safe key columns: nullable keys become (is-null flag, filled value)
    so plain equality -- the same columns the local window partitions by --
    also matches NULL keys. ``always``: keys that cannot be NULL too."""
    cols, helpers = [], []
    for i, k in enumerate(keys):
        field = df.schema[k]
        if not field.nullable and not always:
            cols.append(k)
            continue
        if isinstance(field.dataType, StringType):
            filled = F.coalesce(F.col(k), F.lit(""))
        elif isinstance(field.dataType, NumericType):
            filled = F.coalesce(F.col(k), F.lit(0).cast(field.dataType))
        else:
            filled = F.coalesce(F.col(k).cast("string"), F.lit(""))
        df = df.withColumn(f"_kn{i}", F.col(k).isNull()).withColumn(f"_kv{i}", filled)
        cols += [f"_kn{i}", f"_kv{i}"]
        helpers += [f"_kn{i}", f"_kv{i}"]
    return df, cols, helpers


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows: the session's shuffle partitions, or more if a task got over ``ROWS_PER_TASK`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def dealt(df: DataFrame, rows: int, by: Sequence[str]) -> DataFrame:
    """``df`` (of about ``rows`` rows) dealt out by columns; AQE may join partitions of a small one."""
    spark = df.sparkSession
    n = task_count(spark, rows)
    return df.repartition(n, *by) if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*by)


def range_pieces(df: DataFrame, sort_cols: list[str], num_partitions: int | None = None,
                 purpose: str = "scan") -> DataFrame:
    """Range-partition ``df`` on ``sort_cols`` and store it with its piece id
    (``_pid``) in the shared folder; returns the stored table."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, purpose)
    (df.repartitionByRange(n, *sort_cols).withColumn("_pid", F.spark_partition_id())
       .write.mode("overwrite").parquet(path))
    return spark.read.parquet(path)


def key_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Row counts of the busiest key and of all: one partially aggregated pass, two numbers to the driver."""
    top, rows = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return int(top or 0), int(rows or 0)


def _q(name: str) -> str:
    return f"`{name}`"


def _finish(df: DataFrame, scans: list[Scan], drop: list[str], carried: bool) -> DataFrame:
    """Local value and carry put together. (Scans are many and wide: SQL text keeps building the plan cheap.)"""
    finals = []
    for i, s in enumerate(scans):
        if s.op == "sum":
            value = f"coalesce(_l{i}, 0) + coalesce(_o{i}, 0)" if carried else f"coalesce(_l{i}, 0)"
        else:
            value = f"{'greatest' if s.op == 'max' else 'least'}(_l{i}, _o{i})" if carried else f"_l{i}"
        finals.append(f"{value} AS {_q(s.name)}")
    gone = {"_blk", *drop} | {f"_{p}{i}" for i in range(len(scans)) for p in "vlo"} | {s.name for s in scans}
    return df.selectExpr(*(_q(c) for c in df.columns if c not in gone), *finals)


def _local_windows(df: DataFrame, part: list[str], pos: str, scans: list[Scan],
                   block_part: list[str], late: bool) -> DataFrame:
    """Running frames per group; per-block scans also restart at each block.

    Scans that share an order are one window, the window of most scans last.
    ``late`` computes each window's values after its sort, so that all sort
    narrow rows.
    """
    windows: dict[tuple, list[int]] = {}
    for i, s in enumerate(scans):
        windows.setdefault((s.per_block, s.frame in FORWARD), []).append(i)
    for (per_block, forward), members in sorted(windows.items(), key=lambda w: len(w[1])):
        group = block_part if per_block else part
        if late:
            df = df.sortWithinPartitions(*(F.col(_q(c)) for c in group), F.col(_q(pos)).asc() if forward else F.col(_q(pos)).desc())
            df = df.withColumns({f"_v{i}": scans[i].value for i in members})
        keys = ", ".join(map(_q, group))
        over = f"OVER (PARTITION BY {keys} ORDER BY {_q(pos)} {'ASC' if forward else 'DESC'} RANGE"
        kept = [_q(c) for c in df.columns if not late or c not in {f"_v{i}" for i in members}]
        df = df.selectExpr(*kept, *(f"{scans[i].op}(_v{i}) {over} {FRAMES[scans[i].frame]}) AS _l{i}" for i in members))
    return df


def keyed_scan(df: DataFrame, keys: list[str], pos: str, scans: list[Scan],
               num_partitions: int | None = None, block: Column | None = None,
               direct_max_rows: int = DIRECT_MAX_ROWS,
               max_rows_hint: int | None = None, keep: list[str] | None = None,
               inputs: list[str] | None = None, rows_hint: int | None = None,
               expand: list[str] | None = None) -> DataFrame:
    """Add one column per :class:`Scan` holding its running aggregate.

    ``keep``: the columns besides keys and ``pos`` that the result needs
    (default all); the others are dropped before any sort.
    ``inputs``: the columns that the scans' values are made of. If given, these
    are what is sorted and stored, and the values are made after that; good
    for many scans over few columns.
    ``expand``: SQL of more columns, ``inline(...)`` among them if a row of
    ``df`` stands for several; made after the rows were dealt out by key, so
    that few are shuffled (``pos`` may be one of them).

    Eager: the plan choice runs one aggregation (skipped when the caller
    passes ``max_rows_hint``, a proven upper bound of the busiest key's row
    count, and ``rows_hint``, one of all rows), and the range-piece plan stores
    its pieces before the (lazy) result is returned.
    """
    d, kcols, helpers = _non_null_keys(df, keys)
    values = {f"_v{i}": s.value for i, s in enumerate(scans)}
    late = inputs is not None
    sources = [c for c in (inputs if late else values) if c not in {*keys, pos, *(keep or ())}] if keep is not None else []
    own = helpers

    def rows_of(d: DataFrame) -> DataFrame:
        if expand is not None:
            d = d.selectExpr("*", *expand)
        d = d.withColumn("_blk", (block if block is not None else F.lit(0)).cast("long"))
        if not late:
            d = d.withColumns(values)
        return d if keep is None else d.select(*keys, *own, pos, *keep, *sources, "_blk")

    helpers = helpers + (sources if late else [])
    if rows_hint is None or (max_rows_hint is None and direct_max_rows > 0):
        max_rows_hint, rows_hint = key_sizes(rows_of(d), kcols)
    if direct_max_rows > 0 and max_rows_hint <= direct_max_rows:
        d = rows_of(dealt(d, rows_hint, kcols))
        return _finish(_local_windows(d, kcols, pos, scans, [*kcols, "_blk"], late), scans, helpers, False)
    n = num_partitions or task_count(df.sparkSession, rows_hint)
    if expand is not None:
        d = dealt(d, rows_hint, d.columns)      # no task makes many rows of its few
    pieces = range_pieces(rows_of(d), [*kcols, pos], n)
    part = ["_pid", *kcols]
    local = _local_windows(dealt(pieces, rows_hint, part), part, pos, scans, [*part, "_blk"], late)

    # each end of a piece can lie inside a key, so fewer keys than pieces need what other pieces hold
    cut = pieces.groupBy(*kcols).agg(F.min("_pid").alias("_lo"), F.max("_pid").alias("_hi")).filter("_lo < _hi").select(*kcols).collect()
    if not cut:
        return _finish(local, scans, [*helpers, "_pid"], False)
    shared = pieces
    for c in kcols:
        shared = shared.filter(F.col(c).isin(list({r[c] for r in cut})))

    def carry(i: int, group: list[str]) -> str:
        # all earlier (forward) or later (backward) pieces of the key -- or of the key's block -- as a running frame
        order = "ASC" if scans[i].frame in FORWARD else "DESC"
        return (f"{scans[i].op}(_t{i}) OVER (PARTITION BY {', '.join(map(_q, group))} ORDER BY _pid {order} "
                f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _o{i}")

    block_scans = [i for i, s in enumerate(scans) if s.per_block]
    plain = [i for i, s in enumerate(scans) if not s.per_block]
    totals = (shared.withColumns(values) if late else shared).groupBy(*part, "_blk").agg(*[F.expr(f"{s.op}(_v{i}) AS _t{i}") for i, s in enumerate(scans)])
    totals = totals.selectExpr(*map(_q, part), "_blk", *(f"_t{i}" for i in plain), *(carry(i, [*kcols, "_blk"]) for i in block_scans))
    # a key's rows in a piece share only their first block with earlier pieces and only their last with later ones
    totals = totals.groupBy(*part).agg(F.min("_blk").alias("_first_blk"), F.max("_blk").alias("_last_blk"),
                                       *[F.expr(f"{scans[i].op}(_t{i}) AS _t{i}") for i in plain], *[F.max(f"_o{i}").alias(f"_o{i}") for i in block_scans])
    carries = totals.selectExpr(*map(_q, part), "_first_blk", "_last_blk", *(f"_o{i}" for i in block_scans), *(carry(i, kcols) for i in plain))
    joined = local.join(carries, on=part, how="left")
    ends = {i: "_first_blk" if scans[i].frame in FORWARD else "_last_blk" for i in block_scans}
    joined = joined.withColumns({f"_o{i}": F.expr(f"CASE WHEN _blk = {end} THEN _o{i} END") for i, end in ends.items()}) if ends else joined
    return _finish(joined, scans, [*helpers, "_pid", "_first_blk", "_last_blk"], True)
