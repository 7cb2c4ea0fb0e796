"""Serving-side operators: latest row per key, row-level change feed,
constraint audits and declared-schema conformance.

All are single aggregations or one join on the table's key, so they scale
with partial aggregation and hash partitioning; nothing is collected.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHANGE_TYPE = "_change_type"
INSERT, DELETE = "insert", "delete"
PRE, POST = "update_preimage", "update_postimage"


def latest_per_key(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The newest row of every key (ties: the greatest row), for online serving.

    A max over ``struct(ts, row)`` per key: a partially aggregated
    ``groupBy``, so a hot key costs one partial row per task, not one task.
    """
    others = [c for c in df.columns if c not in set(keys) | {ts}]
    best = F.max(F.struct(F.col(ts), *[F.col(c) for c in others])).alias("_best")
    return (df.groupBy(*keys).agg(best)
              .select(*keys, F.col(f"_best.{ts}").alias(ts),
                      *[F.col(f"_best.{c}").alias(c) for c in others])
              .select(*df.columns))


COPIES = "_copies"


def net_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows that occur more or less often in ``after`` than in ``before``, with the difference as ``_copies``.

    Both sides are counted in one aggregation over whole rows, in which null equals null. Unchanged rows cancel out, so a
    key that repeats any number of times costs one row per distinct content.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("before and after must have the same columns")
    return compacted(before.select(*after.columns, F.lit(-1).cast("long").alias(COPIES))
                     .union(after.withColumn(COPIES, F.lit(1).cast("long"))))


def compacted(net: DataFrame) -> DataFrame:
    """Add up ``_copies`` per row; rows that cancel out go."""
    rows = [c for c in net.columns if c != COPIES]
    return net.groupBy(*rows).agg(F.sum(COPIES).alias(COPIES)).filter(F.col(COPIES) != 0)


def no_net_rows(table: DataFrame) -> DataFrame:
    return table.withColumn(COPIES, F.lit(0).cast("long")).limit(0)


def expanded(net: DataFrame) -> DataFrame:
    """Net rows that came, one row per copy."""
    return net.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), COPIES))).drop(COPIES)


def feed_of(net: DataFrame, keys: list[str]) -> DataFrame:
    """The change feed of net rows: within a key, the rows that went and those that came are paired in the order of
    their content (null first) as pre- and postimage of an update; what is left over is deleted or inserted.

    The one shuffle by key holds changed rows only. Rows of one key are ranked in one task, sorted with spill.
    """
    cols = [c for c in net.columns if c not in keys and c != COPIES]
    rows = (net.withColumn("_came", F.col(COPIES) > 0).withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), F.abs(COPIES))))
               .repartition(*keys))
    # an image has a partner if the other side of its key has as many rows as its rank
    key = Window.partitionBy(*keys)
    rank = F.row_number().over(Window.partitionBy(*keys, "_came").orderBy(*(F.asc_nulls_first(c) for c in cols)))
    ranked = rows.withColumn("_rank", rank).withColumns({"_in": F.count_if("_came").over(key), "_out": F.count_if(~F.col("_came")).over(key)})
    kind = (F.when(F.col("_came"), F.when(F.col("_rank") <= F.col("_out"), POST).otherwise(INSERT))
             .otherwise(F.when(F.col("_rank") <= F.col("_in"), PRE).otherwise(DELETE)))
    return ranked.select(*keys, *cols, kind.alias(CHANGE_TYPE))


def change_feed(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level changes from ``before`` to ``after`` keyed by ``keys``.

    ``_change_type`` is ``insert`` / ``delete`` / ``update_preimage`` /
    ``update_postimage`` (an update yields both images); unchanged rows are
    omitted. Keys and values compare null-safely; rows that share a key are
    taken as a multiset, so equal tables give no change whatever they hold.
    """
    return feed_of(net_rows(before, after), keys)


def primary_key_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") > 1))


def not_null_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, null_rows`` for each column declared NOT NULL (one pass)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_rows"))
                     for i, c in enumerate(columns)])
    return wide.select(F.inline(rows))


class ConstraintViolation(ValueError):
    pass


def require_primary_key(df: DataFrame, keys: list[str]) -> None:
    """Raise :class:`ConstraintViolation` if a key repeats or holds a null; one pass, at most five keys reach the driver."""
    null = reduce(or_, (F.col(k).isNull() for k in keys))
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter((F.col("occurrences") > 1) | null).limit(5).collect()
    if bad:
        raise ConstraintViolation(f"primary key {keys} is violated, for example by {[tuple(r) for r in bad]}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: declared order and types (cast),
    extra columns dropped; a missing column raises. NOT NULL declarations are
    checked separately with :func:`not_null_check` (a cast cannot enforce them)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ConstraintViolation(f"missing declared columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def enforce_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the write (at execution time, per task) on a NULL in a NOT NULL
    column, the way a table constraint rejects it; otherwise pass rows through."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    msg = F.lit(f"NOT NULL constraint violated on one of {columns}")
    # a filter (not a dropped helper column, which column pruning would remove)
    return df.filter(F.when(cond, F.raise_error(msg)).otherwise(F.lit(True)))
