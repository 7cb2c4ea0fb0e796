"""Expectations, quarantine routing and reconciliation.

All rules of a tag are evaluated in one projection; metrics are a single
aggregation (partial aggregation on every task, one tiny shuffle), so the
cost is one extra pass at most and nothing is pulled to the driver.

NULL handling (three-valued logic): the flag ``NOT (r1 AND r2 ...)`` is NULL
when no rule is definitely false and at least one rule is NULL. In
``on_null="reference"`` mode such a row is routed to neither branch (the
behaviour of the original pipeline, whose branches test ``= true`` and
``= false``); ``on_null="quarantine"`` (default) treats NULL as failed so
every input row lands in exactly one branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import rules_for
from ..functions.timestamps import as_instant

FLAG = "is_quarantined"
TAGS = ("customers", "transactions", "labels")
ON_NULL_MODES = ("quarantine", "reference")


def _rules(rules: dict[str, str] | str) -> dict[str, str]:
    return rules_for(rules) if isinstance(rules, str) else dict(rules)


def conjunction(rules: dict[str, str] | str) -> Column:
    """All rules AND-ed; each predicate is parenthesised so an ``OR`` inside
    one rule cannot re-associate with its neighbours."""
    preds = [F.expr(f"({p})") for p in _rules(rules).values()]
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def quarantine_flag(rules: dict[str, str] | str, on_null: str = "quarantine") -> Column:
    if on_null not in ON_NULL_MODES:
        raise ValueError(f"on_null must be one of {ON_NULL_MODES}")
    conj = conjunction(rules)
    if on_null == "reference":
        return ~conj
    return ~F.coalesce(conj, F.lit(False))


def evaluate(df: DataFrame, rules: dict[str, str] | str, on_null: str = "quarantine") -> DataFrame:
    """Add the ``is_quarantined`` routing flag."""
    return df.withColumn(FLAG, quarantine_flag(rules, on_null))


def quarantined(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col(FLAG) == F.lit(True)).drop(FLAG)


def clean(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col(FLAG) == F.lit(False)).drop(FLAG)


def split(df: DataFrame, rules: dict[str, str] | str, on_null: str = "quarantine"
          ) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantined)``. Without materialising the flag, each branch
    is its own filter over the source, so Catalyst pushes the rule predicate
    as far down as the source allows."""
    ev = evaluate(df, rules, on_null)
    return clean(ev), quarantined(ev)


def expectation_metrics(df: DataFrame, rules: dict[str, str] | str) -> DataFrame:
    """One row per rule: ``rule, passed, failed`` (a NULL outcome is failed).

    Warn-only: the input is not filtered. Computed as one aggregate over the
    data followed by an unpivot of its single row.
    """
    r = _rules(rules)
    aggs = []
    for i, pred in enumerate(r.values()):
        ok = F.coalesce(F.expr(f"({pred})"), F.lit(False))
        aggs.append(F.count_if(ok).alias(f"p{i}"))
        aggs.append(F.count_if(~ok).alias(f"f{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("rule"),
                              F.col(f"p{i}").alias("passed"),
                              F.col(f"f{i}").alias("failed"))
                     for i, name in enumerate(r)])
    return wide.select(F.inline(rows))


def observe_expectations(df: DataFrame, rules: dict[str, str] | str, name) -> DataFrame:
    """Warn-only metrics attached to the data flow itself: per-rule failure
    counts collected as the rows pass (no extra scan). ``name`` is a string
    for streams (reported per micro-batch in the query progress) or a
    ``pyspark.sql.Observation`` for batch frames."""
    r = _rules(rules)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for rule, pred in r.items():
        aggs.append(F.count_if(~F.coalesce(F.expr(f"({pred})"), F.lit(False))).alias(rule))
    return df.observe(name, *aggs)


def reconciliation(df: DataFrame, rules: dict[str, str] | str) -> DataFrame:
    """``rows_in, clean, quarantined, lost`` under reference routing, plus
    ``quarantined_null_safe`` (what default routing sends to quarantine)."""
    flag = quarantine_flag(rules, "reference")
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(flag == F.lit(False)).alias("clean"),
        F.count_if(flag == F.lit(True)).alias("quarantined"),
        F.count_if(flag.isNull()).alias("lost"),
        F.count_if(F.coalesce(flag, F.lit(True))).alias("quarantined_null_safe"),
    )


def impute_sequence(customers: DataFrame, seq: str = "user_updated_at",
                    fallback: str = "registration_date") -> DataFrame:
    """Fill a missing SCD2 sequence value from another date column (its UTC
    midnight, whatever the session time zone)."""
    midnight = as_instant(F.col(fallback).cast("timestamp_ntz"))
    return customers.withColumn(seq, F.coalesce(F.col(seq), midnight))


def write_routed(df: DataFrame, rules: dict[str, str] | str, path: str,
                 on_null: str = "quarantine", observation=None) -> tuple[DataFrame, DataFrame]:
    """Route in one pass: write ``df`` once, partitioned by ``is_quarantined``,
    and return ``(clean, quarantined)`` read back from the two partitions.

    ``observation`` (a ``pyspark.sql.Observation``) collects the per-rule
    failure counts during the same write. In ``reference`` mode the rows whose
    flag is NULL are not lost: they sit in the NULL partition of ``path``.
    """
    ev = evaluate(df, rules, on_null)
    if observation is not None:
        ev = observe_expectations(ev, rules, observation)
    spark = df.sparkSession
    # a task keeps a file open for each flag value (false, true, NULL), so it does not sort its whole split by the flag
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, max(3, int(before)))
    try:
        ev.write.mode("overwrite").partitionBy(FLAG).parquet(path)
    finally:
        spark.conf.set(name, before)
    stored = spark.read.schema(ev.schema).parquet(path)
    return clean(stored), quarantined(stored)
