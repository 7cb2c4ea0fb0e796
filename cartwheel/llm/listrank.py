"""Ranking of a linked list that is spread over tasks: for every element the total weight from it to the list's end.

The table is cut into chunks by id. Inside a chunk, runs of elements that follow each other are joined up by pointer
jumping over arrays; only the first element of each run goes on, as one element with the weight of its run. That shorter
list is ranked by pointer jumping over stored tables, and every element adds the rank of the run that follows its own.

Each chunk holds at most ``CHUNK`` elements whatever the table holds. A round of the jumping is one join on distinct
keys; a list of n runs takes log2(n) of them. Only whether a round was the last reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

CHUNK = 1 << 20


def runs_of(ids: np.ndarray, following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted ids of a chunk: the element after each one's run (-1 at the list's end), the weight from the element to
    the end of its run, and whether the element is the first of a run."""
    at = np.searchsorted(ids, following)
    at[at == len(ids)] = 0
    here = ids[at] == following
    first = np.ones(len(ids), dtype=bool)
    first[at[here]] = False
    jump = np.where(here, at, -1)
    after, weight = np.where(here, -1, following), weights.copy()
    while (live := np.flatnonzero(jump >= 0)).size:
        to = jump[live]
        weight[:, live] += weight[:, to]
        after[live], jump[live] = after[to], jump[to]
    return after, weight, first


def _chunks(names: list[str], most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def solved(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).sort_by("id")
        ids, following = (rows.column(c).to_numpy() for c in ("id", "next"))
        weights = np.stack([rows.column(c).to_numpy() for c in names])
        after, weight, first = runs_of(ids, following, weights)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, after, *weight, first)], ["id", "next", *names, "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if held and n + batch.num_rows > most:
                yield solved(held)
                held, n = [], 0
            held.append(batch)
            n += batch.num_rows
        if n:
            yield solved(held)

    return run


def ranked(elements: DataFrame, weights: list[str], chunk: int = CHUNK) -> DataFrame:
    """(id, *weights): each weight summed from the element to the end of its list, both included.

    ``elements``: ``id`` (long, distinct, not negative), ``next`` (the id that follows, -1 at the end) and long ``weights``.
    Several lists may stand side by side. Elements with near ids should be near in the list, which makes runs long; the
    result does not depend on it. No elements: no rows.
    """
    names = [f"_w{i}" for i in range(len(weights))]
    ddl = f"id long, next long, {', '.join(f'{n} long' for n in names)}, first boolean"
    rows = elements.select("id", "next", *(F.col(w).alias(n) for w, n in zip(weights, names, strict=True)))
    parts = stored(rows.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(_chunks(names, chunk), ddl), "list-runs")
    runs = stored(parts.where("first").drop("first"), "list-jump")
    while not runs.where("next >= 0").isEmpty():
        onward = runs.select(F.col("id").alias("next"), F.col("next").alias("then"), *(F.col(n).alias(f"then{n}") for n in names))
        moved = runs.where("next >= 0").join(onward, "next").select("id", F.col("then").alias("next"), *((F.col(n) + F.col(f"then{n}")).alias(n) for n in names))
        runs = stored(runs.where("next < 0").unionByName(moved), "list-jump")
    rest = runs.select(F.col("id").alias("next"), *(F.col(n).alias(f"rest{n}") for n in names))
    total = parts.join(rest, "next", "left")
    return total.select("id", *((F.col(n) + F.coalesce(f"rest{n}", F.lit(0))).alias(w) for w, n in zip(weights, names, strict=True)))
