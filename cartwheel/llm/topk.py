"""Exact top-k inner-product search by distributed histogram selection.

Vectors become integers, ``floor(SCALE * x)`` with x as double, and are packed into blocks of at most ``BLOCK_ROWS`` rows
and about ``BLOCK_BYTES``; the query vectors are packed once more into blocks of their own. Every pair of a candidate block
and a query block is one row, so work is dealt out evenly whatever the vectors are, and each task holds one pair at a time.

1. Each round scores all pairs and counts, per query, scores in ``2 ** BITS`` equal buckets of the query's current interval.
   A pair reports buckets from the highest down to its own k-th best score: lower ones cannot hold the k-th of all. The
   counts are added up over all pairs, and the bucket that holds the k-th best score is the next interval. The first
   interval holds every possible score (product of the largest norms); after a few rounds it is one value, the k-th score.
2. A last pass keeps the scores at or above that value. Where more than k of a pair are left, they tie at the k-th value
   and the pair passes on the k that rank first, so a vector with any number of copies costs k rows a pair and query.
3. Ranks go by score, then smaller id (null ids last), then place in the table.

Nothing but counts and the largest norm reaches the driver. A pair needs about
``8 * BLOCK_ROWS * QUERY_ROWS`` bytes a few times over (100 MB), the state of a query is one interval.

Defined results: null vectors, and vectors holding a null, NaN or infinite component, take no part, neither as query nor
as candidate. Vectors of different lengths are compared as if the shorter ended in zeros; an empty vector scores 0 with all.
Rows that repeat an id or a whole row are rows of their own: each is a candidate of the others, and a query that is
repeated gives its rows again. A null id is no query, but a candidate. Components beyond 64 bits count as the largest
64-bit number, and so do scores; sums in between are exact at any size. Fewer than k candidates: all of them. An empty
table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

SCALE = 1024
BLOCK_ROWS = 4096
BLOCK_BYTES = 2 << 20
QUERY_ROWS = 512
#: Bits of the score that one round settles.
BITS = 12
#: Candidate blocks that share one copy of the query blocks (fewer where the cluster has more cores than that fills).
SLOT_BLOCKS = 16
_TOP = np.uint64(1 << 63)
_FEW = 2.0**53

BLOCK = "block long, n int, dim int, ids binary, known binary, asked binary, queries int, mat binary, norm double, peak double"
QUERY_ROW = "own_block long, own_at int, query_id long, dim int, vector binary"
QUERY_BLOCK = "qblock long, n int, qdim int, own_block binary, own_at binary, query_ids binary, qmat binary, qpeak double"


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as 64-bit integers; beyond them the nearest one."""
    with np.errstate(over="ignore"):
        v = np.floor(values.astype(np.float64) * SCALE)
    edge = 2.0**63
    out = np.where(np.abs(v) < edge, v, 0).astype(np.int64)
    out[v >= edge] = np.iinfo(np.int64).max
    out[v <= -edge] = np.iinfo(np.int64).min
    return out


def _cuts(lengths: np.ndarray, most_rows: int) -> Iterator[tuple[int, int]]:
    """Bounds of blocks: at most ``most_rows`` rows, and with all rows as long as the longest about BLOCK_BYTES."""
    start, longest = 0, 0
    for i, n in enumerate(lengths.tolist()):
        longest = max(longest, n)
        if i > start and (i - start >= most_rows or (i - start + 1) * longest * 8 > BLOCK_BYTES):
            yield start, i
            start, longest = i, n
    if len(lengths) > start:
        yield start, len(lengths)


def _matrix(flat: np.ndarray, offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """Rows a..b of a ragged array, filled up with zeros."""
    lengths = np.diff(offsets[a : b + 1])
    out = np.zeros((b - a, int(lengths.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat[offsets[a] : offsets[b]]
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        vectors = batch.column("vector")
        offsets = np.asarray(vectors.offsets, dtype=np.int64)
        flat = whole_numbers(np.asarray(vectors.values))
        known = np.asarray(batch.column("id").is_valid())
        ids = np.asarray(batch.column("id").fill_null(0), dtype=np.int64)
        asked = np.asarray(batch.column("asked"), dtype=bool)
        rows = []
        for a, b in _cuts(np.diff(offsets), BLOCK_ROWS):
            mat = _matrix(flat, offsets, a, b)
            peak = float(np.abs(mat.astype(np.float64)).max(initial=0.0))
            norm = float(np.sqrt((mat.astype(np.float64) ** 2).sum(axis=1)).max(initial=0.0))
            rows.append((task + made, b - a, mat.shape[1], ids[a:b].tobytes(), known[a:b].tobytes(), asked[a:b].tobytes(),
                         int(asked[a:b].sum()), mat.tobytes(), norm, peak))
            made += 1
        if rows:
            yield _batch(rows, BLOCK)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in ddl.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(r["asked"], dtype=bool))
            ids, mat = np.frombuffer(r["ids"], dtype=np.int64), _mat(r["mat"], r["n"], r["dim"])
            rows = [(r["block"], int(i), int(ids[i]), r["dim"], mat[i].tobytes()) for i in at]
            if rows:
                yield _batch(rows, QUERY_ROW)


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        dims = np.asarray(batch.column("dim"), dtype=np.int64)
        own_block, own_at, ids = (np.asarray(batch.column(c), dtype=np.int64) for c in ("own_block", "own_at", "query_id"))
        vectors, offsets, rows = batch.column("vector").to_pylist(), np.append(0, np.cumsum(dims)), []
        for a, b in _cuts(dims, QUERY_ROWS):
            mat = _matrix(np.frombuffer(b"".join(vectors[a:b]), dtype=np.int64), offsets[a : b + 1] - offsets[a], 0, b - a)
            peak = float(np.abs(mat.astype(np.float64)).max(initial=0.0))
            rows.append((task + made, b - a, mat.shape[1], own_block[a:b].tobytes(), own_at[a:b].tobytes(), ids[a:b].tobytes(), mat.tobytes(), peak))
            made += 1
        if rows:
            yield _batch(rows, QUERY_BLOCK)


def _mat(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int64).reshape(n, dim)


def scores(queries: np.ndarray, candidates: np.ndarray, peaks: float) -> np.ndarray:
    """All inner products as 64-bit integers. ``peaks``: product of the largest components. Products that doubles hold
    exactly go through the matrix product of doubles, others through whole numbers of any length."""
    d = min(queries.shape[1], candidates.shape[1])
    a, b = queries[:, :d], candidates[:, :d]
    if peaks * d < _FEW:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    got = a.astype(object) @ b.astype(object).T if d else np.zeros((len(a), len(b)), dtype=object)
    return np.clip(got, np.iinfo(np.int64).min, np.iinfo(np.int64).max).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Each pair with its scores and the mask of those that count: all but the query's own row."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            s = scores(_mat(r["qmat"], r["qn"], r["qdim"]), _mat(r["mat"], r["n"], r["dim"]), r["peak"] * r["qpeak"])
            counts = np.ones(s.shape, dtype=bool)
            own = np.frombuffer(r["own_block"], dtype=np.int64) == r["block"]
            counts[own, np.frombuffer(r["own_at"], dtype=np.int64)[own]] = False
            yield r, s, counts


def _above(s: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each score from its query's lower bound (unsigned), and whether it is at or above it."""
    return s.view(np.uint64) - low.view(np.uint64)[:, None], s >= low[:, None]


def _histogram(bits: int, shift: int, k: int):
    buckets = 1 << (bits - shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, s, counts in _pairs(batches):
            far, counted = _above(s, np.array(r["low"], dtype=np.int64))
            counted &= counts
            if bits < 64:
                counted &= far >> np.uint64(bits) == 0
            at, col = np.nonzero(counted)
            flat = np.bincount(at * buckets + (far[at, col] >> np.uint64(shift)).astype(np.int64), minlength=r["qn"] * buckets)
            hist = flat.reshape(r["qn"], buckets)
            higher = hist[:, ::-1].cumsum(axis=1)[:, ::-1] - hist
            at, bucket = np.nonzero((hist > 0) & (higher < k))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r["qblock"])), pa.array(at.astype(np.int32)), pa.array(bucket.astype(np.int64)), pa.array(hist[at, bucket].astype(np.int64))], ["qblock", "at", "bucket", "n"])

    return run


RANKED = "qblock long, at int, query_id long, vec_id long, score long, block long, place int"


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, s, counts in _pairs(batches):
            at, col = np.nonzero(counts & (s >= np.array(r["low"], dtype=np.int64)[:, None]))
            ids, known = np.frombuffer(r["ids"], dtype=np.int64)[col], np.frombuffer(r["known"], dtype=bool)[col]
            got = s[at, col]
            order = np.lexsort((col, ids, ~known, ~got, at))  # ~x turns 64-bit order round without overflow
            at, col, ids, known, got = (x[order] for x in (at, col, ids, known, got))
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            at, col, ids, known, got = (x[rank < k] for x in (at, col, ids, known, got))
            asked = np.frombuffer(r["query_ids"], dtype=np.int64)[at]
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), r["qblock"])), pa.array(at.astype(np.int32)), pa.array(asked), pa.array(ids, mask=~known),
                     pa.array(got), pa.array(np.full(len(at), r["block"])), pa.array(col.astype(np.int32))],
                    ["qblock", "at", "query_id", "vec_id", "score", "block", "place"])

    return run


def _usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def exact_top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", asked: Column | None = None, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest score for every row that satisfies ``asked`` (default: id
    divisible by 100), among all other rows of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                          (F.col(id_col) % 100 == 0 if asked is None else asked).alias("asked")).where(_usable(F.col("vector")))
    rows = rows.withColumn("asked", F.coalesce("asked", F.lit(False)) & F.col("id").isNotNull())
    blocks = stored(rows.mapInArrow(_blocks, BLOCK), "topk-blocks")
    n_blocks, n_queries, norm = blocks.agg(F.count("*"), F.sum("queries"), F.max("norm")).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    packed = (blocks.where("queries > 0").select("block", "n", "dim", "ids", "asked", "mat").mapInArrow(_query_rows, QUERY_ROW)
              .repartition(-(-n_queries // QUERY_ROWS)).mapInArrow(_query_blocks, QUERY_BLOCK))
    queries = stored(packed, "topk-queries")

    bits = min(64, int(min(norm * norm * 1.001 + 1, 2.0**63)).bit_length() + 1)
    low = -(1 << (bits - 1))
    slots = max(-(-n_blocks // SLOT_BLOCKS), min(n_blocks, 2 * spark.sparkContext.defaultParallelism))
    dealt = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)))

    def pairs(state: DataFrame) -> DataFrame:
        lows = state.groupBy("qblock").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "low"))), lambda x: x["low"]).alias("low"))
        asking = queries.withColumnRenamed("n", "qn").join(lows, "qblock").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<long>")))
        return dealt.drop("asked", "queries", "norm").join(asking, "slot")

    state = queries.select("qblock", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at"), F.lit(low).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))
    while bits > 0:
        shift = max(bits - BITS, 0)
        counted = pairs(state).mapInArrow(_histogram(bits, shift, k), "qblock long, at int, bucket long, n long")
        counted = counted.groupBy("qblock", "at", "bucket").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("qblock", "at").orderBy(F.desc("bucket"))
        counted = counted.withColumn("upto", F.sum("n").over(down))
        held = state.join(counted, ["qblock", "at"]).where("upto >= need and upto - n < need")
        moved = F.col("low").cast("decimal(20)") + F.col("bucket").cast("decimal(18)") * F.expr(f"cast({1 << shift} as decimal(19))")  # may pass 64 bits on the way
        held = held.select("qblock", "at", moved.cast("long").alias("low_"), (F.col("need") - F.col("upto") + F.col("n")).alias("need_"))
        # a query with fewer than k candidates keeps the lower bound of its interval
        state = stored(state.join(held, ["qblock", "at"], "left").select("qblock", "at", F.coalesce("low_", "low").alias("low"), F.coalesce("need_", "need").alias("need")), "topk-state")
        bits = shift
    found = pairs(state).mapInArrow(_best(k), RANKED)
    order = Window.partitionBy("qblock", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "block", "place")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
