"""Helpers shared by the operators: row keys, stored tables and Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import scratch_path

#: Bytes of text that one vectorised step takes at most (a longer text is a step of its own).
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lowest(rows: DataFrame, by: Column, most: int) -> DataFrame:
    """The ``most`` rows with the lowest hash ``by``, and that hash as ``_at``. Of many rows only those below a share of the
    hash range that holds twice as many on average are sorted, so that what one task sorts is bounded too."""
    out = rows.withColumn("_at", by.bitwiseAND(F.lit((1 << 53) - 1)))
    n = rows.count()
    if n > 2 * most:
        out = out.where(F.col("_at") < int((1 << 53) * 2 * most / n))
    return out.orderBy("_at").limit(most)


def lowest_texts(texts: DataFrame, most: int) -> DataFrame:
    """The ``most`` distinct texts (column ``text``) with the lowest hash. Copies count once, by their hashes, before the
    share of the hash range is chosen as in ``lowest``; at most about twice ``most`` texts are held and sorted."""
    out = texts.select("text", F.xxhash64("text").bitwiseAND(F.lit((1 << 53) - 1)).alias("_at"))
    n = out.select("_at").distinct().count()
    if n > 2 * most:
        out = out.where(F.col("_at") < int((1 << 53) * 2 * most / n))
    return out.distinct().orderBy("_at", "text").limit(most).select("text")


def absent(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, kind: str = "left_anti") -> DataFrame:
    """``docs`` without (or, by ``left_semi``, only) the rows whose ``row_key`` is in ``keys`` (k1, k2). Columns stay as they are."""
    names = [absent(docs, "_k1"), absent(docs, "_k2")]
    marked = docs.withColumns(dict(zip(names, row_key(id_col, text_or_empty(text_col)), strict=True)))
    return marked.join(keys.select(*(F.col(k).alias(n) for k, n in zip(("k1", "k2"), names, strict=True))), names, kind).select(*(F.col(f"`{c}`") for c in docs.columns))


def row_key(id_col: str, text: Column) -> list[Column]:
    """Two hash columns that name a row by its id and text. They are never null; rows that agree in both id and
    text share a key and get the same result, so ids may be null or repeated."""
    return [F.xxhash64(F.col(id_col), text).alias("k1"), F.xxhash64(F.lit(7), text, F.col(id_col)).alias("k2")]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array without nulls, and the n + 1 offsets of its values."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None and len(ends) else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``most`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def words_flat(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends in ``raw``, split at ASCII white space and text ends, and each text's first word."""
    solid = (raw != 32) & ((raw < 9) | (raw > 13))
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    if len(raw):
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(raw))]
        before[inner] = False
        after[inner - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)
