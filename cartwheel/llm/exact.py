"""Exact dedup by progressive refinement, with DataFrame functions only.

Texts are equal when they are identical after every ASCII white-space character is deleted. Rows are grouped by the
length of that normal form, those that share a length by the hash of its first ``PREFIX`` characters, and only rows
that share both have their whole content hashed (SHA-256) and compared. Each level is a pre-aggregated count over
narrow rows, so a group of copies that holds a third of all rows is one row per task after the partial count; the
counts are stored, so the joins back deal out both sides and can split a hot group.

Of equal texts the row with the most code points in its original text stays, then the one with the smallest id (a null
id counts as the largest), then any one of fully repeated rows.

Defined results: null counts as empty, and empty texts are copies of each other; extra columns are kept by
``drop_copies`` and ignored by ``exact_groups``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import absent, row_key, stored, text_or_empty, without_rows

PREFIX = 64
WHITE = "[\\x20\\x09-\\x0D]+"


def normal_form(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, "")


def _shaped(docs: DataFrame, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    norm = normal_form(text)
    return docs.select("*", F.length(text).alias("_chars"), F.length(norm).alias("_size"), F.xxhash64(F.substring(norm, 1, PREFIX)).alias("_head"), norm.alias("_norm"))


def _surviving_heads(shaped: DataFrame) -> DataFrame:
    """(size, head) pairs that more than one row has; heads are counted only among lengths that occur again."""
    narrow = shaped.select("_size", "_head")
    sizes = narrow.groupBy("_size").agg(F.count("*").alias("n")).where("n > 1").select("_size")
    heads = narrow.join(sizes, "_size", "left_semi").groupBy("_size", "_head").agg(F.count("*").alias("n")).where("n > 1")
    return stored(heads.select("_size", "_head", F.lit(True).alias("_again")), "exact-heads")


def _tagged(docs: DataFrame, id_col: str, text_col: str, hash_all: bool) -> DataFrame:
    """Narrow rows with the full hash where length and prefix survive (or of all rows, if it is asked for), stored."""
    shaped = _shaped(docs.select(id_col, text_col), text_col)
    found = shaped.join(_surviving_heads(shaped), ["_size", "_head"], "left")
    sha = F.sha2(F.col("_norm"), 256)
    rows = found.select(
        F.col(id_col).alias("_id"), *row_key(id_col, text_or_empty(text_col)), "_chars", "_size", "_head", F.col("_again").isNotNull().alias("_again"),
        (sha if hash_all else F.when(F.col("_again"), sha)).alias("_sha"), F.monotonically_increasing_id().alias("_row"),
    )
    return stored(rows, "exact-rows")


def _decided(rows: DataFrame) -> DataFrame:
    """Rows with keep_id, group_size and kept."""
    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("z"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    groups = rows.where("_again").groupBy("_size", "_head", "_sha").agg(F.count("*").alias("_n"), best.alias("_best"))
    groups = stored(groups.where("_n > 1"), "exact-groups")
    out = rows.join(groups, ["_size", "_head", "_sha"], "left")
    alone = F.col("_best").isNull()
    return out.select(
        "_id", "k1", "k2", F.when(alone, F.col("_id")).otherwise(F.col("_best.id")).alias("keep_id"), F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_best.row"))).alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (null for rows that never needed it if not ``hash_all``)."""
    return _decided(_tagged(docs, id_col, text_col, hash_all)).select(F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row left of every group of equal texts, all columns unchanged."""
    decided = _decided(_tagged(docs, id_col, text_col, hash_all=False))
    verdicts = decided.where("group_size > 1").groupBy("k1", "k2").agg(F.max("kept").alias("_keep"), F.count("*").alias("_same"))
    verdicts = stored(verdicts.where("not _keep or _same > 1"), "exact-verdicts")
    out = without_rows(docs, verdicts, id_col, text_col)
    repeated = verdicts.where("_keep")                       # rows that agree in id and text: one of them stays
    if repeated.isEmpty():
        return out
    k1, k2 = absent(docs, "_k1"), absent(docs, "_k2")
    same = without_rows(docs, repeated, id_col, text_col, "left_semi").withColumns(dict(zip((k1, k2), row_key(id_col, text_or_empty(text_col)), strict=True)))
    return out.unionByName(same.dropDuplicates([k1, k2]).select(out.columns))
