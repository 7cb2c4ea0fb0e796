"""Best-fit packing by the sum-of-squares rule.

Every text is tokenised, ended by ``END`` and, if longer than a sequence, cut into pieces of a whole sequence with the
shorter rest first. A piece goes where the sum of the squared counts of open sequences per residual gap becomes
smallest: into an open sequence, or into a new one. Keeping the counts even leaves a fitting gap for whatever comes;
pieces come longest first, so the short ones close what is left.

Only lengths decide, so the tokens stay where the texts are: one pass yields a narrow row per piece, which is stored,
dealt at random into shards of about ``SHARD`` pieces, and packed shard by shard. A shard leaves its last sequences
partly empty, which is a constant per shard. A full piece is a sequence of its own and goes through no shard.

Defined results: a null or empty text is the single token ``END``; repeated rows and repeated or null ids are packed as
separate documents; extra columns are ignored; an empty table gives an empty result. Memory per task: one shard and
one text's tokens.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import steps, stored, text_or_empty

CAPACITY, END, SHARD = 2048, 0, 200_000
#: A run of white space of this length is left to the tokenizer file: the pattern's look-ahead recurses over the run.
LONG_SPACE = re.compile(r"\s{20000}")
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

class Encoder:
    """Token ids as little-endian 32-bit bytes, those of the ``tokenizers`` file ``path``.

    ``ranks`` is the same vocabulary for tiktoken, which gives the same ids several times faster; it takes every text but
    those that hold the string of a special token, which the tokenizer file treats in its own way, or a very long run of
    white space.
    """

    def __init__(self, path: str, ranks: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            have = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=have, special_tokens={})

    def reference(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special) or LONG_SPACE.search(text):
            return self.reference(text)
        return array("I", self.fast.encode_ordinary(text)).tobytes()


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Encoder:
    """One per Python worker; both are names of public tokenizer files or paths."""
    if (vocabulary, ranks) not in _ENCODERS:
        import public_tokenizers

        path = [f if "/" in f else public_tokenizers.path(f) for f in (vocabulary, ranks)]
        _ENCODERS[vocabulary, ranks] = Encoder(*path, public_tokenizers.PATTERN)
    return _ENCODERS[vocabulary, ranks]


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole sequences, but for the first."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def _pieces(vocabulary: str, ranks: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        task, row = TaskContext.get().partitionId(), 0
        end = np.asarray([END], dtype="<u4").tobytes()
        for batch in steps(batches):
            out = []
            which = []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text) + end
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    out.append((piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), (task << 40) + row))
                    which.append(k)
                    row += 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), *cols], [batch.schema.names[0], "piece", "start", "length", "ids_crc32", "row"])

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, in the given order."""
    count = np.zeros(capacity + 1, dtype=np.int64)            # open sequences by residual gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    made = 0
    never = np.iinfo(np.int64).max
    for k, size in enumerate(lengths.tolist()):
        # the change of the sum when a gap h becomes h - size; a gap that closes counts no more
        change = 2 * (count[: capacity - size] - count[size:capacity]) + 2
        if len(change):
            change[0] = 1 - 2 * count[size]
            change[count[size:capacity] == 0] = never
        best = int(change.argmin()) if len(change) else 0
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        if len(change) and change[best] != never and change[best] <= fresh:
            gap = best + size
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, at = capacity, made
            made += 1
        sequence[k], offset[k] = at, capacity - gap
        if gap > size:
            open_at[gap - size].append(at)
            count[gap - size] += 1
    return sequence, offset


def _pack(capacity: int):
    def run(shard: pa.Table) -> pa.Table:
        lengths, rows = np.asarray(shard["length"]), np.asarray(shard["row"])
        order = np.lexsort((rows, -lengths))
        sequence, offset = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        sequence[order], offset[order] = sum_of_squares(lengths[order], capacity)
        number = np.asarray(shard["shard"]) * (1 << 32) + sequence
        out = shard.drop_columns(["shard", "row"])
        return out.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, ranks: str = RANKS, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and a number ``row`` of its own. Stored."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(_pieces(vocabulary, ranks, capacity), f"_id {kind}, piece int, start long, length long, ids_crc32 long, row long")
    return stored(out.withColumnRenamed("_id", id_col), "pieces")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, ranks: str = RANKS, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Pieces with sequence_id and offset: the pieces of a sequence lie one after another from 0, without a gap."""
    rows = pieces(docs, id_col, text_col, vocabulary, ranks, capacity)
    part = rows.where(F.col("length") < capacity)
    shards = max(1, -(-part.count() // shard))
    dealt = part.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("long"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = dealt.groupBy("shard").applyInArrow(_pack(capacity), schema)
    full = rows.where(F.col("length") == capacity).select(id_col, "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
