"""Near-duplicate groups with HyperMinHash sketches.

A document's set holds its distinct ``SHINGLE``-word shingles (A-Z lower-cased, words split at ASCII white space); a
shorter text is one shingle, an empty one has none. Documents are linked when the Jaccard similarity of their sets is at
least ``THRESHOLD`` percent, and grouped by links.

1. Equal sets are found by a 128-bit sum of their shingle hashes and go on as one class, however many copies there are.
2. A class gets ``REGISTERS`` registers: in each bucket the smallest hash, kept as its count of leading zeros and
   ``MANTISSA`` further bits. Buckets that no shingle fell into borrow from a pseudo-random one, alike for all sets.
3. ``BANDS`` bands of ``ROWS`` registers make the buckets of the candidate search. At the threshold a pair shares
   none of them with probability (1 - 0.85**6)**32 = 3e-7, less above it.
4. In each bucket every class is paired with one centre (by ``CENTRES`` orders, so that bands vary). A pair goes on if the sizes allow
   the similarity and the share of equal registers, corrected for chance collisions, is above ``FLOOR`` (4.5 standard
   deviations below the threshold), or the smaller set has fewer than ``SMALL`` shingles: such sets borrow registers, so
   that their estimate strays further. Then the full sets are compared.
5. Centres leave open the pairs of a bucket that the links of step 4 don't connect yet. Those are compared inside
   blocks of a bucket, first by registers, then on full sets where the estimate allows a link and no link found in the
   block joins the two already. Only links leave a block, so a hot bucket never expands into its pairs, and no pair is
   skipped that could join two groups.

Defined results: null and empty texts are linked with nothing and stay; repeated rows are copies; component_id is the
smallest non-null id of the group (null if there is none); extra columns are kept by ``drop_near_copies``; an empty table gives
an empty result. Memory per task: one text, or two blocks of about ``BLOCK`` classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import flat, row_key, steps, stored, text_or_empty, without_rows, words_flat
from cartwheel.llm.components import components
from cartwheel.llm.windows import mix, prefix_hash, range_hash, word_hashes

SHINGLE, THRESHOLD = 3, 85
REGISTERS, MANTISSA = 256, 10
BANDS, ROWS = 32, 6
#: Orders by which the bands choose their centres.
CENTRES = 2
FLOOR = 0.85 - 4.5 * (0.85 * 0.15 / REGISTERS) ** 0.5
#: Pairs with a set of fewer shingles are compared in full whatever their registers say.
SMALL = 300
#: Chance that two unlike registers collide.
COLLISION = 0.169919487159739 / 2**MANTISSA
#: A set of fewer shingles than this can only be linked with an equal one.
FEWEST = -(-THRESHOLD // (100 - THRESHOLD))
BLOCK = 500

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = _LOWER[raw]
    starts, ends, bounds = words_flat(raw, offsets)
    prefix = prefix_hash(word_hashes(raw, starts, ends))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        size = min(SHINGLE, b - a)
        at = np.arange(a, b - size + 1 if size else a)
        out.append(np.unique(range_hash_at(prefix, at, at + size)))
    return out


def range_hash_at(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return range_hash(prefix, start, end) if len(start) else np.zeros(0, dtype=np.uint64)


def _borrowing() -> np.ndarray:
    """For each bucket the order in which it asks the others: a few hundred pseudo-random tries, then all in turn."""
    tries = mix(np.arange(REGISTERS * 512, dtype=np.uint64) + np.uint64(99)).reshape(REGISTERS, 512) % np.uint64(REGISTERS)
    rest = (np.arange(REGISTERS)[:, None] + np.arange(REGISTERS)[None, :]) % REGISTERS
    return np.concatenate([tries.astype(np.int64), rest], axis=1)


_ASK = _borrowing()


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, one row per (non-empty) set."""
    none = np.uint64(1 << 63)
    least = np.full(len(sets) * REGISTERS, none)
    if sets:
        every = mix(np.concatenate(sets) + np.uint64(12345))
        of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        np.minimum.at(least, of * REGISTERS + (every % np.uint64(REGISTERS)).astype(np.int64), every >> np.uint64(12))     # 52 bits
    least = least.reshape(len(sets), REGISTERS)
    empty = least == none
    row, bucket = np.nonzero(empty & ~empty.all(1, keepdims=True))
    step = 0
    while len(row):
        ask = _ASK[bucket, step]
        full = ~empty[row, ask]
        least[row[full], bucket[full]] = least[row[full], ask[full]]
        row, bucket, step = row[~full], bucket[~full], step + 1
    zeros = 52 - np.frexp(least.astype(np.float64))[1].astype(np.int64)
    zeros = np.clip(zeros, 0, 52)
    further = ((least << (zeros + 1).astype(np.uint64)) & np.uint64((1 << 52) - 1)) >> np.uint64(52 - MANTISSA)
    return (zeros.astype(np.uint64) << np.uint64(MANTISSA) | further).astype("<u2")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        sets = shingle_sets(*flat(batch.column("text")))
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        sums = [[int(mix(s + np.uint64(c)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets] for c in (17, 4711)]
        regs = registers(sets)
        rest = batch.drop_columns(["text"])
        cols = [pa.array(sizes), *(pa.array(s, pa.int64()) for s in sums), pa.array([r.tobytes() for r in regs], pa.binary())]
        yield pa.RecordBatch.from_arrays([*rest.columns, *cols], [*rest.schema.names, "n", "s1", "s2", "regs"])


def estimate(equal: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for collisions."""
    return (equal / REGISTERS - COLLISION) / (1 - COLLISION)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "ra"):
        a, b = (flat(batch.column(c))[0].view("<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
        least = np.minimum(*(np.asarray(batch.column(c)) for c in ("na", "nb")))
        keep = (estimate((a == b).sum(1)) >= FLOOR) | (least < SMALL)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets (sorted distinct hashes) reach the threshold."""
    both = np.concatenate([x, y])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= THRESHOLD * (len(x) + len(y) - common)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, ta, tb) whose full sets are similar enough."""
    for batch in steps(batches, "ta", 1 << 19):
        one, two = (shingle_sets(*flat(batch.column(c))) for c in ("ta", "tb"))
        keep = [similar(x, y) for x, y in zip(one, two, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (band, bucket, x, y); each such group is one block of a bucket, or two that meet."""

    def pairs(group: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
        cid, comp, n, side = (np.asarray(t.column(c)) for c in ("cid", "comp", "n", "side"))
        regs = flat(t.column("regs"))[0].view("<u2").reshape(-1, REGISTERS)
        raw, offsets = flat(t.column("text"))
        band = t.column("band")[0].as_py()
        cross = t.column("x")[0].as_py() != t.column("y")[0].as_py()
        comp = comp.copy()
        sets: dict[int, np.ndarray] = {}

        def full_set(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingle_sets(raw[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]]))[0]
            return sets[k]

        links = []
        for i in range(len(cid)):
            if cross and side[i]:
                continue
            ok = (comp != comp[i]) & (cid > cid[i] if not cross else side != side[i])
            ok &= 100 * np.minimum(n, n[i]) >= THRESHOLD * np.maximum(n, n[i])
            js = np.flatnonzero(ok)
            if not len(js):
                continue
            same = regs[js] == regs[i]
            good = (estimate(same.sum(1)) >= FLOOR) | (np.minimum(n[js], n[i]) < SMALL)
            js, same = js[good], same[good]
            if band and len(js):                              # a pair is for the first band that it shares
                js = js[~same[:, : band * ROWS].reshape(len(js), band, ROWS).all(2).any(1)]
            for j in js.tolist():
                if comp[j] != comp[i] and similar(full_set(i), full_set(j)):
                    links.append((min(int(cid[i]), int(cid[j])), max(int(cid[i]), int(cid[j]))))
                    comp[comp == comp[j]] = comp[i]           # what is joined needs no other link
        a_out, b_out = zip(*links, strict=True) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(c)) for c in ("band", "bucket", "x", "y")]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(int(c[a]) for c in cols)
            if key is not None and now != key:
                yield pairs(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pairs(held)


def _bands(classes: DataFrame) -> DataFrame:
    band = lambda i: F.xxhash64(F.substring(F.col("regs"), 2 * ROWS * i + 1, 2 * ROWS))
    return classes.select("cid", "n", F.posexplode(F.array(*(band(i) for i in range(BANDS)))).alias("band", "bucket"))


def _texts(cids: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, text): one document's text stands for a class."""
    text = text_or_empty(text_col)
    named = docs.select(*row_key(id_col, text), text.alias("text"))
    return stored(named.join(classes.select("cid", "k1", "k2").join(cids, "cid"), ["k1", "k2"]).select("cid", "text").dropDuplicates(["cid"]), "near-texts")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
    texts = _texts(ends, classes, docs, id_col, text_col)
    both = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
    return stored(both.select("a", "b", "ta", "tb").mapInArrow(_compare, "a long, b long"), "near-links")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, id, n_shingles, component_id) of every row."""
    text = text_or_empty(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(*row_key(id_col, text), F.col(id_col).alias("id"), text.alias("text"))
    found = rows.mapInArrow(_sketches, f"k1 long, k2 long, id {kind}, n long, s1 long, s2 long, regs binary")
    sketches = stored(found.withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    sets = stored(sketches.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("row").alias("cid"), F.min("id").alias("label")), "near-sets")
    classes = stored(sketches.join(sets.where(F.col("n") >= FEWEST).select("cid"), F.col("row") == F.col("cid")).select("cid", "n", "k1", "k2", "regs"), "near-classes")

    members = _bands(classes)
    order = F.xxhash64("cid", F.col("band") % CENTRES)         # a class of a large group meets few centres, not one per band
    centres = stored(members.groupBy("band", "bucket").agg(F.count("*").alias("size"), F.min_by("cid", order).alias("centre")).where("size > 1"), "near-buckets")
    in_buckets = stored(members.join(centres, ["band", "bucket"]).select("band", "bucket", "size", "centre", "cid", "n"), "near-members")
    pairs = in_buckets.where("cid <> centre").select(F.least("cid", "centre").alias("a"), F.greatest("cid", "centre").alias("b")).distinct()
    sized = [classes.select(F.col("cid").alias(e), F.col("n").alias(f"n{e}"), F.col("regs").alias(f"r{e}")) for e in "ab"]
    near = pairs.join(sized[0], "a").join(sized[1], "b").where(f"100 * least(na, nb) >= {THRESHOLD} * greatest(na, nb)")
    star = stored(near.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_plausible, "a long, b long"), "near-pairs")
    links = _verified(star, classes, docs, id_col, text_col)

    comps = components(links)
    labelled = in_buckets.join(comps.select(F.col("v").alias("cid"), "comp"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    labelled = stored(labelled, "near-labelled")
    split = labelled.groupBy("band", "bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band", "bucket")
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    found = stored(labelled.join(split, ["band", "bucket"]), "near-open")
    texts = _texts(found.select("cid").distinct(), classes, docs, id_col, text_col)
    open_rows = (
        found.withColumn("blocks", blocks).withColumn("own", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("band", "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("long").alias("side"), "cid", "comp", "n")
        .join(classes.select("cid", "regs"), "cid").join(texts, "cid")
    )
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = open_rows.repartition(tasks, "band", "bucket", "x", "y").sortWithinPartitions("band", "bucket", "x", "y")
    rest = stored(dealt.mapInArrow(_block_pairs, "a long, b long").distinct(), "near-rest")
    if not rest.isEmpty():
        comps = components(links.unionByName(rest))

    of_set = sets.join(comps, F.col("cid") == F.col("v"), "left").select("n", "s1", "s2", "label", F.coalesce("comp", "cid").alias("comp"))
    of_set = stored(of_set, "near-set-comps")
    lowest = of_set.groupBy("comp").agg(F.min("label").alias("component_id"))
    of_set = stored(of_set.join(lowest, "comp").select("n", "s1", "s2", "component_id"), "near-set-ids")
    out = sketches.drop("regs").join(of_set.withColumn("_in", F.lit(True)), ["n", "s1", "s2"], "left")
    return out.select("k1", "k2", F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("_in"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept of every row."""
    return groups(docs, id_col, text_col).select(id_col, "n_shingles", "component_id", F.col(id_col).eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id left of every group, all columns unchanged."""
    gone = groups(docs, id_col, text_col).where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select("k1", "k2").distinct()
    return without_rows(docs, stored(gone, "near-gone"), id_col, text_col)
