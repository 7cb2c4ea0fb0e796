"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader.

A word is a run of anything but ASCII white space. Its n-grams are the word itself, its form (which kinds of characters
it has, how it begins and ends, its length class) and the pair of its form with the next one's, which also says whether
the word is repeated. Each is hashed to one of ``2**BITS`` weights. A text is the sparse vector of the shares of its
n-grams, so long and short texts are on one scale; its score is the logistic function of the sparse dot product.

Training takes labelled rows only, and at most ``TRAIN_ROWS`` of them: those whose id hashes lowest, so that the sample
does not depend on how the table is partitioned. That bound is a parameter; scoring covers every whole text. One task
runs FTRL-proximal over the sample (bounded by it), and the model, one array of ``2**BITS`` numbers, is broadcast.

Defined results: null and empty texts have a feature of their own; null ids are never held out and never trained on;
repeated rows get the same score; labels that are null or not 0 or 1, or of unknown documents, are not used; without
any usable label every score is 0.5; extra columns are kept by ``keep_good``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import absent, flat, lowest, steps, text_or_empty, words_flat
from cartwheel.llm.windows import mix, word_hashes

BITS = 18
TRAIN_ROWS = 12_000
EPOCHS = 4
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-5, 1e-5
SCALE = 20.0

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[48:58] = 1
_KIND[97:123] = 2
_KIND[128:] = 2
_KIND[65:91] = 4
for _b in b".,;:'\"-()?":
    _KIND[_b] = 8
_KIND[[b for b in range(33, 127) if _KIND[b] == 0]] = 16


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weight numbers of all n-grams in text order: (words of one kind after another), each word's text, words per text."""
    starts, ends, bounds = words_flat(raw, offsets)
    n = len(starts)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if not n:
        return np.zeros((3, 0), dtype=np.int64), text, np.diff(bounds)
    kinds = _KIND[raw]
    has = np.bitwise_or.reduceat(kinds, starts)               # white space between words has kind 0
    size = np.minimum(np.bit_length(ends - starts) if hasattr(np, "bit_length") else np.log2(ends - starts).astype(np.int64) + 1, 7)
    form = has.astype(np.uint64) | (kinds[starts].astype(np.uint64) << np.uint64(8)) | (raw[ends - 1] * (kinds[ends - 1] >= 8)).astype(np.uint64) << np.uint64(16)
    form |= size.astype(np.uint64) << np.uint64(24)
    word = word_hashes(raw, starts, ends)
    then = np.zeros(n, dtype=np.uint64)
    then[:-1] = form[1:] | (word[1:] == word[:-1]).astype(np.uint64) << np.uint64(30)
    then[bounds[1:][np.diff(bounds) > 0] - 1] = np.uint64(1 << 31)
    mask = np.uint64((1 << BITS) - 1)
    rows = [mix(word + np.uint64(1)) & mask, mix(form * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2)) & mask, mix((form | then << np.uint64(32)) + np.uint64(3)) & mask]
    return np.stack(rows).astype(np.int64), text, np.diff(bounds)


EMPTY = 0                                                     # the weight of "no words at all"
BIAS = 1


def sparse_rows(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weight numbers, values) of each text: shares of the n-grams times SCALE, and the bias."""
    grams, text, counts = features(raw, offsets)
    ends = np.cumsum(counts)
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if not n:
            out.append((np.array([EMPTY, BIAS]), np.array([1.0, 1.0])))
            continue
        at, seen = np.unique(grams[:, end - n : end].ravel(), return_counts=True)
        out.append((np.append(at, BIAS), np.append(seen * (SCALE / n), 1.0)))
    return out


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights by FTRL-proximal with a learning rate per weight."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + root) / ALPHA + L2))
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30))) - labels[k]) * x
            more = np.sqrt(ni + g * g)
            np.add.at(z, at, g - (more - root) / ALPHA * w)
            np.add.at(n, at, g * g)
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def scores(model: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    grams, text, counts = features(raw, offsets)
    total = np.bincount(text, weights=model[grams].sum(0), minlength=len(counts)) if len(text) else np.zeros(len(counts))
    logit = model[BIAS] + np.where(counts > 0, total * SCALE / np.maximum(counts, 1), model[EMPTY])
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the bounded sample, in one task; they are put in order, so that the model does not depend on theirs."""
    rows, labels, order = [], [], []
    for batch in steps(batches):
        rows += sparse_rows(*flat(batch.column("text")))
        labels += batch.column("label").to_pylist()
        order += batch.column("at").to_pylist()
    by = sorted(range(len(rows)), key=lambda k: (order[k], labels[k], len(rows[k][0]), rows[k][1].sum()))
    weights = ftrl([rows[k] for k in by], [labels[k] for k in by])
    yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f8").tobytes()], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> np.ndarray:
    """The model from at most ``rows`` labelled rows that are not held out."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    narrow = usable.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    sample = lowest(narrow, F.xxhash64("_id", "label"), rows).withColumnRenamed("_at", "at")
    ids = [r[0] for r in sample.select("_id").distinct().collect()]                    # at most ``rows`` ids
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text")).where(F.col("_id").isin(ids))
    known = texts.groupBy("_id").agg(F.min("text").alias("text")).join(sample, "_id")  # of repeated ids one text
    found = known.select("text", "label", "at").repartition(1).mapInArrow(_fit, "model binary").collect()
    return np.frombuffer(found[0].model, dtype="<f8") if found else np.zeros(1 << BITS)


def _score(model):
    """Score of a text column. Only the texts go to Python, once, and only numbers come back; other columns stay in the JVM."""

    def run(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([pc.fill_null(text, "")], ["text"])
        out = [scores(model.value, *flat(part.column("text"))) for part in steps([batch])]
        return pa.array(np.concatenate([np.zeros(0), *out]))

    return F.arrow_udf(run, "double")


def scored(docs: DataFrame, model: np.ndarray, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a double ``score_col`` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers
    return docs.withColumn(score_col, _score(shared)(text_or_empty(text_col)))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every document."""
    model = train(docs, labels, id_col, text_col)
    narrow = docs.select(F.col(id_col), F.col(text_col))
    out = scored(narrow, model, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected ones, all columns unchanged."""
    model = train(docs, labels, id_col, text_col)
    score = absent(docs, "score")
    return scored(docs, model, text_col, score).where(F.col(score) >= THRESHOLD).drop(score)
