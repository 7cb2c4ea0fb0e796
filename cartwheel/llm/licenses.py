"""Licence scan: a trained paragraph classifier whose predictions are confirmed by templates.

A paragraph is a line with words. Its lower-cased words and word pairs, hashed, go through a multinomial logistic
regression over licence families and an unknown class. It is trained here, on the templates below with words dropped,
replaced and added around them, and on ordinary paragraphs of the corpus: at most ``TRAIN_PARAGRAPHS`` from as many different texts, those with the
lowest hash, whatever the partitioning; of a line longer than ``LINE_CHARS`` characters a stretch of as many, from a place
that its hash chooses. A temperature, fitted on variants kept out of the training, calibrates the
probabilities, so that "unknown" wins unless a family is likely; and a prediction counts only if the paragraph holds
enough of the words and word pairs of one of the family's templates.

Scoring covers every paragraph of every whole text, and besides every window of words within consecutive paragraphs (a line
without words ends them) that holds enough of some template: a notice may be wrapped over lines or stand inside a long
line. Of findings that share words the one with the larger share of a template stays, a line before a window; a line
longer than the window of its template only stays if no window does. ``n_paragraphs`` counts lines.

Defined results: null and empty texts have no paragraphs; repeated rows and null ids are judged one by one; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import flat, lowest_texts, steps, text_or_empty, words_flat
from cartwheel.llm.windows import mix, word_hashes

# Sentences by which licences are granted or named, by family.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "public-domain": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
}
FAMILIES = list(TEMPLATES)
UNKNOWN = len(FAMILIES)
BITS = 14
TRAIN_PARAGRAPHS, VARIANTS, EPOCHS, LINE_CHARS = 3000, 60, 6, 400
#: Least calibrated probability, and share of a template's words and word pairs that the paragraph must hold.
LEAST_PROBABILITY, LEAST_SHARE = 0.6, 0.5
#: Families whose templates differ from another family's by a name only, and what their notices must hold.
NAMED = {"gpl": re.compile(rb"general|gnu|gpl", re.I), "lgpl": re.compile(rb"lesser|library|lgpl", re.I), "agpl": re.compile(rb"affero|agpl", re.I)}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b in (45, 43))]] = 32
_FOLD[10] = 10


def window_words(n: int) -> int:
    """Words of the windows that are compared with a template of ``n`` words."""
    return n + n // 2 + 4


def paragraphs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word hashes, first word of each paragraph (and the end), its text, first and end byte; first and end byte of each
    word, first word of each block of consecutive paragraphs (and the end)."""
    folded = _FOLD[raw]
    lines = np.unique(np.concatenate([offsets, np.flatnonzero(raw == 10) + 1, [len(raw)]]))
    starts, ends, _ = words_flat(folded, offsets)
    words = word_hashes(folded, starts, ends)
    bounds = np.searchsorted(starts, lines)
    some = np.diff(bounds) > 0
    first, last = lines[:-1][some], lines[1:][some]
    of, heads, line = np.searchsorted(offsets, first, side="right") - 1, bounds[:-1][some], np.flatnonzero(some)
    new = (np.diff(line, prepend=-2) > 1) | (np.diff(of, prepend=-1) > 0)
    return words, np.append(heads, len(starts)), of, first, last, starts, ends, np.append(heads[new], len(starts))


def grams(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and of each word with the next one (of the paragraph; else with its end)."""
    after = np.zeros_like(words)
    after[:-1] = words[1:]
    if len(words):
        after[bounds[1:] - 1] = np.uint64(1)
    return words, mix(words * np.uint64(3) + after)


def _slots(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    one, two = grams(words, bounds)
    return (mix(one + np.uint64(5)) & mask).astype(np.int64), (two & mask).astype(np.int64)


def logits(model: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row per paragraph: sums of the n-grams' weights over the root of their number, and the bias."""
    if len(bounds) < 2:
        return np.zeros((0, UNKNOWN + 1))
    one, two = _slots(words, bounds)
    total = np.add.reduceat(model[one] + model[two], bounds[:-1], axis=0)
    return total / np.sqrt(2 * np.diff(bounds))[:, None] + model[1 << BITS]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _flat_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [re.sub(r"\n", " ", t).encode() for t in texts]
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([0, *map(len, parts)])


def _variant(text: str, rnd: random.Random, other: list[str]) -> str:
    words = [w for w in text.split() if rnd.random() > 0.06]
    if rnd.random() < 0.3:
        words[rnd.randrange(len(words)) if words else 0 : 0] = [rnd.choice(other)]
    if rnd.random() < 0.4:
        words = [rnd.choice(other) for _ in range(rnd.randint(1, 6))] + words
    if rnd.random() < 0.4:
        words += [rnd.choice(other) for _ in range(rnd.randint(1, 6))]
    return " ".join(words) or text


def fit(ordinary: list[str]) -> tuple[np.ndarray, float]:
    """(weights, temperature)."""
    rnd = random.Random(3)
    other = " ".join(ordinary[:200]).split() or ["the", "of"]
    near = ["permission to use the file", "a license to kill", "version 2.0 of the program", "released under pressure", "licensed under the counter", "general public", "the terms of use", "all rights reserved"]
    data = [(t, UNKNOWN) for t in ordinary] + [(_variant(t, rnd, other), UNKNOWN) for t in near for _ in range(20)]
    data += [(_variant(t, rnd, other) if k else t, f) for f, family in enumerate(FAMILIES) for t in TEMPLATES[family] for k in range(VARIANTS)]
    rnd.shuffle(data)
    kept_out = data[::5]
    train = [d for k, d in enumerate(data) if k % 5]
    model = np.zeros(((1 << BITS) + 1, UNKNOWN + 1))
    seen = np.full(((1 << BITS) + 1, 1), 1e-3)
    ready = []
    for text, label in train:
        words, bounds, *_ = paragraphs(*_flat_texts([text]))
        if len(bounds) == 2:
            one, two = _slots(words, bounds)
            ready.append((np.concatenate([one, two]), 1 / np.sqrt(2 * len(words)), label))
    for _ in range(EPOCHS):
        rnd.shuffle(ready)
        for slots, scale, label in ready:
            p = _softmax((model[slots].sum(0) * scale + model[1 << BITS])[None])[0]
            p[label] -= 1
            np.add.at(seen, slots, (p @ p) * scale * scale)
            np.add.at(model, slots, -0.5 * scale * p / np.sqrt(seen[slots]))
            seen[1 << BITS] += p @ p
            model[1 << BITS] -= 0.1 * p / np.sqrt(seen[1 << BITS])
    words, bounds, of, *_ = paragraphs(*_flat_texts([t for t, _ in kept_out]))
    truth = np.array([label for _, label in kept_out])[of]
    raw = logits(model, words, bounds)
    loss = lambda t: -np.log(np.maximum(_softmax(raw / t)[np.arange(len(truth)), truth], 1e-12)).mean()
    return model, min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0), key=loss)


class Templates:
    """Words and word pairs of the templates, and the windows of a text that hold enough of them."""

    def __init__(self) -> None:
        self.grams: list[list[set[int]]] = []
        self.reach: list[list[int]] = []                      # words of a window
        sets = []
        for family in FAMILIES:
            own, reach = [], []
            for t in TEMPLATES[family]:
                words, bounds, *_ = paragraphs(*_flat_texts([t]))
                one, two = grams(words, bounds)
                sets.append((np.unique(one), np.unique(two[:-1]), window_words(len(words))))
                own.append({int(x) for x in np.concatenate([one, two[:-1]])})
                reach.append(window_words(len(words)))
            self.grams.append(own)
            self.reach.append(reach)
        self.words = np.unique(np.concatenate([one for one, _, _ in sets]))
        self.pairs = np.unique(np.concatenate([two for _, two, _ in sets]))
        self.sets = [(np.isin(self.words, one), np.isin(self.pairs, two), {*one.tolist(), *two.tolist()}, len(one) + len(two), reach) for one, two, reach in sets]

    def share(self, family: int, own: set[int]) -> tuple[float, int]:
        """The largest share of a template of the family, and the words of that template's window."""
        return max((len(own & t) / len(t), reach) for t, reach in zip(self.grams[family], self.reach[family], strict=True))

    def windows(self, one: np.ndarray, two: np.ndarray, blocks: np.ndarray) -> list[tuple[int, int]]:
        """[first, end) words of every window, from one word of a template on, that holds enough of the template; it ends
        where it has all that it can hold. Words that occur again are first counted again, so that none is missed."""
        if not len(one):
            return []
        slot = np.minimum(np.searchsorted(self.words, one), len(self.words) - 1)
        at = np.flatnonzero(self.words[slot] == one)
        slot = slot[at]
        pair = np.minimum(np.searchsorted(self.pairs, two[at]), len(self.pairs) - 1)
        paired = self.pairs[pair] == two[at]
        border = blocks[np.searchsorted(blocks, at, side="right")] if len(at) else at
        found = set()
        for has, has_pair, own, size, reach in self.sets:
            mine = np.flatnonzero(has[slot])
            if not len(mine):
                continue
            here, stop = at[mine], np.minimum(at[mine] + reach, border[mine])
            total = np.concatenate([[0], np.cumsum(1 + (has_pair[pair[mine]] & paired[mine]))])
            if total[-1] < LEAST_SHARE * size:
                continue
            end = np.searchsorted(here, stop)
            good = np.flatnonzero(total[end] - total[:-1] >= LEAST_SHARE * size)
            for a, b in zip(here[good].tolist(), (here[end[good] - 1] + 1).tolist(), strict=True):
                left, last = set(own), a
                for k, (x, y) in enumerate(zip(one[a:b].tolist(), [*two[a : b - 1].tolist(), None], strict=True), a + 1):
                    for gram, stop_at in ((x, k), (y, k + 1)):
                        if gram in left:
                            left.discard(gram)
                            last = max(last, stop_at)
                if size - len(left) >= LEAST_SHARE * size:
                    found.add((a, last))
        return sorted(found)


def _stretch(line: str) -> str:
    if len(line) <= LINE_CHARS:
        return line
    at = int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little") % (len(line) - LINE_CHARS + 1)
    part = line[at : at + LINE_CHARS]
    whole = re.search(r"\s.*\S(?=\s)", f" {part}" if at == 0 or line[at - 1].isspace() else part, re.S)
    return whole[0].strip() if whole else part


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordinary paragraphs: lines that name no licence. Of a long one, the words in ``LINE_CHARS`` characters at a place
    that its hash chooses."""
    for batch in batches:
        out = [line for text in batch.column("text").to_pylist() for line in text.split("\n") if line.strip() and not re.search("licen|copyright|permission|redistribut|spdx|cc0|cc by", line, re.I)]
        yield pa.RecordBatch.from_arrays([pa.array([_stretch(line) for line in out], pa.string())], ["line"])


def train(docs: DataFrame, text_col: str = "text", most: int = TRAIN_PARAGRAPHS) -> tuple[np.ndarray, float]:
    texts = lowest_texts(docs.select(text_or_empty(text_col).alias("text")).where("text <> ''"), most)
    lines = texts.mapInArrow(_sample, "line string")
    rows = lines.orderBy(F.xxhash64("line"), "line").limit(most).collect()           # a bounded sample of short strings
    return fit([r.line for r in rows])


def _sure(model: np.ndarray, heat: float, words: np.ndarray, bounds: np.ndarray, held) -> np.ndarray:
    """Probabilities of the paragraphs. A family whose name ``held(k)``, the bytes of paragraph k, lacks has none."""
    raw = logits(model, words, bounds) / heat
    if not len(raw):
        return raw
    names = {FAMILIES.index(family): name for family, name in NAMED.items()}
    for k in np.flatnonzero(np.isin(raw.argmax(1), list(names))):
        own = held(int(k))
        raw[k, [f for f, name in names.items() if not name.search(own)]] = -np.inf
    return _softmax(raw)


def confirmed(model: np.ndarray, heat: float, templates: Templates, raw: np.ndarray, parts: tuple[np.ndarray, ...]) -> list[tuple[int, int, int, int, float, float]]:
    """(text, family, first byte, end byte, probability, share) of the notices in what ``paragraphs`` gave."""
    words, bounds, of, first, last, starts, ends, blocks = parts
    one, two = grams(words, np.append(blocks[:-1], len(words)) if len(words) else bounds)
    spans = [(int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    lines = len(spans)
    spans += templates.windows(one, two, blocks)
    sure = [_sure(model, heat, words, bounds, lambda k: raw[first[k] : last[k]].tobytes())]
    if len(spans) > lines:
        some = spans[lines:]
        own = np.concatenate([words[a:b] for a, b in some])
        sure.append(_sure(model, heat, own, np.cumsum([0, *(b - a for a, b in some)]), lambda k: raw[starts[some[k][0]] : ends[some[k][1] - 1]].tobytes()))
    sure = np.concatenate(sure)
    best = sure.argmax(1) if len(sure) else np.zeros(0, dtype=np.int64)
    ranked = []
    for k in np.flatnonzero((best != UNKNOWN) & (sure.max(1, initial=0) >= LEAST_PROBABILITY)) if len(sure) else ():
        a, b = spans[k]
        share, reach = templates.share(best[k], {int(x) for x in np.concatenate([one[a:b], two[a : b - 1]])})
        if share >= LEAST_SHARE:
            line = k < lines
            ranked.append((line and b - a > reach, -share, not line, b - a, -float(sure[k, best[k]]), a, int(k)))
    taken = np.zeros(len(words), dtype=bool)
    out = []
    for _, share, _, size, probability, a, k in sorted(ranked):
        if taken[a : a + size].any():
            continue
        taken[a : a + size] = True
        text = of[np.searchsorted(bounds, a, side="right") - 1]
        start, end = (first[k], last[k]) if k < lines else (starts[a], ends[a + size - 1])
        out.append((int(text), int(best[k]), int(start), int(end), -probability, -share))
    return sorted(out, key=lambda x: x[2])


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, heat = shared.value
        templates = Templates()
        for batch in steps(batches, "_text"):
            raw, offsets = flat(batch.column("_text"))
            parts = paragraphs(raw, offsets)
            of = parts[2]
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for text, family, first, last, probability, share in confirmed(model, heat, templates, raw, parts):
                start = len(raw[int(offsets[text]) : first].tobytes().decode())
                end = start + len(raw[first:last].tobytes().decode().rstrip("\n"))
                found[text].append({"family": FAMILIES[family], "start": start, "end": end, "probability": probability, "share": share})
            count = np.bincount(of, minlength=batch.num_rows) if len(of) else np.zeros(batch.num_rows, dtype=np.int64)
            kind = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("share", pa.float64())]))
            rest = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(count, pa.int64()), pa.array(found, kind)], [*rest.schema.names, "n_paragraphs", "licences"])

    return run


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_paragraphs and licences (family, start, end, probability, share; code points) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(_scan(shared), f"`{id_col}` {kind}, n_paragraphs long, licences array<struct<family:string,start:long,end:long,probability:double,share:double>>")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_paragraphs, n_licences, families (sorted, comma-joined) and spans (family:start:end, comma-joined)."""
    found = licences(docs, id_col, text_col)
    names = F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"])))
    spans = F.transform("licences", lambda x: F.concat_ws(":", x["family"], x["start"], x["end"]))
    return found.select(id_col, "n_paragraphs", F.size("licences").cast("long").alias("n_licences"), F.array_join(names, ",").alias("families"), F.array_join(spans, ",").alias("spans"))
