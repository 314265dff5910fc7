"""Licence scans: sparse TF-IDF cosines of headers and licence files to templates, and directory inheritance.

A header is a run of lines or of words. Every line that shares words with a template starts a run of lines, and it grows
downwards while its cosine to that template grows. A run of words is as long as a template, holds three
quarters of its words at least, and may lie anywhere in the text. A licence file is a text that as a whole is close to
a template, or is named like one. A file without a licence of its own takes the one of the nearest directory
above it that holds a licence file. Document frequencies of all words are counted over all files. Words rarer than
a fixed share of the files weigh like words of that share, so a score does not fall as files are added.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, stage, table

# Public licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "proprietary": ["All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
WORDS = re.compile(r"\w+(?:[.\-]\w+)*").findall
#: Share of the files from which words have weights of their own; what the driver gets is at most the mean number of
#: distinct words of a file, divided by it.
RARE = 1 / 1000
#: Words counted in a task before they are sent on.
HELD_WORDS = 200_000
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.\-][^/]*)?$"


class Templates:
    """Unit vectors of all templates over their own words."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names = [name for name, texts in templates.items() for _ in texts]
        self.bags = [Counter(WORDS(t.lower())) for texts in templates.values() for t in texts]
        self.words = sorted({w for b in self.bags for w in b})
        self.index = {w: i for i, w in enumerate(self.words)}

    def weigh(self, files: int, having: dict[str, int]) -> None:
        def idf(n: float) -> float:
            return float(np.log((files + 1) / (max(n, RARE * files) + 1)) + 1)

        self.other = idf(0)
        self.weights = {w: idf(n) for w, n in having.items()}
        self.sizes = [sum(b.values()) for b in self.bags]
        self.idf = np.array([self.weights.get(w, self.other) for w in self.words])
        self.rows = np.zeros((len(self.bags), len(self.words)))
        for row, bag in zip(self.rows, self.bags, strict=True):
            for w, n in bag.items():
                row[self.index[w]] = n * self.idf[self.index[w]]
        self.rows /= np.linalg.norm(self.rows, axis=1, keepdims=True)
        # what a word adds to the product with each template; the last row is for words outside of all
        self.adds = np.vstack([(self.rows * self.idf).T, np.zeros(len(self.bags))])

    def cosines(self, bag: Counter) -> np.ndarray:
        known = [(self.index[w], n) for w, n in bag.items() if w in self.index]
        at = [i for i, _ in known]
        x = self.idf[at] * [n for _, n in known]
        rest = sum((n * self.weights.get(w, self.other)) ** 2 for w, n in bag.items() if w not in self.index)
        return self.rows[:, at] @ x / np.sqrt(max((x * x).sum() + rest, 1e-12))

    def run(self, words: list[str], least: float) -> tuple[float, str | None]:
        """Best cosine of ``least`` or more of a run of words as long as its template, and its licence."""
        best, licence = 0.0, None
        held = set(words)
        # a template lacking more than a quarter of its words in the whole text has no run
        near = [t for t, b in enumerate(self.bags) if 4 * sum(n for w, n in b.items() if w in held) >= 3 * self.sizes[t]]
        if not near:
            return best, licence
        at = np.array([self.index.get(w, -1) for w in words])
        product = np.vstack([np.zeros(len(self.bags)), np.cumsum(self.adds[at], axis=0)])
        square = np.concatenate([[0.0], np.cumsum([self.weights.get(w, self.other) ** 2 for w in words])])
        for t in near:
            m = self.sizes[t]
            if len(words) < m:
                continue
            # words that stand twice in a run make it longer than this, so no cosine is above its bound
            bound = (product[m:, t] - product[:-m, t]) / np.sqrt(square[m:] - square[:-m])
            places = np.flatnonzero(bound >= max(best, least) - 1e-9)
            for i in places[np.argsort(-bound[places], kind="stable")]:
                if bound[i] <= best:
                    break
                bag = Counter(words[i : i + m])
                if 4 * sum((bag & self.bags[t]).values()) < 3 * m:
                    continue
                score = float(self.cosines(bag)[t])
                if score >= least and score > best:
                    best, licence = score, self.names[t]
        return best, licence

    def header(self, lines: list[list[str]], least: float) -> tuple[float, str | None]:
        """Best cosine of a run of lines or words, and its licence."""
        best, licence = self.run([w for line in lines for w in line], least)
        hits = [sum(w in self.index for w in line) for line in lines]
        for i, line in enumerate(lines):
            if hits[i] < 2 or 4 * hits[i] < len(line):
                continue
            counts: dict[str, int] = {}
            product, square, top = 0.0, 0.0, None
            for more in islice(lines, i, None):
                product = product + self.adds[[self.index.get(w, -1) for w in more]].sum(axis=0)
                for w in more:
                    n = counts.get(w, 0)
                    counts[w] = n + 1
                    square += (2 * n + 1) * self.weights.get(w, self.other) ** 2
                t = int(product.argmax())
                score = float(product[t] / math.sqrt(square))
                if top is not None and score <= top[0]:
                    break
                top = (score, t)
            if top[0] > best:
                best, licence = top[0], self.names[top[1]]
        return best, licence if best >= least else None


def frequencies(files: DataFrame) -> DataFrame:
    """word, files: in how many rows of ``files`` each word stands; the empty word stands in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for cell in batch.column("text"):
                total.update({"", *WORDS((cell.as_py() or "").lower())})
                if len(total) >= HELD_WORDS:
                    yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "files"])
                    total.clear()
        yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "files"])

    return files.select("text").mapInArrow(count, "word string, files long").groupBy("word").agg(F.sum("files").alias("files"))


def scanned(files: DataFrame, templates: dict[str, list[str]], least: float, keys: Sequence[str] = ()) -> DataFrame:
    """path, ``keys``, header, header_score, whole, whole_score of every file: the best licence of its headers and of
    the whole text, null below ``least``."""
    model = Templates(templates)
    counts = stage(frequencies(files))
    total = counts.where("word = ''").first()
    n = total["files"] if total else 0
    common = counts.where((F.col("files") > RARE * n) & (F.col("word") != "")).collect()
    model.weigh(n, {r["word"]: r["files"] for r in common})
    carried = ["path", *keys]
    names = [*carried, "header", "header_score", "whole", "whole_score"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column("text"):
                lines = [w for line in (cell.as_py() or "").lower().split("\n") if (w := WORDS(line))]
                score, licence = model.header(lines, least)
                whole = model.cosines(Counter(w for line in lines for w in line)) if lines else np.zeros(1)
                near = float(whole.max())
                rows.append((licence, score, model.names[int(whole.argmax())] if near >= least else None, near))
            columns = zip(zip(*rows, strict=True), (pa.string(), pa.float64(), pa.string(), pa.float64()), strict=True)
            yield pa.record_batch([*(batch.column(c) for c in carried), *(pa.array(c, t) for c, t in columns)], names=names)

    kinds = "".join(f"`{k}` {files.schema[k].dataType.simpleString()}, " for k in keys)
    return files.select(F.col("path").cast("string").alias("path"), *keys, "text").mapInArrow(scan, f"path string, {kinds}header string, header_score double, whole string, whole_score double")


#: What ``licensed`` adds to a row, in working and in the result.
OWN_NAMES = {"path", "text", "licence", "score", "origin", "licence_dir", "dir", "is_file", "own", "near", "header", "header_score", "whole", "whole_score"}


def licensed(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.6, keys: Sequence[str] = ()) -> DataFrame:
    """``keys``, path, licence, score, origin (file, header, inherited or null), licence_dir for every row of ``files`` (path, text).

    Null, empty and unrelated texts have no licence of their own. Of several licence files in a directory
    the best score counts, ties by name. Files without path have no directory: they inherit nothing and license no
    other file. Rows that share a path are files of their own. The root directory is the empty text. ``keys`` are
    columns carried along; their names must not be the operator's own. Other columns are ignored. Where ``files`` has no
    column path at all, every text speaks for itself and no directory is looked for.
    """
    if OWN_NAMES & set(keys):
        raise ValueError(f"names of the operator itself: {sorted(OWN_NAMES & set(keys))}")
    has_paths = "path" in files.columns
    rows = scanned(files if has_paths else files.withColumn("path", F.lit(None).cast("string")), templates, least, keys)
    # a file that is named like a licence speaks by its headers too
    named = F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False))
    is_file = F.col("whole").isNotNull() | (named & F.col("header").isNotNull())
    folder = F.when(F.col("path").contains("/"), F.regexp_extract("path", "^(.*)/[^/]*$", 1)).when(F.col("path").isNotNull(), F.lit(""))
    rows = rows.withColumn("is_file", is_file).withColumn("dir", folder)
    own = F.when(F.col("whole").isNotNull(), F.col("whole")).otherwise(F.col("header"))
    score = F.when(F.col("whole").isNotNull(), F.col("whole_score")).when(F.col("header").isNotNull(), F.col("header_score"))
    rows = rows.select(*keys, "path", "dir", "is_file", own.alias("own"), score.alias("score"))
    origin = F.when(F.col("is_file"), "file").when(F.col("own").isNotNull(), "header")
    if not has_paths:
        return rows.select(*keys, "path", F.col("own").alias("licence"), "score", origin.alias("origin"), F.lit(None).cast("string").alias("licence_dir"))
    # written, as three branches below would else scan the texts each by itself
    rows = stage(rows)
    granted = rows.where("is_file and dir is not null").groupBy("dir").agg(F.max(F.struct("score", "own")).alias("best"))
    granted = granted.select(F.col("dir").alias("above"), F.col("best.own").alias("grant"))
    # directories once, however many files they hold; each meets the directories above it
    dirs = rows.select("dir").where("dir is not null").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    above = dirs.select("dir", F.explode(F.array_distinct(above)).alias("above"))
    near = above.join(granted, "above").groupBy("dir").agg(F.max_by(F.struct("above", "grant"), F.char_length("above")).alias("near"))
    placed = rows.where("dir is not null").join(small(stage(near)), "dir", "left")
    # files without directory would all meet in one task of the join
    free = rows.where("dir is null").withColumn("near", F.lit(None).cast(near.schema["near"].dataType))
    takes = F.col("own").isNull() & F.col("near").isNotNull()
    return placed.unionByName(free).select(
        *keys,
        "path",
        F.coalesce("own", "near.grant").alias("licence"),
        "score",
        origin.when(takes, "inherited").alias("origin"),
        F.when(takes, F.col("near.above")).alias("licence_dir"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents. They have no paths, so each is told by its own text alone."""
    docs = table(spark, sf_dir, "documents")
    out = licensed(docs.select("doc_id", "text"), keys=["doc_id"])
    return out.withColumn("score", F.round("score", 6))
