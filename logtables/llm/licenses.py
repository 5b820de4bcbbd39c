"""License scans: TF-IDF cosine to templates, then inheritance along directories.

The templates are notices of a few sentences and the full texts of licences (``license_texts/``). The vector space has
their words and word pairs; weights come from their document frequency in the whole corpus, which is one pass and one
row per term. A text's passages (each line, paragraph and run of lines that speak of licences, runs of lines about as
long as a template from every line on, the whole text) are compared with every template that the text's words can
reach. Terms outside the templates add to a passage's length with the weight of a term that no document has, so
ordinary prose never comes close.

Files without a licence of their own inherit from the nearest directory above them, their own first, that has a
licence file. Directories, not files, are joined with their ancestors.
"""

from __future__ import annotations

import pathlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import sent, stored

#: Public licence notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version of the License, or any later version."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Full texts, without the lines that name the holder of the rights.
TEXTS = pathlib.Path(__file__).parent / "license_texts"
THRESHOLD = 0.7
#: Runs of lines are of about these multiples of a template's words; at the threshold it has few others or few missing.
LENGTHS = (0.6, 1.0, 1.5)
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright)(\.[a-z]+)?$"
WORD = re.compile(r"[a-z0-9]+(?:[-.+][a-z0-9]+)*")


def terms_of(text: str) -> list[str]:
    """Words and pairs of neighbouring words, in small letters."""
    words = WORD.findall(text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def full_texts() -> list[tuple[str, str]]:
    return [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]


def document_frequencies(docs: DataFrame, text: str, templates: list[tuple[str, str]]) -> tuple[int, dict[str, int]]:
    """The number of documents, and for each term of the templates that of documents with it: one row per term."""
    vocabulary = sorted({t for _, x in templates for t in terms_of(x)})
    singles = {t for t in vocabulary if " " not in t}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, total = set(vocabulary), Counter(), 0
        for batch in batches:
            total += batch.num_rows
            for value in batch.column(0).to_pylist():
                if value:
                    words = WORD.findall(value.lower())
                    there = singles.intersection(words)
                    seen.update(there)
                    if len(there) > 1:
                        seen.update({p for p in (f"{a} {b}" for a, b in zip(words, words[1:]) if a in there and b in there) if p in known})
        rows = [("", total), *seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64())], ["term", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    return found.pop("", 0), found


class Matcher:
    """Cosines of passages to templates: notices, and full texts."""

    def __init__(self, templates: list[tuple[str, str]], documents: int, frequency: dict[str, int], threshold: float,
                 texts: list[tuple[str, str]] | None = None):
        both = [*templates, *(texts or [])]
        self.names, self.threshold, self.notices = [name for name, _ in both], threshold, len(templates)
        self.idf = {t: float(np.log((1 + documents) / (1 + frequency.get(t, 0))) + 1) for _, x in both for t in terms_of(x)}
        self.unseen = float(np.log(1 + documents) + 1)
        self.vectors: list[dict[str, float]] = []
        self.lengths = [len(WORD.findall(x.lower())) for _, x in both]
        #: Words of which a passage must have one: without them no notice can reach the threshold.
        self.cues: set[str] = set()
        for at, (_, text) in enumerate(both):
            vector = {t: n * self.idf[t] for t, n in Counter(terms_of(text)).items()}
            norm = sum(v * v for v in vector.values()) ** 0.5
            vector = {t: v / norm for t, v in vector.items()}
            self.vectors.append(vector)
            if at >= self.notices:
                continue
            rest = 1.0
            for term in sorted((t for t in vector if " " not in t), key=lambda t: (-self.idf[t], t)):
                if rest < threshold**2 * 0.999:
                    break
                self.cues.add(term)
                rest -= sum(v * v for t, v in vector.items() if term in t.split(" ") and not (set(t.split(" ")) - {term}) & self.cues)
        #: A cosine's square is at most the share of the template's square that lies in terms the passage has. Here that
        #: share per word and template, that of a pair at its rarer word; the last row is for all other words.
        self.row = {t: i for i, t in enumerate(sorted(t for t in self.idf if " " not in t))}
        self.share = np.zeros((len(self.row) + 1, len(both)))
        self.least = threshold**2 * 0.999
        #: term to (template, its weight there)
        self.places: dict[str, list[tuple[int, float]]] = {}
        for at, vector in enumerate(self.vectors):
            for t, v in vector.items():
                self.share[self.row[max(t.split(" "), key=self.idf.__getitem__)], at] += v * v
                self.places.setdefault(t, []).append((at, v))

    def cosines(self, words: list[str]) -> list[float]:
        scores, norm = [0.0] * len(self.names), 0.0
        for t, n in Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]).items():
            weight = n * self.idf.get(t, self.unseen)
            norm += weight * weight
            for at, v in self.places.get(t, ()):
                scores[at] += v * weight
        return [round(min(1.0, s / norm**0.5), 9) for s in scores] if norm else scores

    def best(self, passage: str) -> tuple[float, str | None]:
        scores = self.cosines(WORD.findall(passage.lower()))
        at = int(np.argmax(scores))  # of equal ones the first
        return (scores[at], self.names[at]) if scores[at] >= self.threshold else (0.0, None)

    def nearest_run(self, words: list[str], runs: list[tuple[int, int]], template: int) -> tuple[int, int] | None:
        """Of runs whose starts and ends both rise, that with the highest cosine to one template, if it may reach the threshold."""
        vector, counts, dot, norm, a, b = self.vectors[template], {}, 0.0, 0.0, 0, 0
        highest, nearest = self.threshold - 1e-6, None

        def change(term: str, by: int) -> None:
            nonlocal dot, norm
            weight, n = self.idf.get(term, self.unseen), counts.get(term, 0)
            counts[term] = n + by
            norm += (2 * n * by + 1) * weight * weight
            dot += by * weight * vector.get(term, 0.0)

        for start, end in runs:
            if start >= b:
                counts, dot, norm, a, b = {}, 0.0, 0.0, start, start
            while b < end:
                change(words[b], 1)
                if b > a:
                    change(f"{words[b - 1]} {words[b]}", 1)
                b += 1
            while a < start:
                change(words[a], -1)
                if a + 1 < b:
                    change(f"{words[a]} {words[a + 1]}", -1)
                a += 1
            cosine = dot / norm**0.5
            if cosine > highest + 1e-9:
                highest, nearest = cosine, (start, end)
        return nearest

    def scan(self, text: str | None) -> tuple[str | None, float, str | None]:
        """Licence, cosine, and whether the whole text or a passage ("header") has it.

        A full text goes before notices, which full texts contain, and a whole text before its passages.
        """
        found = self.row.keys() & set(WORD.findall(text.lower())) if text else set()
        if not found:
            return None, 0.0, None
        possible = np.flatnonzero(self.share[[self.row[w] for w in found]].sum(axis=0) >= self.least)
        if not len(possible):
            return None, 0.0, None
        lines = [WORD.findall(line.lower()) for line in text.split("\n")]
        words = [w for line in lines for w in line]
        whole = self.cosines(words)
        if max(whole[self.notices:], default=0.0) >= self.threshold:
            at = self.notices + int(np.argmax(whole[self.notices:]))
            return self.names[at], whole[at], "file"
        starts = np.concatenate([[0], np.cumsum([len(line) for line in lines])])
        other = len(self.row)
        rows = np.array([self.row.get(w, other) for w in words])
        filled = np.flatnonzero(np.diff(starts))  # lines with words
        passages = {(i, i + 1) for i in filled.tolist()}
        breaks = np.flatnonzero(np.diff(filled) > 1) + 1
        passages.update((int(r[0]), int(r[-1]) + 1) for r in np.split(filled, breaks))  # paragraphs
        spoken = np.array([i for i in filled.tolist() if not self.cues.isdisjoint(lines[i])], dtype=int)
        if len(spoken):
            passages.update((int(r[0]), int(r[-1]) + 1) for r in np.split(spoken, np.flatnonzero(np.diff(spoken) > 3) + 1))
        ranges = np.array([(starts[i], starts[j]) for i, j in sorted(passages)])
        chosen: set[tuple[int, int]] = set()
        begins = starts[filled]
        for at in possible.tolist():
            sums = np.concatenate([[0.0], np.cumsum(self.share[rows, at])])
            within = ranges[sums[ranges[:, 1]] - sums[ranges[:, 0]] >= self.least - 1e-9]
            chosen.update((int(a), int(b)) for a, b in within)
            for size in (self.lengths[at] * f for f in LENGTHS):
                after = np.searchsorted(starts, np.minimum(begins + size, len(words)))  # first line end that is far enough
                for ends in (starts[after], starts[after - 1]):
                    reach = (ends > begins) & (sums[ends] - sums[begins] >= self.least - 1e-9)
                    run = self.nearest_run(words, list(zip(begins[reach].tolist(), ends[reach].tolist())), at)
                    if run:
                        chosen.add(run)
        best = (False, 0.0, None)
        for a, b in sorted(chosen):
            scores = self.cosines(words[a:b])
            for part, full in ((scores[: self.notices], False), (scores[self.notices:], True)):
                highest = max(part, default=0.0)
                if highest >= self.threshold and (full, highest) > best[:2]:
                    best = (full, highest, self.names[part.index(highest) + (self.notices if full else 0)])
        full, score, name = best
        highest = max(whole)
        if not full and highest >= self.threshold and highest >= score:
            return self.names[whole.index(highest)], highest, "file"
        return (name, score, "header") if name else (None, 0.0, None)


def scan_licenses(files: DataFrame, path: str, text: str = "text", templates: list[tuple[str, str]] | None = None,
                  threshold: float = THRESHOLD, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """The columns of files but text, with license, score, origin.

    origin is "header" or "file" for a licence in the text itself (score: its cosine), "inherited" (score null) for
    one of the nearest directory, and null if there is none, with a null license. A directory's licence is that of
    its licence files, told by their names; of several the one with the highest cosine, ties by name. Null and empty
    texts have no licence of their own, null paths inherit nothing, repeated rows stay, an empty table gives no rows.
    Columns of files that are named like the results are left out. ``templates`` are notices, ``texts`` full texts;
    without either they are those of this module.
    """
    if texts is None:
        texts = [] if templates else full_texts()
    templates = templates or TEMPLATES
    spark = files.sparkSession
    kept = [c for c in files.columns if c not in (text, "license", "score", "origin")]
    documents, frequency = document_frequencies(files, text, [*templates, *texts])
    matcher_of_task = sent(spark, Matcher(templates, documents, frequency, threshold, texts))
    rows = files.select(F.struct(*kept).alias("row"), F.col(path).alias("path"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of_task()
        for batch in batches:
            found = [matcher.scan(t) for t in batch.column(2).to_pylist()]
            made = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["row", "path", "license", "score", "origin"])

    own = stored(rows.mapInArrow(scan, f"row {kind}, path string, license string, score double, origin string"), "licenses")
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    own = own.withColumn("folder", folder)
    named = own.where(F.col("license").isNotNull() & F.col("path").rlike(LICENCE_FILE))
    # one row per directory that has a licence file
    given = named.groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).getField("license").alias("given"))
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("name")))
    folders = own.where("license is null").select("folder").distinct().where("folder is not null")
    folders = folders.select(F.col("folder").alias("from"), F.explode(above).alias("up")).select("from", "up.*")
    nearest = folders.join(given, F.col("name") == F.col("folder")).groupBy("from").agg(F.max_by("given", "depth").alias("given"))
    joined = own.join(nearest, (F.col("folder") == F.col("from")) & F.col("license").isNull(), "left")
    return joined.select(
        "row.*", F.coalesce("license", "given").alias("license"), F.when(F.col("license").isNotNull(), F.col("score")).alias("score"),
        F.when(F.col("license").isNotNull(), F.col("origin")).when(F.col("given").isNotNull(), "inherited").alias("origin"),
    )
