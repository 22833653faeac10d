"""Licences of files, by similarity to templates and by inheritance along paths.

A passage is a window of words about as long as one of the notices that holds a cue word (windows begin
at every quarter of their length, and a header wrapped over lines is one run of words), the line of a cue
word, and the whole of a licence file. Passages and templates are sparse TF-IDF vectors, and a file has the
licence of the template with the largest cosine to one of its passages, if that reaches the threshold.
Document frequencies are over all files with passages: exact for the words of the templates, and in slots
of fixed number for all others, which only weigh in the norm of a passage. So the frequencies are one small
table at any size, and each file is compared in its own task, without a shuffle of words.

A file without a licence of its own takes that of the nearest directory above it with a licence file;
inheritance is resolved once for each directory, by a join of its ancestors.

Defined results: null texts have no passages; a null path is a file of no name in the root; rows with
the same path are judged each by its own text, and a directory with several licence files has the
licence that is most similar (then the first by name); further columns are returned as they are,
but for those named like a result, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from brightloom.llm.textkit import ALNUM, Words, as_array, blocks, import_here, keyed
from brightloom.workspace import written

# fixed values: common notices of each licence, and the headings of their full texts
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
        """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND
        DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined
        by Sections 1 through 9 of this document.""",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission.""",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        """By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this
        Creative Commons Attribution 4.0 International Public License ("Public License").""",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        """By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this
        Creative Commons Attribution-NonCommercial 4.0 International Public License ("Public License").""",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
        """GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to
        copy and distribute verbatim copies of this license document, but changing it is not allowed.""",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
        """GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is
        permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.""",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software.""",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
        """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates,
        contributes to the creation of, or owns Covered Software.""",
    ],
}
# fixed values: words that notices have
CUES = "license licenses licensed licence licences licenced copyright spdx hereby redistribution rights"
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
THRESHOLD = 0.6
SLOT_BITS = 18
SPREAD = 1.2
MOST_WORDS = 1_000_000
MOST_WINDOWS = 8_192


def _text_words(texts: list[str]) -> tuple[Words, np.ndarray]:
    block = next(blocks(pa.array(texts, pa.string())))
    words = block.lower().words(ALNUM)
    return words, words.hashes()


class Notices:
    """The words of all templates, each a slot of its own, and a row of counts for each notice."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names = [name for name in sorted(templates) for _ in templates[name]]
        words, hashes = _text_words([text for name in sorted(templates) for text in templates[name]] or [""])
        self.words, slots = np.unique(hashes, return_inverse=True)
        self.counts = np.zeros((words.block.n_docs, len(self.words)))
        np.add.at(self.counts, (words.docs(), slots), 1.0)
        self.cues = np.unique(_text_words([CUES])[1])
        self.n_slots = len(self.words) + (1 << SLOT_BITS)
        self.lengths: list[int] = []
        for length in np.unique(words.counts[words.counts > 0]).tolist():
            if not self.lengths or length >= SPREAD * self.lengths[-1]:
                self.lengths.append(length)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each word: its own if a template has it, or one by its hash."""
        others = len(self.words) + (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        if not len(self.words):
            return others
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, others)

    def windows(self, words: Words, hashes: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and ends of all passages of a block, in order; ``whole`` marks its licence files."""
        cues = np.flatnonzero(np.isin(hashes, self.cues))
        doc = np.searchsorted(words.bounds, cues, "right") - 1
        low, high = words.bounds[doc], words.bounds[doc + 1]
        first, last = [words.bounds[:-1][whole]], [words.bounds[1:][whole]]
        lines = np.flatnonzero(words.block.data == 10)
        line = np.searchsorted(lines, words.starts[cues])
        edges = np.searchsorted(words.starts, lines)
        first.append(np.maximum(low, np.concatenate(([0], edges))[line]))
        last.append(np.minimum(high, np.concatenate((edges, [len(words)]))[line]))
        for length in self.lengths:
            step = max(1, length // 4)
            end = np.maximum(high - length, low)
            first.append(end[end <= cues])
            last.append(high[end <= cues])
            for back in range(-(-length // step)):
                start = low + ((cues - low) // step - back) * step
                holds = start + length > cues
                start = np.clip(start, low, end)[holds]
                first.append(start)
                last.append(np.minimum(start + length, high[holds]))
        size = len(words) + 1
        both = np.unique(np.concatenate(first) * size + np.concatenate(last))
        both = both[both // size < both % size]
        return both // size, both % size


def _flat(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The window and the position of every word of some windows."""
    lengths = last - first
    window = np.repeat(np.arange(len(first)), lengths)
    return window, np.arange(lengths.sum()) + np.repeat(first - np.cumsum(lengths) + lengths, lengths)


def frequencies(files: DataFrame, notices: Notices) -> np.ndarray:
    """In how many files with passages each slot is found, and at last their number.

    A task adds up its slots, so what is shuffled and what comes to the driver has a fixed bound.
    """
    schema = "slot int, files long"
    shared = files.sparkSession.sparkContext.broadcast(notices)
    import_here(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        seen = np.zeros(known.n_slots + 1, np.int64)
        for batch in batches:
            for block in blocks(batch.column("_text")):
                words = block.lower().words(ALNUM)
                hashes = words.hashes()
                rows = slice(block.first_row, block.first_row + block.n_docs)
                first, last = known.windows(words, hashes, np.array(batch.column("_whole")[rows].to_pylist(), bool))
                edges = np.bincount(first, minlength=len(words) + 1) - np.bincount(last, minlength=len(words) + 1)
                inside = np.cumsum(edges)[:-1] > 0
                docs = words.docs()[inside]
                own = np.unique(docs * known.n_slots + known.slots(hashes[inside]))
                seen[:-1] += np.bincount(own % known.n_slots, minlength=known.n_slots)
                seen[-1] += len(np.unique(docs))
        slots = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(seen[slots])], names=["slot", "files"])

    counted = files.select("_text", "_whole").mapInArrow(run, schema).groupBy("slot").agg(F.sum("files").alias("files")).toArrow()
    seen = np.zeros(notices.n_slots + 1, np.int64)
    seen[counted["slot"].to_numpy()] = counted["files"].to_numpy()
    return seen


def best_notices(
    notices: Notices, rarity: np.ndarray, words: Words, hashes: np.ndarray, whole: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each document of a block the largest cosine of a passage and a notice, and the number of that notice."""
    top, which = np.zeros(words.block.n_docs), np.zeros(words.block.n_docs, np.int64)
    first, last = notices.windows(words, hashes, whole)
    slots = notices.slots(hashes)
    n_own = len(notices.words)
    wanted = notices.counts * rarity[:n_own]
    wanted /= np.maximum(np.sqrt((wanted**2).sum(axis=1, keepdims=True)), 1e-300)
    ends = np.cumsum(last - first)
    at = 0
    while at < len(first):
        before = ends[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + MOST_WORDS, "right"))), at + MOST_WINDOWS)
        window, place = _flat(first[at:end], last[at:end])
        told, times = np.unique(window * notices.n_slots + slots[place], return_counts=True)
        window, slot = told // notices.n_slots, told % notices.n_slots
        weight = times * rarity[slot]
        norm = np.sqrt(np.bincount(window, weight**2, end - at))
        dense = np.zeros((end - at, n_own))
        own = slot < n_own
        dense[window[own], slot[own]] = weight[own]
        # rounded, so that ties do not hang on the order of a sum
        cosine = np.round(dense @ wanted.T / norm[:, None], 9)
        best = cosine.argmax(axis=1)
        doc = np.searchsorted(words.bounds, first[at:end], "right") - 1
        value = cosine[np.arange(end - at), best]
        order = np.lexsort((best, -value, doc))
        heads = order[np.unique(doc[order], return_index=True)[1]]
        better = (value[heads] > top[doc[heads]]) | ((value[heads] == top[doc[heads]]) & (best[heads] < which[doc[heads]]))
        heads = heads[better]
        top[doc[heads]], which[doc[heads]] = value[heads], best[heads]
        at = end
    return top, which


def judged(files: DataFrame, keys: list[str], notices: Notices, seen: np.ndarray, threshold: float) -> DataFrame:
    """``keys, licence, similarity``: the best template of all passages of a file, null below the threshold."""
    rarity = np.log((1.0 + seen[-1]) / (1.0 + seen[:-1])) + 1.0
    shared = files.sparkSession.sparkContext.broadcast((notices, rarity))
    schema = keyed(files, keys, "licence string, similarity double")
    import_here(files)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = shared.value
        for batch in batches:
            for block in blocks(batch.column("_text")):
                rows = slice(block.first_row, block.first_row + block.n_docs)
                words = block.lower().words(ALNUM)
                whole = np.array(batch.column("_whole")[rows].to_pylist(), bool)
                top, which = best_notices(known, weights, words, words.hashes(), whole)
                found = (top >= threshold) & (top > 0)
                columns = {k: batch.column(k)[rows] for k in keys}
                columns["licence"] = [known.names[k] if ok else None for k, ok in zip(which, found)]
                columns["similarity"] = pa.array(top, mask=~found)
                yield pa.RecordBatch.from_arrays([as_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return files.select(*keys, "_text", "_whole").mapInArrow(run, schema)


def inherited(owners: DataFrame, folders: DataFrame) -> DataFrame:
    """``_folder, licence, similarity, inherited_from``: the nearest of ``owners`` at or above each folder."""
    steps = F.split("_folder", "/")
    above = folders.select("_folder", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("_depth"))
    above = above.withColumn("_owner", F.array_join(F.slice(steps, 1, F.col("_depth")), "/"))
    nearest = F.max_by(F.struct("licence", "similarity", F.col("_owner").alias("inherited_from")), "_depth")
    return above.join(owners, "_owner").groupBy("_folder").agg(nearest.alias("_from")).select("_folder", "_from.*")


def licences(
    files: DataFrame,
    templates: dict[str, list[str]] | None = None,
    *,
    path: str = "path",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The columns of ``files`` but the text, with ``licence, similarity, via`` (own, folder, none) and ``inherited_from``."""
    added = ("licence", "similarity", "via", "inherited_from")
    kept = [c for c in files.columns if c != text and c.lower() not in added]
    named = files.select(
        # one value, so that no column of it can clash
        F.struct(*kept).alias("_row"),
        F.coalesce(path, F.lit("")).alias("_path"),
        F.col(text).cast("string").alias("_text"),
    ).withColumn("_whole", F.col("_path").rlike(LICENCE_FILE))
    notices = Notices(TEMPLATES if templates is None else templates)
    own = written(judged(named, ["_row", "_path"], notices, frequencies(named, notices), threshold), "own-licences")
    placed = own.withColumn("_folder", F.regexp_replace("_path", r"(^|/)[^/]*$", ""))
    owners = (
        placed.where(F.col("_path").rlike(LICENCE_FILE) & F.col("licence").isNotNull())
        .groupBy(F.col("_folder").alias("_owner"))
        .agg(F.min(F.struct((-F.col("similarity")).alias("_far"), "licence")).alias("_top"))
        .select("_owner", "_top.licence", (-F.col("_top._far")).alias("similarity"))
    )
    from_folder = inherited(owners, placed.select("_folder").distinct()).select(
        "_folder", F.col("licence").alias("_licence"), F.col("similarity").alias("_similarity"), "inherited_from"
    )
    both = placed.join(from_folder, "_folder", "left")
    has_own = F.col("licence").isNotNull()
    via = F.when(has_own, "own").when(F.col("_licence").isNotNull(), "folder").otherwise("none")
    return both.select(
        *(F.col("_row")[c].alias(c) for c in kept),
        F.coalesce("licence", "_licence").alias("licence"),
        F.coalesce("similarity", "_similarity").alias("similarity"),
        via.alias("via"),
        F.when(~has_own, F.col("inherited_from")).alias("inherited_from"),
    )
