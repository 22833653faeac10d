"""Benchmark passages inside documents, by a prefix-filtered set join.

An item is cut into windows of 13 words (a shorter item is one window). A window is contained only
if all its shingles of three words are, so one of them is a sufficient prefix: the shingles of all
windows are ordered by how often they occur in the documents, and each window is joined on its
rarest. A match of that shingle fixes where the window would begin (positional bound); it must lie
inside the document (length bound), and its words are then compared one by one.

Items are taken in blocks of a bounded number of words, each broadcast and held against all
documents, so memory does not grow with the benchmark; the passes do. No document moves.

Defined results: null and empty texts and items have no words; an item found twice under one id counts
once; a null id counts as the empty string; repeated keys and rows are rows like any others; without
items nothing is hit; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightloom.llm.textkit import ALNUM, blocks, keyed, map_texts, window_hashes

WINDOW = 13
SHINGLE = 3
BLOCK_WORDS = 400_000
_FILTER_BITS = 20


def item_blocks(items: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items and the hashes of their words, in blocks of about ``most`` words; one block is on the driver at a time."""
    part: list[tuple[str, np.ndarray]] = []
    words = 0
    for row in items.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text).cast("string")).toLocalIterator():
        for block in blocks(pa.array([row[1]], pa.string())):
            hashes = block.lower().words(ALNUM).hashes()
            if len(hashes):
                part.append((row[0], hashes))
                words += len(hashes)
        if words >= most:
            yield part
            part, words = [], 0
    if part:
        yield part


class Windows:
    """The distinct windows of some items, the items that each belongs to, and the shingles in them."""

    def __init__(self, items: list[tuple[str, np.ndarray]]):
        found: dict[bytes, int] = {}
        members: list[list[str]] = []
        for name, words in items:
            size = min(WINDOW, len(words))
            for k in range(len(words) - size + 1):
                content = words[k : k + size].tobytes()
                w = found.setdefault(content, len(members))
                if w == len(members):
                    members.append([])
                if not members[w] or members[w][-1] != name:
                    members[w].append(name)
        self.members = members
        self.words = [np.frombuffer(content, np.uint64) for content in found]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        # of windows shorter than a shingle, the whole is one
        self.shingles = [window_hashes(w, min(SHINGLE, len(w))) for w in self.words]
        self.shingle_sizes = np.minimum(self.sizes, SHINGLE)

    def vocabulary(self, size: int) -> np.ndarray:
        of = [s for s, n in zip(self.shingles, self.shingle_sizes) if n == size]
        return np.unique(np.concatenate(of)) if of else np.empty(0, np.uint64)


class Lookup:
    """Places of 64-bit values in a sorted array; most misses stop at a small table."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[values >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which queries are there, and their places."""
        at = np.flatnonzero(self.maybe[queries >> np.uint64(64 - _FILTER_BITS)])
        place = np.searchsorted(self.values, queries[at])
        place[place == len(self.values)] = 0
        right = self.values[place] == queries[at] if len(self.values) else np.zeros(len(at), bool)
        return at[right], place[right]


def shingle_counts(docs: DataFrame, vocabularies: dict[int, np.ndarray], text: str) -> dict[int, np.ndarray]:
    """How often each shingle of the windows occurs in all documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabularies)

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        lookups = {size: Lookup(values) for size, values in shared.value.items()}
        totals = {size: np.zeros(len(values), np.int64) for size, values in shared.value.items()}
        for block in blocks(texts):
            hashes = block.lower().words(ALNUM).hashes()
            for size, lookup in lookups.items():
                # runs across two documents are counted too; an order by rarity needs no more
                _, places = lookup.find(window_hashes(hashes, size))
                totals[size] += np.bincount(places, minlength=len(lookup.values))
        for size, counts in totals.items():
            at = np.flatnonzero(counts)
            yield {"size": np.full(len(at), size), "place": at, "n": counts[at]}

    counted = map_texts(docs, [], text, "size long, place long, n long", per_batch)
    totals = {size: np.zeros(len(values), np.int64) for size, values in vocabularies.items()}
    # as many rows as there are shingles in the block of items at most
    for row in counted.groupBy("size", "place").agg(F.sum("n").alias("n")).collect():
        totals[row["size"]][row["place"]] = row["n"]
    return totals


@dataclass
class Anchors:
    """By shingle size: sorted rarest shingles, and the windows that each leads to with their offsets."""

    sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    words: np.ndarray  # of all windows, one after another
    begins: np.ndarray
    members: list[list[str]]


def anchors(windows: Windows, vocabularies: dict[int, np.ndarray], totals: dict[int, np.ndarray]) -> Anchors:
    chosen: dict[int, list[tuple[int, int, int]]] = {size: [] for size in vocabularies}
    for w, shingles in enumerate(windows.shingles):
        size = int(windows.shingle_sizes[w])
        counts = totals[size][np.searchsorted(vocabularies[size], shingles)]
        rarest = min(range(len(shingles)), key=lambda k: (counts[k], shingles[k]))
        chosen[size].append((int(shingles[rarest]), w, rarest))
    sizes = {}
    for size, rows in chosen.items():
        rows.sort()
        values, first = np.unique(np.array([r[0] for r in rows], np.uint64), return_index=True)
        bounds = np.append(first, len(rows))
        sizes[size] = (values, bounds, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    begins = np.concatenate(([0], np.cumsum(windows.sizes)))
    return Anchors(sizes, np.concatenate(windows.words), begins, windows.members)


def matches(anchored: Anchors, lookups: dict[int, Lookup], hashes: np.ndarray, bounds: np.ndarray):
    """All occurrences of windows in a block: first word, length and window, by document."""
    docs = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    starts, lengths, found = [], [], []
    for size, (_, first, windows, offsets) in anchored.sizes.items():
        at, places = lookups[size].find(window_hashes(hashes, size))
        n = first[places + 1] - first[places]
        rows = np.repeat(first[places], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        position = np.repeat(at, n)
        w = windows[rows]
        start, length = position - offsets[rows], anchored.begins[w + 1] - anchored.begins[w]
        own = docs[position]
        inside = (start >= bounds[own]) & (start + length <= bounds[own + 1])
        start, length, w = start[inside], length[inside], w[inside]
        for k in range(int(length.max(initial=0))):
            here = hashes[np.minimum(start + k, len(hashes) - 1)]
            there = anchored.words[np.minimum(anchored.begins[w] + k, len(anchored.words) - 1)]
            same = (k >= length) | (here == there)
            start, length, w = start[same], length[same], w[same]
        starts.append(start)
        lengths.append(length)
        found.append(w)
    start, length, w = map(np.concatenate, (starts, lengths, found)) if starts else (np.empty(0, int),) * 3
    order = np.argsort(start, kind="stable")
    return docs[start[order]] if len(order) else start, start[order], length[order], w[order]


HITS = "array<struct<start:int,end:int>>"


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``key, n_words, hits, items``: disjoint runs of words inside windows, and the items found, distinct and sorted."""
    spark = docs.sparkSession
    schema = keyed(docs, [key], f"_text string, n_words long, hits {HITS}, items array<string>")
    none = F.array().cast("array<string>")
    rows = docs.select(key, F.col(text).cast("string").alias("_text"))
    state = rows.select(key, "_text", F.array().cast(HITS).alias("hits"), none.alias("items"))
    parts = item_blocks(items, item, item_text, block_words)
    held = False
    for windows in map(Windows, parts):
        sizes = sorted(set(windows.shingle_sizes.tolist()))
        vocabularies = {size: windows.vocabulary(size) for size in sizes}
        anchored = anchors(windows, vocabularies, shingle_counts(rows, vocabularies, "_text"))
        state = _held_against(state, spark.sparkContext.broadcast(anchored), key, schema)
        held = True
    if not held:
        nothing = Anchors({}, np.empty(0, np.uint64), np.zeros(1, np.int64), [])
        state = _held_against(state, spark.sparkContext.broadcast(nothing), key, schema)
    return state.select(key, "n_words", "hits", "items")


def _held_against(state: DataFrame, shared, key: str, schema: T.StructType) -> DataFrame:
    """Add what one block of items finds to the hits and items of each document."""

    def per_batch(given: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        anchored = shared.value
        lookups = {size: Lookup(of[0]) for size, of in anchored.sizes.items()}
        for block in blocks(texts):
            rows = slice(block.first_row, block.first_row + block.n_docs)
            words = block.lower().words(ALNUM)
            own, start, length, w = matches(anchored, lookups, words.hashes(), words.bounds)
            hits, names = given["hits"][rows].to_pylist(), given["items"][rows].to_pylist()
            edges = np.searchsorted(own, np.arange(block.n_docs + 1))
            for d in np.unique(own):
                part = slice(edges[d], edges[d + 1])
                a = start[part] - words.bounds[d]
                runs = [(h["start"], h["end"]) for h in hits[d]]
                hits[d] = _union(runs + list(zip(a.tolist(), (a + length[part]).tolist())))
                names[d] = sorted({*names[d], *(n for k in np.unique(w[part]) for n in anchored.members[k])})
            yield {key: given[key][rows], "_text": texts[rows], "n_words": words.counts, "hits": hits, "items": names}

    return map_texts(state, [key, "hits", "items"], "_text", schema, per_batch)


def _union(runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def judged(found: DataFrame) -> DataFrame:
    """``overlaps`` with ``n_hit, n_items, items_sha256`` and ``contaminated``: a twentieth of the words is hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256))
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
    )
