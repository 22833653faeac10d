"""Near duplicates by the Jaccard similarity of word shingles: a count-vector R-tree join.

A document is the set of its five-word shingles, each 64 hashed bits; documents of equal sets are one
node of the graph. Shingles are hashed into groups, and a set's counts by group are a point: the sum
over the groups of the smaller count bounds the overlap of two sets from above. Points that share a
shingle among the rarest of each set (any two similar sets do) are packed into an R-tree, whose
nodes keep the largest count of each group and the smallest size; a pair of nodes is entered only if
the bound of their corners leaves room for a link, pairs of points must also have room by counts of
finer groups, and those that survive are verified on the sets themselves.

Links inside a group of thousands of near copies are not needed one by one: each document is first
compared with the one that is the smallest under most of its shingles; then each shingle whose documents are not yet
connected compares them with the smallest of them and with one more, and the trees skip whatever is connected by then.
Two documents that share many such shingles are a pair under the smallest of these alone, as far as the few smallest of
each document tell.
Shingles that very many documents have are found by counting all of them into fixed slots, and come
last in the order by rarity. The order only affects speed: any order finds every link.

Defined results: a text of fewer than five words is one shingle of all its words; null texts and
texts without words are empty and linked with nothing; null keys are members like any others but never
name a component; repeated rows are copies; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from brightloom.llm.components import components
from brightloom.llm.textkit import (
    NON_SPACE,
    Block,
    as_array,
    blocks,
    import_here,
    keyed,
    lists,
    map_texts,
    mix,
    window_hashes,
)
from brightloom.workspace import discard, written

SHINGLE = 5
GROUPS = 16
FINE_GROUPS = 256
LEAF = 32
PAGE = 512
SLOT_BITS = 22
FILTER_BITS = 22
FIRST_TOKENS = 8


def required(sizes: np.ndarray | int) -> np.ndarray | int:
    """The least overlap of a set with any set similar to it: four fifths, rounded up."""
    return (4 * sizes + 4) // 5


def shingle_sets(block: Block) -> Iterator[np.ndarray]:
    """For each document its sorted distinct shingles."""
    words = block.lower().words(NON_SPACE)
    hashes = words.hashes()
    windows = window_hashes(hashes, SHINGLE)
    bounds = words.bounds.tolist()
    for first, end in zip(bounds[:-1], bounds[1:]):
        n = end - first
        if n >= SHINGLE:
            yield np.unique(windows[first : end - SHINGLE + 1])
        else:
            yield window_hashes(hashes[first:end], n) if n else np.empty(0, np.uint64)


def fingerprint(shingles: np.ndarray) -> int:
    """63 bits of a set, the same for equal sets only (as far as 63 bits tell)."""
    mixed = mix(shingles ^ np.uint64(0xA0761D6478BD642F))
    whole = mix(np.array([mixed.sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64))
    return int(whole[0] >> np.uint64(1))


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row ``key, n, node, fine`` for each document, and rows ``slot, seen`` for slots of frequent shingles.

    ``fine`` is the point: a byte for each group has its count, or 255 if that is more.

    A task reports a slot that got far more shingles than slots do on the mean, so that what it
    reports stays small; a shingle of many documents stands out in every task.
    """
    import_here(docs)
    schema = keyed(docs, [key], "n long, node long, fine binary, slot long, seen long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SLOT_BITS, np.int32)

        def rows(length: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [as_array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in arrow],
                schema=arrow,
            )

        for batch in batches:
            for block in blocks(batch.column("_text")):
                part = slice(block.first_row, block.first_row + block.n_docs)
                sets = list(shingle_sets(block))
                slots, times = np.unique(_slots(np.concatenate(sets)), return_counts=True)
                seen[slots] += times.astype(np.int32)
                columns = {
                    key: batch.column(key)[part],
                    "n": list(map(len, sets)),
                    "node": [fingerprint(s) if len(s) else None for s in sets],
                    "fine": [np.minimum(point(s, FINE_GROUPS), 255).astype(np.uint8).tobytes() for s in sets],
                }
                yield rows(block.n_docs, **columns)
        mean = seen.mean()
        heavy = np.flatnonzero(seen > mean + 4 * np.sqrt(mean) + 2)
        yield rows(len(heavy), slot=heavy, seen=seen[heavy])

    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def slot_weights(rows: DataFrame) -> np.ndarray:
    """How often the frequent slots were seen; at most one row for each of the fixed slots comes to the driver."""
    weights = np.zeros(1 << SLOT_BITS, np.int32)
    for row in rows.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("seen").alias("seen")).toLocalIterator():
        weights[row["slot"]] = min(row["seen"], np.iinfo(np.int32).max)
    return weights


def prefix(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, so many that any similar set has one of its own rarest among them."""
    length = len(shingles) - int(required(len(shingles))) + 1
    # sets are sorted by their bits, a stable sort by weight keeps that order among equals
    return shingles[np.argsort(weights[_slots(shingles)], kind="stable")[:length]]


def prefixes(docs: DataFrame, weights: np.ndarray, text: str) -> DataFrame:
    """``token, node``: the rarest shingles of each set; a task tells equal sets once."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    told: set[int] = set()

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        for block in blocks(texts):
            tokens, nodes = [], []
            for shingles in shingle_sets(block):
                if len(shingles):
                    node = fingerprint(shingles)
                    if node not in told:
                        told.add(node)
                        tokens.append(prefix(shingles, shared.value))
                        nodes.append(np.full(len(tokens[-1]), node, np.int64))
            if tokens:
                yield {"token": np.concatenate(tokens).view(np.int64), "node": np.concatenate(nodes)}

    return map_texts(docs, [], text, "token long, node long", per_batch)


def point(shingles: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts of a set by group."""
    return np.bincount((shingles % np.uint64(groups)).astype(np.int64), minlength=groups)


def sets_of(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """``node, n, shingles`` of these nodes (and of some more), read from the texts once again.

    A filter of fixed size, one bit for each slot that a node falls in, goes to every task, so that
    only sets move which are likely to be asked for, and no texts. A task tells equal sets once.
    """
    spark = docs.sparkSession
    slots = nodes.select(F.col("node").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("slot")).distinct().toArrow()
    wanted = np.zeros(1 << FILTER_BITS, bool)
    wanted[slots["slot"].to_numpy()] = True
    shared = spark.sparkContext.broadcast(wanted)
    told: set[int] = set()

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        for block in blocks(texts):
            found = {}
            for shingles in shingle_sets(block):
                if len(shingles):
                    node = fingerprint(shingles)
                    if shared.value[node & ((1 << FILTER_BITS) - 1)] and node not in told:
                        told.add(node)
                        found[node] = shingles
            if found:
                sets = list(found.values())
                bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                flat = lists(np.concatenate(sets).view(np.int64), bounds)
                yield {"node": list(found), "n": np.diff(bounds), "shingles": flat}

    return map_texts(docs, [], text, "node long, n long, shingles array<long>", per_batch)


def may_link(least_overlap: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Room for a similarity of 0.8: 100 shared >= 80 (a + b - shared)."""
    return 9 * least_overlap >= 4 * (size_a + size_b)


def fine_counts(column: pa.Array) -> np.ndarray:
    """A row of counts for each value of ``fine``."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, FINE_GROUPS)


def room(fine_a: np.ndarray, fine_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether sizes and finer counts leave room for a link; what lies above 255 counts as common as far as both have it."""
    common = np.minimum(fine_a, fine_b).sum(axis=1, dtype=np.int64)
    above_a = size_a - fine_a.sum(axis=1, dtype=np.int64)
    above_b = size_b - fine_b.sum(axis=1, dtype=np.int64)
    similar_size = 5 * np.minimum(size_a, size_b) >= 4 * np.maximum(size_a, size_b)
    return similar_size & may_link(common + np.minimum(above_a, above_b), size_a, size_b)


def coarse_counts(fine: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """At least the counts by group, from those by finer group; what lies above 255 may be in any group."""
    sums = fine.reshape(len(fine), -1, GROUPS).sum(axis=1, dtype=np.int64)
    return sums + (sizes - sums.sum(axis=1))[:, None]


def met_before(token: int, firsts_a: np.ndarray, firsts_b: np.ndarray) -> np.ndarray:
    """Whether a smaller token is among the first ones of both of a pair, which meets under that one as well."""
    both = firsts_a[:, :, None] == firsts_b[:, None, :]
    return (both & (firsts_a < token)[:, :, None]).any(axis=(1, 2))


class RTree:
    """Points packed into nodes of ``LEAF`` by component and size; a node has corner, least size and common component."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, groups: np.ndarray):
        self.order = np.lexsort((*counts.T[:2], sizes, groups))
        level = (counts[self.order], sizes[self.order], groups[self.order])
        self.levels = [level]
        while len(level[1]) > 1:
            first = np.arange(0, len(level[1]), LEAF)
            lowest, highest = np.minimum.reduceat(level[2], first), np.maximum.reduceat(level[2], first)
            level = (
                np.maximum.reduceat(level[0], first, axis=0),
                np.minimum.reduceat(level[1], first),
                np.where(lowest == highest, lowest, -1),
            )
            self.levels.append(level)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points of different components whose overlap may suffice."""
        a = b = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 2, -1, -1):
            counts, sizes, groups = self.levels[depth]
            a, b = self._children(a, b, len(sizes))
            keep = (a <= b) if depth else (a < b)
            keep &= (groups[a] != groups[b]) | (groups[a] < 0)
            a, b = a[keep], b[keep]
            open_ = np.zeros(len(a), bool)
            for at in range(0, len(a), 100_000):
                x, y = a[at : at + 100_000], b[at : at + 100_000]
                open_[at : at + 100_000] = may_link(np.minimum(counts[x], counts[y]).sum(axis=1), sizes[x], sizes[y])
            a, b = a[open_], b[open_]
        return self.order[a], self.order[b]

    @staticmethod
    def _children(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(LEAF)
        left = np.repeat((a[:, None] * LEAF + step), LEAF, axis=1).ravel()
        right = np.tile(b[:, None] * LEAF + step, (1, LEAF)).ravel()
        inside = (left < n) & (right < n)
        return left[inside], right[inside]


def surviving_pairs(points: DataFrame) -> DataFrame:
    """``a, b`` from rows ``token, left, right, node, pivot, component, page, n, fine, firsts`` sorted by token and pages."""
    import_here(points)
    schema = "a long, b long"

    def of_run(token, node, page, left, right, pivot, group, sizes, fine, firsts) -> tuple[np.ndarray, np.ndarray]:
        _, first = np.unique(node, return_index=True)  # a node may come from several tasks
        # the smallest document has been compared with all of them
        first = first[node[first] != pivot]
        if len(first) < 2:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        _, groups = np.unique(group[first], return_inverse=True)
        x, y = RTree(coarse_counts(fine[first], sizes[first]), sizes[first], groups).pairs()
        # two points of one page meet in that page's own tree
        across = (page[first][x] != page[first][y]) | (left == right)
        x, y = first[x[across]], first[y[across]]
        kept = [np.zeros(0, bool)]
        for at in range(0, len(x), 20_000):
            p, q = x[at : at + 20_000], y[at : at + 20_000]
            kept.append(room(fine[p], fine[q], sizes[p], sizes[q]))
        kept = np.concatenate(kept)
        x, y = x[kept], y[kept]
        apart = [np.zeros(0, bool)]
        for at in range(0, len(x), 20_000):
            apart.append(~met_before(token, firsts[x[at : at + 20_000]], firsts[y[at : at + 20_000]]))
        apart = np.concatenate(apart)
        x, y = node[x[apart]], node[y[apart]]
        return np.minimum(x, y), np.maximum(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            table = batch if rest is None else (pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0] if batch is not None else rest)
            if table is None or not len(table):
                continue
            keys = np.stack([table.column(c).to_numpy() for c in ("token", "left", "right")])
            edges = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [len(table)]))
            last = len(edges) - 1 if batch is None else len(edges) - 2
            node, page, pivot, group, sizes = (table.column(c).to_numpy() for c in ("node", "page", "pivot", "component", "n"))
            fine = fine_counts(table.column("fine"))
            firsts = table.column("firsts").flatten().to_numpy().reshape(-1, FIRST_TOKENS)
            found = []
            for k in np.flatnonzero(np.diff(edges[: last + 1]) > 1):
                s = slice(edges[k], edges[k + 1])
                left, right = keys[1][s][0], keys[2][s][0]
                found.append(of_run(keys[0][s][0], node[s], page[s], left, right, pivot[s][0], group[s], sizes[s], fine[s], firsts[s]))
            if found:
                a, b = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            rest = None if batch is None else table.slice(edges[last])

    return points.mapInArrow(run, schema)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sizes and finer counts leave room for a link."""
    import_here(points)
    of_a = points.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa"))
    of_b = points.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                sizes = (batch.column(c).to_numpy() for c in ("na", "nb"))
                kept = room(fine_counts(batch.column("fa")), fine_counts(batch.column("fb")), *sizes)
                yield batch.select(["a", "b"]).filter(pa.array(kept))

    return pairs.join(of_a, "a").join(of_b, "b").mapInArrow(run, "a long, b long")


def verified(asked: DataFrame, docs: DataFrame, text: str, name: str) -> DataFrame:
    """The pairs ``a, b`` of a written table whose sets are similar, written as ``name``."""
    nodes = asked.select(F.explode(F.array("a", "b")).alias("node"))
    found = written(sets_of(docs, nodes, text), "shingle-sets")
    # equal sets come from several tasks; a link found twice is one link
    sets = found.dropDuplicates(["node"])
    of_a = sets.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("shingles").alias("_sa"))
    of_b = sets.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("shingles").alias("_sb"))
    both = asked.join(of_a, "a").join(of_b, "b")
    similar = both.where("9L * size(array_intersect(_sa, _sb)) >= 4 * (_na + _nb)").select("a", "b")
    kept = written(similar, name)
    discard(found, asked)
    return kept


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """``token, node, pivot, alike`` of tokens that several nodes have; of ``alike`` tokens with the very same nodes only one."""
    # the sums by token and the join with them read one shuffle; no token is null, but only if both sides say so are they one
    tokens = tokens.where("token IS NOT NULL").repartition("token")
    mixed = F.xxhash64("node") % (1 << 40)
    runs = (
        tokens.groupBy("token")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("_last"), F.sum(mixed).alias("_sum"), F.bit_xor("node").alias("_xor"))
        .where("pivot < _last")
    )
    chosen = runs.groupBy("pivot", "_last", "_sum", "_xor").agg(F.min("token").alias("token"), F.count("*").alias("alike")).select("token", "pivot", "alike")
    return tokens.join(chosen, "token")


def _with_components(shared: DataFrame, known: DataFrame) -> DataFrame:
    return shared.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def links(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``key, n, node`` of every document, and links ``a, b`` that connect all nodes that similarity connects."""
    rows = written(described(docs, key, text), "shingle-rows")
    documents = rows.where("slot IS NULL").select(key, "n", "node")
    shared = written(shared_tokens(prefixes(docs, slot_weights(rows), text)), "shared-shingles")
    told = rows.where("node IS NOT NULL").groupBy("node")
    points = written(told.agg(*(F.first(c).alias(c) for c in ("n", "fine"))), "points")
    # each document and the one that is the smallest under most of its shingles
    under = shared.where("node <> pivot").groupBy("node", "pivot").agg(F.sum("alike").alias("_times"))
    nearest = under.groupBy("node").agg(F.max_by("pivot", F.struct("_times", -F.col("pivot"))).alias("a"))
    stars = nearest.select("a", F.col("node").alias("b"))
    first = verified(written(bounded(stars, points), "bounded-pairs"), docs, text, "star-links")
    # shingles whose documents are not yet connected: the smallest of them, and one more by a hashed choice
    apart = _with_components(shared, components(first))
    hubs = (
        apart.groupBy("token")
        .agg(
            F.min_by(F.struct("node", "component"), F.xxhash64("node")).alias("_hub"),
            F.min_by("component", "node").alias("_of_pivot"),
            F.min("component").alias("_low"),
            F.max("component").alias("_high"),
        )
        .where("_low < _high")
    )
    open_ = apart.join(hubs, "token")
    by_pivot = open_.where("component <> _of_pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    by_hub = open_.where("component <> _hub.component AND node <> pivot AND _hub.node <> pivot").select(
        F.least("node", F.col("_hub.node")).alias("a"), F.greatest("node", F.col("_hub.node")).alias("b")
    )
    more = written(bounded(by_pivot.union(by_hub).distinct(), points), "bounded-pairs")
    first = first.union(verified(more, docs, text, "more-star-links"))
    grouped = _with_components(shared, components(first))
    several = (
        grouped.groupBy("token")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_m"))
        .where("_low < _high")
        .select("token", F.ceil(F.col("_m") / PAGE).cast("int").alias("_pages"))
    )
    columns = ["token", "node", "pivot", "component", "_pages"]
    meeting = written(grouped.join(several, "token").select(*columns), "meeting-shingles")
    # the smallest tokens of each node, padded by one that is not smaller than any
    none = F.lit(np.iinfo(np.int64).max)
    own = meeting.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FIRST_TOKENS).alias("_own"))
    firsts = own.select("node", F.slice(F.concat("_own", F.array_repeat(none, FIRST_TOKENS)), 1, FIRST_TOKENS).alias("firsts"))
    left, right = F.least("page", "_other").alias("left"), F.greatest("page", "_other").alias("right")
    paged = (
        meeting.withColumn("page", F.pmod(F.xxhash64("node"), F.col("_pages")).cast("int"))
        .withColumn("_other", F.explode(F.expr("sequence(0, _pages - 1)")))
        .select("token", "node", "pivot", "component", "page", left, right)
        .join(points.join(firsts, "node"), "node")
    )
    keys = ["token", "left", "right"]
    trees = surviving_pairs(paged.repartition(*keys).sortWithinPartitions(*keys))
    second = verified(written(trees.distinct(), "tree-pairs"), docs, text, "tree-links")
    discard(shared, points, meeting)
    return documents, first.union(second)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component``: the smallest key reachable by links, for every document."""
    documents, edges = links(docs, key=key, text=text)
    classes = components(edges)
    placed = documents.join(classes, "node", "left").withColumn("_class", F.coalesce("component", "node")).drop("component")
    named = placed.where("_class IS NOT NULL").groupBy("_class").agg(F.min(key).alias("component"))
    return placed.join(named, "_class", "left").select(
        key, F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col(key)).otherwise(F.col("component")).alias("component")
    )
