"""Log-probabilities of whole texts under a hierarchical Pitman-Yor model.

A text is its lower-cased words and one end. Each is a customer of the restaurant of the word before
it (of the end, for a first word), whose tables are customers of one restaurant of words. The parent of
that one spells: a word is its bytes and a stop, each drawn in the restaurant of the bytes
before it, and every context's parent is the context without its farthest byte, down to the uniform
distribution over bytes. So a word never seen has the probability of its spelling, and spellings are
learned from the tables of the words.

Tables are sampled by Gibbs sweeps, and predictive probabilities averaged over sweeps after the
first. The sampler is spread out: contexts that end in the same two bytes form a subtree with no
other parents, so a group has whole subtrees; the restaurants above (contexts of one byte and none) are two tables of a fixed size that
the driver samples between rounds. Within a sweep the restaurants of a level
see each other's tables as of the sweep before.

Nothing of the vocabulary is broadcast, and no word or pair is a row. Documents are dealt into chunks of a few
megabytes, words by their hash, pairs and n-grams of bytes by their codes into as many parts. What one
of these groups tells another is one row (``letters``) of packed numbers: a chunk tells each part its distinct
words or pairs in ascending order, and the part answers in that order. So a shuffle moves a few bytes for each
distinct word or pair of a chunk, and a group holds what a few megabytes of text have.

Words are numbered by part, and a pair is one number. A pair of one customer has one table, whatever is drawn, so only
pairs of more are kept and seated; what the others give to the sums by word follows from the word's own count.
Dishes of a word's restaurant need only its number of tables from each other, so pairs are seated wherever they lie and no
context, however common, meets in one task.

Defined results: null texts count as empty ones and have the end alone; null keys train and score like
others; nothing to train on leaves every byte uniform; repeated rows are rows like any others; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.letters import Letters, Mail, answered, apart, floats, increasing, numbers, packed, rising, unpacked
from brightloom.llm.seating import BYTES, Level, chain, predictions, seat, log_stirling, sweep
from brightloom.llm.textkit import NON_SPACE, blocks, import_here, mix
from brightloom.workspace import discard, written

CONTEXT = 5  # bytes
DISCOUNTS = [0.5, 0.6, 0.7, 0.75, 0.8, 0.8]  # by length of the context
WORD_DISCOUNT = 0.7
PAIR_DISCOUNT = 0.75
STRENGTH = 1.0
STOP = 10
CHUNK_BYTES = 12_000_000
TOP_LENGTH = 2  # shortest context inside the subtrees
ROUNDS = 2
BURN_IN = 1
SAMPLES = 3


def n_chunks(df: DataFrame, size: Column, most: int) -> int:
    """How many groups of about ``most`` bytes the rows make."""
    return max(1, math.ceil((df.agg(F.sum(size)).first()[0] or 0) / most))


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of some spans as a binary array."""
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])


def _words_of(texts: pa.Array) -> Iterator[tuple[int, int, object, np.ndarray]]:
    for block in blocks(texts):
        words = block.lower().words(NON_SPACE)
        yield block.first_row, block.n_docs, words, words.hashes()


def sequence(words, hashes: np.ndarray) -> np.ndarray:
    """The hashes of a block's words with the end, 0, after each document; the end before is the context of a first word."""
    return np.insert(hashes, words.bounds[1:], 0)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct hashes of all tokens, the place of each token's among them, and the tokens of each text."""
    parts = [(sequence(words, hashes), words.counts + 1) for _, _, words, hashes in _words_of(texts)]
    hashes, lengths = map(np.concatenate, zip(*parts))
    distinct, place = np.unique(hashes, return_inverse=True)
    return distinct, place, lengths


def word_part(hashes: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` parts for each hash, in ascending order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def trained(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("_train").combine_chunks().to_numpy(zero_copy_only=False), bool)


def chunk_words(docs: DataFrame, n: int) -> DataFrame:
    """Letters of each chunk to the parts of its words: the hashes, the words and their number in training texts; the end is the empty word."""
    import_here(docs)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        chunk, train = table.column("_chunk")[0].as_py(), trained(table)
        names, counts, hashes_of = [pa.array([b""], pa.large_binary())], [np.array([train.sum()])], [np.zeros(1, np.uint64)]
        for first, n_docs, words, hashes in _words_of(table.column("_text").combine_chunks()):
            distinct, at, place = np.unique(hashes, return_index=True, return_inverse=True)
            weight = train[first : first + n_docs][words.docs()]
            names.append(slices(words.block.data, words.starts[at], words.ends[at]))
            counts.append(np.bincount(place, weight, len(distinct)).astype(np.int64))
            hashes_of.append(distinct)
        hashes, count = np.concatenate(hashes_of), np.concatenate(counts)
        distinct, at, place = np.unique(hashes, return_index=True, return_inverse=True)
        word = pa.concat_arrays(names).take(pa.array(at))
        total = np.bincount(place, count, len(distinct)).astype(np.int64)
        out = Letters()
        for part, s in apart(word_part(distinct, n), n):
            out.add("told", chunk, part, increasing(distinct[s]), *strings(word[s]), packed(total[s]))
        return out.table()

    return docs.select("_chunk", "_train", "_text").groupBy("_chunk").applyInArrow(run, Letters.SCHEMA)


def strings(words: pa.Array) -> tuple[bytes, bytes]:
    """Words as their bytes and their lengths."""
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    return (data.to_pybytes()[bounds[0] : bounds[-1]] if data is not None else b""), packed(np.diff(bounds))


def words_from(data: bytes, lengths: bytes) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum(unpacked(lengths))))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def vocabulary_of(told: DataFrame) -> DataFrame:
    """By part its ``words`` in the order of their hashes, with counts and one table each; ``asks``: the places of each chunk's words."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        letters = mail["told"]
        hashes = [rising(m.a).view(np.uint64) for m in letters]
        distinct, at, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        word = pa.concat_arrays([words_from(m.b, m.c) for m in letters]).take(pa.array(at))
        n = np.bincount(place, np.concatenate([unpacked(m.d) for m in letters]), len(distinct)).astype(np.int64)
        ones = packed(np.ones(len(n), np.int64))
        out.add("words", part, part, *strings(word), packed(n), ones, x=len(n), y=int(n.sum()))
        ends = np.cumsum([len(h) for h in hashes])
        for m, end, own in zip(letters, ends, hashes):
            out.add("asks", m.here, part, increasing(place[end - len(own) : end]))

    return answered(told, run)


class Numbering:
    """Words are numbered by part, in the order of their hashes; a pair is one number, and pairs are dealt by ranges of it.

    The first digit mixes both words, so that the pairs of a common word lie in all ranges.
    """

    def __init__(self, sizes: dict[int, int], n: int):
        self.n = n
        self.starts = np.concatenate(([0], np.cumsum([sizes.get(part, 0) for part in range(n)]))).astype(np.int64)
        self.all = max(1, int(self.starts[-1]))

    def pairs(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (u + w) % self.all * self.all + w

    def words(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = pairs % self.all
        return (pairs // self.all - w) % self.all, w

    def pair_part(self, pairs: np.ndarray) -> np.ndarray:
        return pairs // self.all * self.n // self.all

    def numbers(self, asks: list) -> np.ndarray:
        """The numbers of a chunk's distinct words, from its letters by part."""
        return np.concatenate([self.starts[part] + places for part, places in asks])

    def by_part(self, words: np.ndarray) -> list[tuple[int, slice]]:
        """The parts of sorted words and where each part's lie."""
        return list(apart(np.searchsorted(self.starts, words, "right") - 1, self.n))


def ids_of(asks: pa.Table, numbering: Numbering) -> np.ndarray:
    rows = sorted(zip(asks.column("there").to_pylist(), asks.column("a").to_pylist()))
    return numbering.numbers([(part, rising(a)) for part, a in rows])


def with_context(ids: np.ndarray, place: np.ndarray, numbering: Numbering) -> np.ndarray:
    """The pair of each token and the one before it; before the first one is an end, the word of the least hash."""
    w = ids[place]
    return numbering.pairs(np.append(ids[0], w[:-1]), w)


def chunk_pairs(docs: DataFrame, asks: DataFrame, numbering: Numbering) -> DataFrame:
    """Letters of each chunk to the parts of its pairs: the distinct ones, a word after another, and their number in training texts."""
    import_here(docs)

    def run(table: pa.Table, asked: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        chunk, train = table.column("_chunk")[0].as_py(), trained(table)
        _, place, lengths = tokens_of(table.column("_text").combine_chunks())
        pairs, at = np.unique(with_context(ids_of(asked, numbering), place, numbering), return_inverse=True)
        count = np.bincount(at, np.repeat(train, lengths), len(pairs)).astype(np.int64)
        out = Letters()
        for part, s in apart(numbering.pair_part(pairs), numbering.n):
            out.add("told", chunk, part, increasing(pairs[s]), packed(count[s]))
        return out.table()

    left = docs.select("_chunk", "_train", "_text").groupBy("_chunk")
    return left.cogroup(asks.select("here", "there", "a").groupBy("here")).applyInArrow(run, Letters.SCHEMA)


def tell_tables(out: Letters, part: int, pairs: np.ndarray, c: np.ndarray, t: np.ndarray, seated: np.ndarray, numbering: Numbering) -> None:
    """Tell each word how many customers more than tables its pairs have: as the dish, as the context, and that on the mean."""
    u, w = numbering.words(pairs)
    words, place = np.unique(np.concatenate((u, w)), return_inverse=True)
    of_u, of_w = place[: len(u)], place[len(u) :]
    dish = np.bincount(of_w, c - t, len(words)).astype(np.int64)
    context = np.bincount(of_u, c - t, len(words)).astype(np.int64)
    mean = np.bincount(of_u, c - seated, len(words))
    for word_part_, s in numbering.by_part(words):
        own = increasing(words[s] - numbering.starts[word_part_])
        out.add("tables", part, word_part_, own, packed(dish[s]), packed(context[s]), floats(mean[s]))


def pairs_of(told: DataFrame, numbering: Numbering) -> DataFrame:
    """By part its ``pairs`` of several customers, with one table each, and ``tables`` for their words; ``asks``: what each chunk has.

    An ask has for each pair 0, 1 or 2 for no customer, one and several, and the places of the last.
    """

    def run(part: int, mail: Mail, out: Letters) -> None:
        letters = mail["told"]
        lists = [rising(m.a) for m in letters]
        distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
        c = np.bincount(place, np.concatenate([unpacked(m.b) for m in letters]), len(distinct)).astype(np.int64)
        several = c > 1
        kind, rank = np.minimum(c, 2).astype(np.uint8), np.cumsum(several) - 1
        ends = np.cumsum([len(x) for x in lists])
        for m, end, own in zip(letters, ends, lists):
            at = place[end - len(own) : end]
            out.add("asks", m.here, part, kind[at].tobytes(), increasing(rank[at[several[at]]]))
        pairs, c = distinct[several], c[several]
        ones = np.ones(len(c), np.int64)
        out.add("pairs", part, part, increasing(pairs), packed(c), packed(ones), floats(ones))
        tell_tables(out, part, pairs, c, ones, ones, numbering)

    return answered(told, run)


def codes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each word and its stop, flat, and where each word's begin."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    ends = bounds[1:] - bounds[0]
    first = np.concatenate(([0], ends[:-1]))
    # a stop closes each word, and as many stops as a context is long precede it
    spelled = np.insert(raw, ends, STOP)
    first, ends = first + np.arange(len(words)), ends + np.arange(len(words)) + 1
    padded = np.insert(spelled, np.repeat(first, CONTEXT), STOP)
    real = np.arange(len(spelled)) + np.repeat(np.arange(1, len(words) + 1), ends - first) * CONTEXT
    code = np.zeros(len(spelled), np.int64)
    for k in range(CONTEXT + 1):
        code |= padded[real - k].astype(np.int64) << (8 * k)
    return code, np.concatenate((first, ends[-1:]))


def code_part(codes: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` parts for each n-gram; those whose contexts end in the same bytes are in one."""
    subtree = (codes >> 8) & ((1 << 8 * TOP_LENGTH) - 1)
    return (mix(subtree.view(np.uint64)) % np.uint64(n)).astype(np.int64)


def dealt_codes(words: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of the words by part and value, their parts, the place of each n-gram, and where each word's begin."""
    code, bounds = codes_of(words)
    distinct, place = np.unique(code, return_inverse=True)
    part = code_part(distinct, n)
    order = np.argsort(part, kind="stable")
    new = np.empty(len(order), np.int64)
    new[order] = np.arange(len(order))
    return distinct[order], part[order], new[place], bounds


def customers(letters: DataFrame, n: int) -> DataFrame:
    """``words`` with their customers, the tables of all contexts, from ``words`` and ``tables``; ``codes``: n-grams over all tables."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["words"][0]
        c = unpacked(state.c)
        count = c.copy()
        for m in mail["tables"]:
            c[rising(m.a)] -= unpacked(m.b)
        tables = np.minimum(unpacked(state.d), c)
        out.add("words", part, part, state.a, state.b, state.c, packed(tables), packed(c), x=int(c.sum()), y=int(tables.sum()), z=int((count > 0).sum()))
        code, parts, place, bounds = dealt_codes(words_from(state.a, state.b), n)
        of_code = np.bincount(place, np.repeat(tables, np.diff(bounds)), len(code)).astype(np.int64)
        for to, s in apart(parts, n):
            out.add("codes", part, to, increasing(code[s]), packed(of_code[s]))

    return answered(letters, run)


def merged_codes(codes: DataFrame) -> DataFrame:
    """By part its ``codes`` and counts; ``asks``: places of the n-grams of each part of words; ``low``: distinct shorter n-grams by code ``x``."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        letters = mail["codes"]
        lists = [rising(m.a).astype(np.int64) for m in letters]
        distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
        c = np.bincount(place, np.concatenate([unpacked(m.b) for m in letters]), len(distinct)).astype(np.int64)
        out.add("codes", part, part, increasing(distinct), packed(c))
        ends = np.cumsum([len(x) for x in lists])
        for m, end, own in zip(letters, ends, lists):
            out.add("asks", m.here, part, increasing(place[end - len(own) : end]))
        low = np.unique(distinct[c > 0] & ((1 << 8 * (TOP_LENGTH + 1)) - 1)) & ((1 << 8 * TOP_LENGTH) - 1)
        for code, times in zip(*np.unique(low, return_counts=True)):
            out.add("low", part, part, x=int(code), y=int(times))

    return answered(codes, run)


class Top:
    """The restaurants of one byte of context and of none, on the driver: at most 65,536 dishes."""

    def __init__(self, rows: list[tuple[int, int]], random: np.random.Generator):
        codes = np.array(sorted(r[0] for r in rows), np.int64)
        self.levels, self.ups = chain(codes, TOP_LENGTH - 1, 0, DISCOUNTS, STRENGTH)
        self.levels[0].customers = np.array([c for _, c in sorted(rows)], np.int64)
        self.random = random
        self.base = np.full(len(self.levels[-1].codes), 1 / BYTES)

    def table(self) -> np.ndarray:
        """The averaged probability of each byte after each byte."""
        out = np.zeros((BYTES, BYTES))
        root = np.full(BYTES, 1 / BYTES)
        sweep(self.levels, self.ups, self.base, None)
        for k in range(BURN_IN + SAMPLES):
            if len(self.base):
                sweep(self.levels, self.ups, self.base, self.random)
            if k >= BURN_IN:
                low = self._dense(self.levels[-1], root[None, :], 1)[0]
                out += self._dense(self.levels[0], np.tile(low, (BYTES, 1)), BYTES) / SAMPLES
        return out

    @staticmethod
    def _dense(level: Level, parent: np.ndarray, contexts: int) -> np.ndarray:
        customers, tables = np.zeros((contexts, BYTES)), np.zeros((contexts, BYTES))
        context, dish = (level.codes >> 8) % contexts, level.codes & 255
        customers[context, dish], tables[context, dish] = level.customers, level.tables
        opened = level.strength + level.discount * tables.sum(axis=1, keepdims=True)
        return (customers - level.discount * tables + opened * parent) / (level.strength + customers.sum(axis=1, keepdims=True))


def spelling(merged: DataFrame, seed: int) -> DataFrame:
    """``chances`` for each part of words: the averaged probability of the last byte of its n-grams after the others."""
    spark = merged.sparkSession
    random = np.random.Generator(np.random.PCG64(seed))
    # at most one row for each pair of bytes
    found = merged.where("kind = 'low'").groupBy(F.col("x").cast("long")).agg(F.sum("y").cast("long"))
    shared = spark.sparkContext.broadcast(Top([tuple(r) for r in found.collect()], random).table())

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["codes"][0]
        code = rising(state.a).astype(np.int64)
        levels, ups = chain(code, CONTEXT, TOP_LENGTH, DISCOUNTS, STRENGTH)
        levels[0].customers = unpacked(state.b)
        low = levels[-1].codes
        base = shared.value[(low >> 8) & 255, low & 255]
        own = np.random.Generator(np.random.PCG64([seed, part]))
        sweep(levels, ups, base, None)
        p = np.zeros(len(code))
        for k in range(BURN_IN + SAMPLES):
            sweep(levels, ups, base, own)
            if k >= BURN_IN:
                p += levels[0].predict(predictions(levels, ups, base)[0]) / SAMPLES
        for m in mail["asks"]:
            out.add("chances", part, m.here, floats(p[rising(m.a)]))

    return answered(merged.where("kind <> 'low'"), run)


def spelled(letters: DataFrame, n: int, tables_before: int, seed: int) -> DataFrame:
    """``words`` with drawn tables, the probability of their spelling and mean tables, from ``words`` and ``chances``."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["words"][0]
        before, count = unpacked(state.d), unpacked(state.e)
        _, _, place, bounds = dealt_codes(words_from(state.a, state.b), n)
        p = np.concatenate([numbers(m.a) for m in mail["chances"]])
        own_spelling = np.maximum(np.exp(np.add.reduceat(np.log(p[place]), bounds[:-1])), 1e-300)
        own = np.random.Generator(np.random.PCG64([seed, part]))
        stirling = log_stirling(WORD_DISCOUNT)
        others = np.maximum(tables_before - before, 0)
        draws = [seat(count, others, own_spelling, WORD_DISCOUNT, STRENGTH, stirling, own) for _ in range(BURN_IN + SAMPLES)]
        mean = np.mean(draws[BURN_IN:], axis=0)
        columns = state.a, state.b, state.c, packed(draws[-1]), state.e, own_spelling.tobytes(), floats(mean)
        out.add("words", part, part, *columns, x=float(mean.sum()), y=float(own_spelling[count > 0].sum()))

    return answered(letters, run)


def exact(state, customers_: int, tables: float) -> np.ndarray:
    """The probability of each word of a letter without a context."""
    new = (STRENGTH + WORD_DISCOUNT * tables) / (STRENGTH + customers_)
    own = (unpacked(state.e) - WORD_DISCOUNT * numbers(state.g)) / (STRENGTH + customers_)
    return own + new * np.frombuffer(state.f, np.float64)


def parents(letters: DataFrame, customers_: int, tables: float) -> DataFrame:
    """``parents`` for each part of pairs: the probability without a context and the tables as a context of its words."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["words"][0]
        p, opened = exact(state, customers_, tables), unpacked(state.c)
        for m in mail["tables"]:
            opened[rising(m.a)] -= unpacked(m.c)
        for m in mail["tables"]:
            at = rising(m.a)
            out.add("parents", part, m.here, floats(p[at]), packed(opened[at]))

    return answered(letters, run)


def seated_pairs(letters: DataFrame, numbering: Numbering, seed: int) -> DataFrame:
    """``pairs`` with drawn and mean tables, and ``tables`` for their words, from ``pairs`` and ``parents``."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["pairs"][0]
        pairs, c, t = rising(state.a).astype(np.int64), unpacked(state.b), unpacked(state.c)
        mean = np.ones(len(c))
        if len(pairs):
            u, w = numbering.words(pairs)
            _, place = np.unique(np.concatenate((u, w)), return_inverse=True)
            of_u, of_w = place[: len(u)], place[len(u) :]
            parent = np.maximum(np.concatenate([numbers(m.a) for m in mail["parents"]])[of_w], 1e-300)
            others = np.maximum(np.concatenate([unpacked(m.b) for m in mail["parents"]])[of_u] - t, 0)
            own = np.random.Generator(np.random.PCG64([seed, part]))
            stirling = log_stirling(PAIR_DISCOUNT)
            draws = [seat(c, others, parent, PAIR_DISCOUNT, STRENGTH, stirling, own) for _ in range(BURN_IN + SAMPLES)]
            t, mean = draws[-1], np.mean(draws[BURN_IN:], axis=0)
        out.add("pairs", part, part, state.a, state.b, packed(t), floats(mean))
        tell_tables(out, part, pairs, c, t, mean, numbering)

    return answered(letters, run)


def only(letters: DataFrame, *kinds: str) -> DataFrame:
    return letters.where(F.col("kind").isin(*kinds))


def learned(
    vocabulary: DataFrame, pairs: DataFrame, numbering: Numbering, rounds: int = ROUNDS, seed: int = 11
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """``words`` with their spelling and mean tables, ``pairs`` and ``tables`` with mean tables, and sums.

    ``unseen`` is the probability of all unseen words.
    """
    tokens = int(only(vocabulary, "words").agg(F.sum("y")).first()[0] or 0)
    state, seated = only(vocabulary, "words"), only(pairs, "pairs", "tables")
    drawn: tuple[DataFrame, ...] = ()
    for k in range(rounds):
        counted = written(customers(state.union(only(seated, "tables")), numbering.n), "customers")
        merged = written(merged_codes(only(counted, "codes")), "code-counts")
        # one row of sums
        sums = only(counted, "words").agg(F.sum("x"), F.sum("y"), F.sum("z")).first()
        customers_, tables_before, distinct = (int(x or 0) for x in sums)
        chances = spelling(merged, seed + k)
        state = written(spelled(only(counted, "words").union(chances), numbering.n, tables_before, seed + 100 + k), "words")
        tables, covered = (float(x or 0) for x in state.agg(F.sum("x"), F.sum("y")).first())
        asked = parents(state.union(only(seated, "tables")), customers_, tables)
        seated = written(seated_pairs(only(seated, "pairs").union(asked), numbering, seed + 200 + k), "seated-pairs")
        discard(counted, merged, *drawn)
        drawn = state, seated
    unseen = (STRENGTH + WORD_DISCOUNT * tables) / (STRENGTH + customers_) * max(1.0 - covered, 1e-12)
    sums = {"customers": tokens, "distinct": distinct, "unseen": unseen, "seated": customers_, "tables": tables}
    return state, seated, sums


def word_answers(letters: DataFrame, sums: dict[str, float]) -> DataFrame:
    """``word`` for each chunk: count, probability and mean tables as a context of its words, from ``words``, ``tables`` and ``asks``."""
    customers_, tables = sums["seated"], sums["tables"]

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["words"][0]
        n, p = unpacked(state.c), exact(state, customers_, tables)
        opened = n.astype(float)
        for m in mail["tables"]:
            opened[rising(m.a)] -= numbers(m.d)
        for m in mail["asks"]:
            at = rising(m.a)
            out.add("word", part, m.here, m.a, packed(n[at]), floats(p[at]), floats(opened[at]))

    return answered(letters, run)


def pair_answers(letters: DataFrame) -> DataFrame:
    """``pair`` for each chunk: the customers of its pairs without what their tables pass on, from ``pairs`` and ``asks``."""

    def run(part: int, mail: Mail, out: Letters) -> None:
        state = mail["pairs"][0]
        kept_of = unpacked(state.b) - PAIR_DISCOUNT * numbers(state.d)
        for m in mail["asks"]:
            kind = np.frombuffer(m.a, np.uint8)
            out.add("pair", part, m.here, m.a, floats(kept_of[rising(m.b)]))

    return answered(letters, run)


def scored(docs: DataFrame, train: Column, *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[str, float]]:
    """``key, n_tokens, n_known`` and three scores of every document, and sums of the model; only rows with ``train`` teach."""
    import_here(docs)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), whole.alias("_text"), F.coalesce(train, F.lit(False)).alias("_train"))
    n = n_chunks(rows, F.octet_length("_text") + 1, CHUNK_BYTES)
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64("_key", "_text"), F.lit(n)).cast("int"))
    vocabulary = written(vocabulary_of(chunk_words(dealt, n)), "vocabulary")
    # one row for each part
    sizes = only(vocabulary, "words").select("there", "x").collect()
    numbering = Numbering({part: int(size) for part, size in sizes}, n)
    asks = only(vocabulary, "asks")
    counted = written(pairs_of(chunk_pairs(dealt, asks, numbering), numbering), "pairs")
    words, pairs, sums = learned(vocabulary, counted, numbering)
    of_words = word_answers(words.union(only(pairs, "tables")).union(asks), sums)
    of_pairs = pair_answers(only(pairs, "pairs").union(only(counted, "asks")))
    answers = of_words.union(of_pairs).withColumnRenamed("there", "_chunk")
    smoothed = sums["customers"] + sums["distinct"] + 1.0
    kind = docs.schema[key].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        mail = Mail(right)
        table = left.combine_chunks()
        texts = table.column("_text").combine_chunks()
        _, place, lengths = tokens_of(texts)
        of_word, of_pair = mail["word"], mail["pair"]
        ids = numbering.numbers([(m.here, rising(m.a)) for m in of_word])
        counts = np.concatenate([unpacked(m.b) for m in of_word])
        # the smallest floats stand for spellings that are rarer still
        exact_ = np.maximum(np.concatenate([numbers(m.c) for m in of_word]), 1e-45)
        opened = np.concatenate([numbers(m.d) for m in of_word])
        parents_ = {"score": np.where(counts > 0, exact_, sums["unseen"]), "spelled_score": exact_}
        base = np.log10((counts + 1) / smoothed)
        # what a word's restaurant gives to its parent, and keeps for each pair
        passed = (STRENGTH + PAIR_DISCOUNT * opened) / (STRENGTH + counts)
        kinds = np.concatenate([np.frombuffer(m.a, np.uint8) for m in of_pair])
        kept = np.where(kinds == 1, 1 - PAIR_DISCOUNT, 0.0)
        kept[kinds == 2] = np.concatenate([numbers(m.b) for m in of_pair])
        _, at = np.unique(with_context(ids, place, numbering), return_inverse=True)
        before = np.append(0, place[:-1])
        alone = kept[at] / (STRENGTH + counts[before])
        own, n_docs = np.repeat(np.arange(len(texts)), lengths), len(texts)
        columns = {
            key: table.column("_key"),
            "n_tokens": lengths,
            "n_known": np.bincount(own, counts[place] > 0, n_docs).astype(np.int64),
            "base_score": np.bincount(own, base[place], n_docs),
        }
        for name, parent in parents_.items():
            columns[name] = np.bincount(own, np.log10(alone + passed[before] * parent[place]), n_docs)
        return pa.table(columns)

    schema = f"`{key}` {kind}, n_tokens long, n_known long, base_score double, score double, spelled_score double"
    result = (
        dealt.select("_chunk", "_key", "_text").groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(run, schema)
    )
    return result, sums
