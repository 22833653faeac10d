"""Quality rules learned from labels: decision lists by sequential covering.

One pass over the whole texts gives counts per document. On the labelled rows of a bounded sample, rules are grown one threshold at a time by information gain over a part of the rows,
pruned on the others, and kept while they are precise; the rows a rule covers leave before the next
is grown. The list is plain text and becomes one ordered conditional expression of Spark columns.

Defined results: a null text has no words; rows without a label (null or missing) teach nothing;
without both labels the list is empty and keeps everything; repeated keys and rows are rows like
any others; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.numbering import hash_of
from brightloom.llm.textkit import NON_SPACE, Block, Words, blocks, bytes_where, keyed, map_texts, window_hashes

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_chars",
    "n_upper",
    "n_digits",
    "n_marks",
)
#: What rules may test, as SQL over the counts.
STATISTICS = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "repeated_lines_share": "n_dup_lines / greatest(n_lines, 1)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "words": "CAST(n_words AS DOUBLE)",
}

_SYMBOLS = bytes_where(lambda b: chr(b) in "#*$%&|<>")
_UPPER = bytes_where(lambda b: 65 <= b <= 90)
_DIGIT = bytes_where(lambda b: 48 <= b <= 57)
_MARKS = bytes_where(lambda b: chr(b) in "!?")
_CHARACTER_BEGINS = bytes_where(lambda b: b & 0xC0 != 0x80)
REPEATED_WINDOW = 3


def _per_doc(block: Block, flags: np.ndarray) -> np.ndarray:
    # every document has its closing space at least
    return np.add.reduceat(flags, block.bounds[:-1], dtype=np.int64)


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    repeated = np.zeros(len(keys), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return repeated


def repeated_words(words: Words) -> np.ndarray:
    """For each document its words in windows that occur twice or more in it."""
    docs = words.docs()
    hashes = window_hashes(words.hashes(), REPEATED_WINDOW)
    first = np.flatnonzero(docs[: len(hashes)] == docs[REPEATED_WINDOW - 1 :]) if len(hashes) else np.empty(0, int)
    own = hashes[first] + docs[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    starts = first[_twice(own)]
    marked = np.zeros(len(words), bool)
    for k in range(REPEATED_WINDOW):
        marked[starts + k] = True
    return np.bincount(docs[marked], minlength=words.block.n_docs)


def lines(block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each document its lines with a word, and how many of them equal an earlier one."""
    ends = np.union1d(np.flatnonzero(block.data == 10), block.bounds[1:] - 1)
    every = Words(block, np.concatenate(([0], ends[:-1] + 1)), ends)
    with_word = np.searchsorted(words.starts, every.ends) > np.searchsorted(words.starts, every.starts)
    docs = every.docs()[with_word]
    n_lines = np.bincount(docs, minlength=block.n_docs)
    own = every.hashes()[with_word] + docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first = np.unique(own, return_index=True)
    return n_lines, n_lines - np.bincount(docs[first], minlength=block.n_docs)


def counts_of(block: Block) -> dict[str, np.ndarray]:
    words = block.words(NON_SPACE)
    begins = _CHARACTER_BEGINS[block.data]
    n_lines, n_dup_lines = lines(block, words)
    return {
        "n_words": words.counts,
        "word_chars": _per_doc(block, begins & NON_SPACE[block.data]),
        "n_symbols": _per_doc(block, _SYMBOLS[block.data]),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": repeated_words(words),
        "n_lines": n_lines,
        "n_chars": _per_doc(block, begins) - 1,
        "n_upper": _per_doc(block, _UPPER[block.data]),
        "n_digits": _per_doc(block, _DIGIT[block.data]),
        "n_marks": _per_doc(block, _MARKS[block.data]),
    }


def text_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``COUNTS`` of each whole text."""
    schema = keyed(docs, [key], ", ".join(f"{name} long" for name in COUNTS))

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        for block in blocks(texts):
            yield {key: keys[key][block.first_row : block.first_row + block.n_docs], **counts_of(block)}

    return map_texts(docs, [key], text, schema, per_batch)


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.statistic]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"({STATISTICS[self.statistic]}) {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions; what it covers is rejected."""

    conditions: tuple[Condition, ...]

    def covers(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(values) for c in self.conditions])

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def keeps(rules: list[Rule]) -> Column:
    """The list as one ordered conditional over the columns of ``COUNTS``: false where a rule covers."""
    verdict = None
    for rule in rules:
        covered = F.expr(str(rule))
        verdict = F.when(covered, False) if verdict is None else verdict.when(covered, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the largest gain in information about the rows covered so far."""
    p, n = bad.sum(), (~bad).sum()
    best: tuple[float, Condition | None] = (1e-9, None)
    before = np.log2(p / (p + n))
    for name, x in values.items():
        order = np.argsort(x, kind="stable")
        at = x[order]
        cuts = np.flatnonzero(at[1:] > at[:-1])
        if not len(cuts):
            continue
        below_p = np.cumsum(bad[order])[cuts]
        below_n = cuts + 1 - below_p
        for above, inside_p, inside_n in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
            share = np.where(inside_p > 0, inside_p / np.maximum(inside_p + inside_n, 1), 1e-12)
            gain = inside_p * (np.log2(share) - before)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                middle = float((at[cuts[k]] + at[cuts[k] + 1]) / 2)
                best = (float(gain[k]), Condition(name, above, middle))
    return best


def _subset(values: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {name: x[rows] for name, x in values.items()}


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, most: int = 6) -> Rule | None:
    conditions: list[Condition] = []
    while len(conditions) < most and not bad.all():
        _, condition = _best_condition(values, bad)
        if condition is None:
            break
        inside = condition.holds(values)
        values, bad = _subset(values, inside), bad[inside]
        conditions.append(condition)
    return Rule(tuple(conditions)) if conditions else None


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that tells the rows held back apart as well as any."""

    def worth(k: int) -> float:
        inside = Rule(rule.conditions[:k]).covers(values)
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    lengths = range(1, len(rule.conditions) + 1)
    best = max(map(worth, lengths))
    return Rule(rule.conditions[: next(k for k in lengths if worth(k) == best)])


def decision_list(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    *,
    most_rules: int = 12,
    least_rows: int = 3,
    least_precision: float = 0.9,
) -> list[Rule]:
    """Rules for the bad rows, by sequential covering; every third row is held back for pruning."""
    rules: list[Rule] = []
    held = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules and bad[~held].any():
        rule = _grow(_subset(values, ~held), bad[~held])
        if rule is None:
            break
        if bad[held].any():
            rule = _prune(rule, _subset(values, held), bad[held])
        covered = rule.covers(values)
        if bad[covered].sum() < least_rows or bad[covered].mean() < least_precision:
            break
        rules.append(rule)
        values, bad, held = _subset(values, ~covered), bad[~covered], held[~covered]
    return rules


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    *,
    key: str = "doc_id",
    text: str = "text",
    most_labels: int = 20_000,
) -> list[Rule]:
    """Rules from at most ``most_labels`` labelled rows, chosen by the hash of their keys; label 0 is bad."""
    sample = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key).alias("_label_key"), F.col(label).cast("int").alias("_label"))
        .orderBy(hash_of("rules", F.col("_label_key")), "_label_key", "_label")
        .limit(most_labels)
    )
    # keys and labels of at most ``most_labels`` rows
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_body")).join(
        F.broadcast(sample), F.col("_key") == F.col("_label_key")
    )
    counted = text_counts(chosen.select(F.struct("_key", "_label").alias("_pair"), "_body"), key="_pair", text="_body")
    rows = (
        counted.select("_pair.*", *(F.expr(sql).alias(name) for name, sql in STATISTICS.items()))
        .orderBy(hash_of("rows", F.col("_key")), "_key", *STATISTICS)
        .limit(most_labels)
        .toPandas()
    )
    values = {name: rows[name].to_numpy(float) for name in STATISTICS}
    return decision_list(values, (rows["_label"] == 0).to_numpy())


def judged(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """The counts with ``base_failed`` and ``kept``."""
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return counts.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & keeps(rules))
