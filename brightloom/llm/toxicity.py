"""Toxicity by a factorization machine over hashed terms.

A text is the set of its lower-cased words and of the beginnings of longer ones, which inflected words of
one stem have in common, hashed into slots. The machine adds a weight for each term and, for each pair of terms, the product of two short vectors, so that an insult next to the
mention of a group can weigh more than both alone. It is fitted on a bounded sample of labelled
rows by steps scaled to past gradients, in which toxic rows weigh more, as they are few; the size of the model is fixed by its slots, and every task
gets it by one broadcast of that size.

Defined results: null and empty texts have no terms and score the intercept; rows without a label
teach nothing; with no labelled rows the score is one half everywhere; repeated keys and rows are
rows like any others; further columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.numbering import hash_of
from brightloom.llm.textkit import ALNUM, Block, Words, blocks, keyed, lists, map_texts, mix

SLOT_BITS = 18
FACTORS = 8
MOST_LABELS = 8_000
#: Bytes of the beginnings of words that are terms of their own.
BEGINNINGS = (4, 6)
TOXIC_WEIGHT = 4.0


def terms_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of the words of each document and of their beginnings, and where each document's begin."""
    low = block.lower()
    words = low.words(ALNUM)
    kinds = [words.hashes()]
    for n in BEGINNINGS:
        begun = Words(low, words.starts, np.minimum(words.ends, words.starts + n))
        kinds.append(mix(begun.hashes() + np.uint64(n)))
    docs = words.docs().astype(np.uint64) << np.uint64(SLOT_BITS)
    own = np.unique(np.concatenate([docs | (hashes >> np.uint64(64 - SLOT_BITS)) for hashes in kinds]))
    bounds = np.searchsorted(own >> np.uint64(SLOT_BITS), np.arange(block.n_docs + 1).astype(np.uint64))
    return (own & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64), bounds


def document_terms(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, terms``: the distinct slots of each text."""
    schema = keyed(docs, [key], "terms array<int>")

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        for block in blocks(texts):
            slots, bounds = terms_of(block)
            yield {key: keys[key][block.first_row : block.first_row + block.n_docs], "terms": lists(slots.astype(np.int32), bounds)}

    return map_texts(docs, [key], text, schema, per_batch)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class FactorizationMachine:
    intercept: float
    weights: np.ndarray  # by slot
    factors: np.ndarray  # by slot and factor

    def raw(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The score before the link, for documents given as flat slots."""
        docs = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        active = (self.weights[slots] != 0) | self.factors[slots].any(axis=1)
        slots, docs = slots[active], docs[active]
        n = len(bounds) - 1
        out = self.intercept + np.bincount(docs, self.weights[slots], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[slots, f]
            out += 0.5 * (np.bincount(docs, v, n) ** 2 - np.bincount(docs, v * v, n))
        return out

    def scores(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(slots, bounds))


def fit(
    slots: np.ndarray,
    bounds: np.ndarray,
    toxic: np.ndarray,
    *,
    linear_epochs: int = 20,
    epochs: int = 10,
    rate: float = 0.2,
    penalty: float = 2e-3,
    shrinkage: float = 5e-2,
    least_docs: int = 3,
    toxic_weight: float = 1.0,
    seed: int = 7,
    batch: int = 64,
) -> FactorizationMachine:
    """Fit by mini-batches: the weights alone at first, then weights and vectors together.

    The penalty shrinks weights to zero, so that chance terms drop out; only terms that keep a
    weight after the first part get a vector. A toxic row counts as ``toxic_weight`` others.
    """
    random = np.random.Generator(np.random.PCG64(seed))
    size = 1 << SLOT_BITS
    n = len(bounds) - 1
    model = FactorizationMachine(0.0, np.zeros(size), np.zeros((size, FACTORS)))
    if not n:
        return model
    docs = np.repeat(np.arange(n), np.diff(bounds))
    frequent = np.bincount(slots, minlength=size)[slots] >= least_docs
    slots, docs = slots[frequent], docs[frequent]
    # terms are renumbered, so that a step costs what its documents hold
    used, terms = np.unique(slots, return_inverse=True)
    share = np.clip(toxic.mean(), 1e-3, 1 - 1e-3)
    state = _State(float(np.log(share / (1 - share))), np.zeros(len(used)), np.zeros((len(used), FACTORS)))
    weight = np.where(toxic > 0, toxic_weight, 1.0)
    for epoch in range(linear_epochs + epochs):
        if epoch == linear_epochs:
            kept = state.w != 0
            state.v[kept] = random.normal(0, 0.05, (kept.sum(), FACTORS))
            in_use = kept[terms]
            terms, docs = terms[in_use], docs[in_use]
        edges = np.searchsorted(docs, np.arange(n + 1))
        order = random.permutation(n)
        for at in range(0, n, batch):
            chosen = order[at : at + batch]
            lengths = edges[chosen + 1] - edges[chosen]
            first = edges[chosen] - np.cumsum(lengths) + lengths
            flat = np.repeat(first, lengths) + np.arange(lengths.sum())
            row = np.repeat(np.arange(len(chosen)), lengths)
            state.step(row, terms[flat], toxic[chosen], weight[chosen], rate, penalty, shrinkage, pairs=epoch >= linear_epochs)
    model.intercept = state.intercept
    model.weights[used] = state.w
    model.factors[used] = state.v
    return model


class _State:
    """Parameters and the sums of their squared gradients."""

    def __init__(self, intercept: float, w: np.ndarray, v: np.ndarray):
        self.intercept, self.w, self.v = intercept, w, v
        self.seen_0, self.seen_w, self.seen_v = 1e-2, np.full(w.shape, 1e-3), np.full(v.shape, 1e-3)

    def step(self, row, term, toxic, weight, rate: float, penalty: float, shrinkage: float, pairs: bool) -> None:
        m = len(toxic)
        z = self.intercept + np.bincount(row, self.w[term], m)
        if pairs:
            sums = np.stack([np.bincount(row, self.v[term, f], m) for f in range(FACTORS)], axis=1)
            squares = np.bincount(row, (self.v[term] ** 2).sum(axis=1), m)
            z += 0.5 * ((sums**2).sum(axis=1) - squares)
        error = weight * (sigmoid(z) - toxic)
        touched, local = np.unique(term, return_inverse=True)
        g = np.bincount(local, error[row], len(touched)) / m
        self.seen_w[touched] += g * g
        pace = rate / np.sqrt(self.seen_w[touched])
        moved = self.w[touched] - pace * g
        self.w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - pace * penalty, 0)
        if pairs:
            pull = error[row, None] * (sums[row] - self.v[term])
            for f in range(FACTORS):
                gf = np.bincount(local, pull[:, f], len(touched)) / m + shrinkage * self.v[touched, f]
                self.seen_v[touched, f] += gf * gf
                self.v[touched, f] -= 0.2 * rate * gf / np.sqrt(self.seen_v[touched, f])
        g0 = float(error.mean())
        self.seen_0 += g0 * g0
        self.intercept -= rate * g0 / np.sqrt(self.seen_0)


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", *, key: str = "doc_id", text: str = "text", most_labels: int = MOST_LABELS
) -> FactorizationMachine:
    """Fit on at most ``most_labels`` labelled documents, chosen by the hash of their keys."""
    sample = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key).alias("_label_key"), F.col(label).cast("int").alias("_label"))
        .orderBy(hash_of("toxicity", F.col("_label_key")), "_label_key", "_label")
        .limit(most_labels)
    )
    # keys and labels of at most ``most_labels`` rows
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_body")).join(
        F.broadcast(sample), F.col("_key") == F.col("_label_key")
    )
    labelled = chosen.select(F.struct("_key", "_label").alias("_pair"), "_body")
    rows = (
        document_terms(labelled, key="_pair", text="_body")
        .orderBy(hash_of("rows", F.col("_pair")["_key"]), "_pair", "terms")
        .limit(most_labels)
        .toArrow()
    )
    terms = rows["terms"].combine_chunks()
    toxic = np.array([p["_label"] for p in rows["_pair"].to_pylist()], float)
    bounds = terms.offsets.to_numpy().astype(np.int64) if len(terms) else np.zeros(1, np.int64)
    flat = terms.values.to_numpy(zero_copy_only=False).astype(np.int64) if len(terms) else np.empty(0, np.int64)
    return fit(flat, bounds, toxic, toxic_weight=TOXIC_WEIGHT)


def scored(docs: DataFrame, model: FactorizationMachine, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score``: how likely the label is 1 for each whole text."""
    schema = keyed(docs, [key], "score double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        for block in blocks(texts):
            rows = slice(block.first_row, block.first_row + block.n_docs)
            yield {key: keys[key][rows], "score": shared.value.scores(*terms_of(block))}

    return map_texts(docs, [key], text, schema, per_batch)
