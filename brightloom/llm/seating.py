"""Seating of a hierarchical Pitman-Yor process over byte n-grams, on arrays.

A restaurant is a context of bytes, its parent the context without the farthest byte. Of each dish
(the next byte) in a restaurant only the customers and their tables are kept; a table is a customer
of the parent. An n-gram is one integer: the next byte lowest, then the nearest byte of the context.
"""

from __future__ import annotations

import numpy as np

BYTES = 256
SMALL = 24


def log_stirling(discount: float, most: int = SMALL) -> np.ndarray:
    """Logarithms of the generalized Stirling numbers: ways of ``c`` customers at ``t`` tables."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(1, most + 1):
        for t in range(1, c + 1):
            stay = table[c - 1, t] + (np.log(c - 1 - discount * t) if c - 1 > discount * t else -np.inf)
            table[c, t] = np.logaddexp(table[c - 1, t - 1], stay)
    return table


def seat(
    customers: np.ndarray,
    others: np.ndarray,
    parent: np.ndarray,
    discount: float,
    strength: float,
    stirling: np.ndarray,
    random: np.random.Generator,
) -> np.ndarray:
    """A Gibbs draw of the tables of each dish, given the restaurant's ``others`` and the parent's probability.

    Up to ``SMALL`` customers the conditional distribution is enumerated. More are seated one after
    another as the restaurant's rule says, in steps of an eighth of those seated.
    """
    tables = np.minimum(customers, 1)
    for c in np.unique(customers[(customers > 1) & (customers <= SMALL)]):
        rows = np.flatnonzero(customers == c)
        opened = np.log(strength + discount * (others[rows, None] + np.arange(c))).cumsum(axis=1)
        weight = stirling[c, 1 : c + 1] + opened + np.log(parent[rows, None]) * np.arange(1, c + 1)
        tables[rows] = 1 + np.argmax(weight + random.gumbel(size=weight.shape), axis=1)
    rows = np.flatnonzero(customers > SMALL)
    left, seated, t = customers[rows], np.ones(len(rows), np.int64), np.ones(len(rows), np.int64)
    while len(rows) and (open_ := seated < left).any():
        step = np.where(open_, np.minimum(np.maximum(seated // 8, 1), left - seated), 0)
        new = (strength + discount * (others[rows] + t)) * parent[rows]
        t += random.binomial(step, new / (new + seated - discount * t))
        seated += step
    tables[rows] = t
    return tables


class Level:
    """Dishes of all restaurants of one context length, sorted; ``up`` is the place of each in the parent's level."""

    def __init__(self, codes: np.ndarray, discount: float, strength: float):
        self.codes, self.discount, self.strength = codes, discount, strength
        self.stirling = log_stirling(discount)
        first = np.flatnonzero(np.concatenate(([True], codes[1:] >> 8 != codes[:-1] >> 8))) if len(codes) else np.empty(0, np.int64)
        self.first, self.sizes = first, np.diff(np.append(first, len(codes)))
        self.customers = self.tables = np.zeros(len(codes), np.int64)

    def total(self, values: np.ndarray) -> np.ndarray:
        """The sum over each dish's restaurant."""
        return np.repeat(np.add.reduceat(values, self.first), self.sizes) if len(values) else values

    def sample(self, parent: np.ndarray, random: np.random.Generator) -> None:
        others = self.total(self.tables) - self.tables
        self.tables = seat(self.customers, others, parent, self.discount, self.strength, self.stirling, random)

    def predict(self, parent: np.ndarray) -> np.ndarray:
        """The probability of each dish; a restaurant without customers asks its parent."""
        everyone = self.total(self.customers)
        own = self.customers - self.discount * self.tables
        return (own + (self.strength + self.discount * self.total(self.tables)) * parent) / (self.strength + everyone)


def chain(codes: np.ndarray, longest: int, shortest: int, discounts: list[float], strength: float) -> tuple[list[Level], list[np.ndarray]]:
    """Levels of context lengths ``longest`` down to ``shortest``, and where the dishes of each stand in the next."""
    levels, ups = [Level(codes, discounts[longest], strength)], []
    for length in range(longest - 1, shortest - 1, -1):
        shorter, up = np.unique(levels[-1].codes & ((1 << 8 * (length + 1)) - 1), return_inverse=True)
        levels.append(Level(shorter, discounts[length], strength))
        ups.append(up)
    return levels, ups


def sweep(levels: list[Level], ups: list[np.ndarray], base: np.ndarray, random: np.random.Generator | None) -> None:
    """Reseat all levels from the longest contexts up; without ``random``, with one table for each dish."""
    above = predictions(levels, ups, base) if random is not None else None
    for k, level in enumerate(levels):
        if random is None:
            level.tables = np.minimum(level.customers, 1)
        else:
            level.sample(above[k], random)
        if k < len(ups):
            levels[k + 1].customers = np.bincount(ups[k], level.tables, len(levels[k + 1].codes)).astype(np.int64)


def predictions(levels: list[Level], ups: list[np.ndarray], base: np.ndarray) -> list[np.ndarray]:
    """For each level the probability that the parent gives to its dishes; ``base`` is that of the shortest."""
    above = [base]
    for k in range(len(levels) - 1, 0, -1):
        above.append(levels[k].predict(above[-1])[ups[k - 1]])
    return above[::-1]
