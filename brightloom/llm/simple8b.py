"""Simple-8b: integers in 64-bit words, each with a selector of 4 bits and 60 bits of values of one width.

Values are coded in blocks of ``BLOCK``, each of whole words, so that any block is decoded by itself and all
blocks of an array at once. A value of more than 60 bits is an escape: the block has a zero in its place, and the
place and the value stand after the words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 8192
BLOCKS_AT_ONCE = 64

# fixed values: how many integers a word of each selector holds, and of how many bits
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
SELECTOR_SHIFT = np.uint64(60)
WIDEST = 60

_ROOM = BLOCK + int(COUNTS[0])  # the last word of a block may reach past its end


@dataclass
class Coded:
    """``words`` of neighbouring blocks; ``n_words`` and ``n_escapes`` of each; escapes by place in the block."""

    n_values: int
    words: np.ndarray
    n_words: np.ndarray
    n_escapes: np.ndarray
    escape_places: np.ndarray
    escape_values: np.ndarray


def _selectors(widths: np.ndarray) -> np.ndarray:
    """For each place the selector of the most values that fit a word from there on."""
    best = np.full((len(widths), BLOCK), len(BITS) - 1, np.int8)
    over = np.zeros((len(widths), _ROOM + 1), np.int32)
    for selector in range(len(BITS) - 2, -1, -1):
        count = COUNTS[selector]
        # the number of too wide values before each place
        np.cumsum(widths > BITS[selector], axis=1, out=over[:, 1:])
        best[over[:, count : count + BLOCK] == over[:, :BLOCK]] = selector
    return best


def encode(values: np.ndarray) -> Coded:
    """Code unsigned 64-bit integers; all blocks but the last are full."""
    values = np.asarray(values, np.uint64)
    parts = [_encode(values[at : at + BLOCK * BLOCKS_AT_ONCE]) for at in range(0, len(values), BLOCK * BLOCKS_AT_ONCE)]
    if not parts:
        none = np.empty(0, np.int64)
        return Coded(0, none.astype(np.uint64), none, none, none, none.astype(np.uint64))
    fields = ("words", "n_words", "n_escapes", "escape_places", "escape_values")
    return Coded(len(values), *(np.concatenate([getattr(p, f) for p in parts]) for f in fields))


def _encode(values: np.ndarray) -> Coded:
    n_blocks = -(-len(values) // BLOCK)
    grid = np.zeros((n_blocks, _ROOM), np.uint64)
    flat = np.zeros(n_blocks * BLOCK, np.uint64)
    flat[: len(values)] = values
    grid[:, :BLOCK] = flat.reshape(n_blocks, BLOCK)
    # rounding may make a width one too large, never too small
    widths = np.frexp(grid.astype(np.float64))[1]
    escape_rows, escape_places = np.nonzero(widths > WIDEST)
    escape_values = grid[escape_rows, escape_places]
    grid[escape_rows, escape_places] = 0
    widths[escape_rows, escape_places] = 0

    best = _selectors(widths)
    lengths = np.full(n_blocks, BLOCK)
    lengths[-1] = len(values) - (n_blocks - 1) * BLOCK
    # all blocks go on by one word at a time
    rows, at = np.arange(n_blocks), np.zeros(n_blocks, np.int64)
    chosen = []
    while len(rows):
        selector = best[rows, at]
        chosen.append((rows, at, selector))
        at = at + COUNTS[selector]
        left = at < lengths[rows]
        rows, at = rows[left], at[left]
    rows, at, selector = (np.concatenate(x) for x in zip(*chosen))
    order = np.lexsort((at, rows))
    rows, at, selector = rows[order], at[order], selector[order]

    words = selector.astype(np.uint64) << SELECTOR_SHIFT
    for kind in np.unique(selector):
        if BITS[kind] == 0:
            continue
        here = np.flatnonzero(selector == kind)
        r, a = rows[here], at[here]
        for k in range(COUNTS[kind]):
            words[here] |= grid[r, a + k] << np.uint64(BITS[kind] * k)
    return Coded(
        len(values),
        words,
        np.bincount(rows, minlength=n_blocks),
        np.bincount(escape_rows, minlength=n_blocks),
        escape_places.astype(np.int64),
        escape_values,
    )


def decode(coded: Coded) -> np.ndarray:
    """The integers again; every step works on all words of one selector at once."""
    n_blocks = len(coded.n_words)
    out = np.zeros((n_blocks, _ROOM), np.uint64)
    selector = (coded.words >> SELECTOR_SHIFT).astype(np.int64)
    counts = COUNTS[selector]
    before = np.cumsum(counts) - counts
    first = np.cumsum(coded.n_words) - coded.n_words
    block = np.repeat(np.arange(n_blocks), coded.n_words)
    begins = before - before[first][block] + block * _ROOM
    flat = out.reshape(-1)
    for kind in np.unique(selector):
        width, count = int(BITS[kind]), int(COUNTS[kind])
        if width == 0:
            continue
        here = np.flatnonzero(selector == kind)
        words, places = coded.words[here], begins[here]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            flat[places + k] = (words >> np.uint64(width * k)) & mask
    out[np.repeat(np.arange(n_blocks), coded.n_escapes), coded.escape_places] = coded.escape_values
    return out[:, :BLOCK].reshape(-1)[: coded.n_values]
