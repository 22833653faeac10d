"""Exact token counts of whole texts and of all their prefixes, by prefix dynamic programming.

A byte-level BPE first cuts a text into pieces by a fixed pattern and encodes each on its own, so the
count at the end of a piece is the count at its start plus the piece's own count, which is encoded
once and remembered. Only pieces of white space depend on what follows them; the ends of all others
are *safe*: the pieces before them are the same in every longer prefix. For any prefix the count is
that of the last safe end in it plus that of the rest, which is never longer than a piece and the
white space before it. Of a text over the budget the last safe end within it is read off, and the
prefixes from there to the next are counted one by one: in a short stretch by encoding them, in a long
piece by a table over its bytes. There the last token of each prefix is the one that stays apart from
the last token of what is before it, when both are encoded together.

Defined results: null texts count as empty ones with no tokens, null or repeated keys are rows like
any others, further columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from brightloom.llm.textkit import keyed, map_texts

REMEMBERED_PIECES = 1_000_000
SHORT = 48  # characters of a stretch whose prefixes are encoded
DOCS_AT_A_TIME = 256

# fixed values: white space and the pattern of the byte-level pre-tokenizer
_WHITE_CHARACTERS = frozenset(
    map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
_WHITE = "".join(sorted(_WHITE_CHARACTERS))
_PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)


class PrefixCounter:
    """Counts of one tokenizer file; remembers what it has encoded, within a bound."""

    _open: dict[str, PrefixCounter] = {}

    @classmethod
    def of(cls, path: str) -> PrefixCounter:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        added = [t["content"] for t in content["added_tokens"]]
        # tokens are spelled in an alphabet of one character for each byte
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
        self.inner = {self.letters[b] for b in range(128, 192)}  # of characters of several bytes
        self.vocabulary = set(content["model"]["vocab"])
        merges = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        self.ranks = {tuple(m): rank for rank, m in enumerate(merges)}
        self.longest = max(map(len, self.vocabulary), default=1)
        self.apart: dict[tuple[str, str], bool] = {}
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pieces = regex.compile(_PIECES)
        self.known: dict[str, int] = {}

    def counts(self, split: list[list[str]]) -> Iterator[list[int]]:
        """The tokens of each piece; all that are new among these texts are encoded at once."""
        new = list({piece for pieces in split for piece in pieces if piece not in self.known})
        if len(self.known) + len(new) > REMEMBERED_PIECES:
            self.known.clear()
            new = list({piece for pieces in split for piece in pieces})
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update(zip(part, map(len, encoded)))
        for pieces in split:
            yield list(map(self.known.__getitem__, pieces))

    def split(self, text: str) -> list[str]:
        """The pieces; a special token is one."""
        if self.special is None or not self.special.search(text):
            return self.pieces.findall(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [*self.pieces.findall(text[at : found.start()]), found[0]]
            at = found.end()
        return out + self.pieces.findall(text[at:])

    def tables(self, texts: list[str]) -> Iterator[tuple[int, list[int], list[int]]]:
        """Tokens of each whole text, and its safe ends with the tokens up to each."""
        split = [self.split(t) for t in texts]
        for pieces, counts in zip(split, self.counts(split)):
            sums, ends = list(accumulate(counts)), list(accumulate(map(len, pieces)))
            safe = [k for k in range(len(pieces)) if self.is_safe(pieces, k)]
            yield (sums[-1] if sums else 0), [ends[k] for k in safe], [sums[k] for k in safe]

    def is_safe(self, pieces: list[str], k: int) -> bool:
        # a part of a special token may join the piece before it
        before_special = self.special is not None and k + 1 < len(pieces) and self.special.fullmatch(pieces[k + 1])
        return pieces[k][-1] not in _WHITE_CHARACTERS and not before_special

    def totals(self, texts: list[str]) -> list[int]:
        return [sum(counts) for counts in self.counts([self.split(t) for t in texts])]

    def rest(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count_at(self, text: str, ends: list[int], counts: list[int], length: int) -> int:
        """Tokens of the first ``length`` characters."""
        k = bisect_right(ends, length) - 1
        return (counts[k] if k >= 0 else 0) + self.rest(text[ends[k] if k >= 0 else 0 : length])

    @staticmethod
    def truncate(ends: list[int], counts: list[int], budget: int) -> int:
        """Characters of the longest stored prefix of at most ``budget`` tokens; nothing is encoded again."""
        k = bisect_right(counts, budget)
        return ends[k - 1] if k else 0

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest of all prefixes of at most ``budget`` tokens."""
        pieces = self.split(text)
        return self.fit_pieces(pieces, next(self.counts([pieces])), budget)

    def fit_pieces(self, pieces: list[str], counts: list[int], budget: int) -> int:
        """The same for a text that has been split and counted; only the pieces next to the budget are looked at."""
        sums = list(accumulate(counts, initial=0))
        # the last safe end within the budget; a later one is over it, and so is whatever contains it
        first = bisect_right(sums, budget) - 1
        last = first + 1
        while first > 0 and not self.is_safe(pieces, first - 1):
            first -= 1
        while last < len(pieces) and not self.is_safe(pieces, last - 1):
            last += 1
        return sum(map(len, pieces[:first])) + self.within("".join(pieces[first:last]), budget - sums[first])

    def within(self, stretch: str, budget: int) -> int:
        """The same for what stands from one safe end to the next: white space, a piece and a special token, each if any."""
        white = len(stretch) - len(stretch.lstrip(_WHITE))
        at = 0
        spans = []
        for piece in self.split(stretch):
            spans.append((at, at + len(piece), piece))
            at += len(piece)
        before = list(accumulate(next(self.counts([[p for _, _, p in spans]])), initial=0))
        for k in range(len(spans) - 1, -1, -1):
            start, end, piece = spans[k]
            if end <= white:
                break
            left = budget - before[k]
            lowest = max(start, white)
            if end - lowest <= SHORT or (self.special is not None and self.special.fullmatch(piece)):
                # a part of a special token may join the piece before it
                since = spans[k - 1][0] if k and start >= white and spans[k - 1][1] > white else start
                have = budget - (before[k - 1] if since < start else before[k])
                found = next((i for i in range(end, lowest, -1) if self.totals([stretch[since:i]])[0] <= have), None)
            else:
                found = self.last_within(piece, left, lowest - start)
                found = None if found is None else start + found
            if found is not None:
                return found
        # the white space before a prefix's end is one piece
        return self.last_within(stretch[:white], budget, 0) or 0

    def last_within(self, piece: str, budget: int, least: int) -> int | None:
        """The longest prefix of one piece of more than ``least`` characters and at most ``budget`` tokens."""
        symbols = "".join(map(self.letters.__getitem__, piece.encode()))
        counts, tokens = [0], [""]
        over, found, length = 0, None, 0
        for i in range(1, len(symbols) + 1):
            last = next(t for t in self._endings(symbols, i) if self._apart(tokens[i - len(t)], t))
            counts.append(counts[i - len(last)] + 1)
            tokens.append(last)
            # a character ends where none goes on
            if i == len(symbols) or symbols[i] not in self.inner:
                length += 1
                if length > least and counts[i] <= budget:
                    found = length
            # whatever comes later has its last token after one of these
            over = over + 1 if counts[i] >= budget else 0
            if over >= self.longest and counts[i] > budget:
                break
        return found

    def _endings(self, symbols: str, end: int) -> Iterator[str]:
        for start in range(max(0, end - self.longest), end):
            if symbols[start:end] in self.vocabulary:
                yield symbols[start:end]

    def _apart(self, before: str, token: str) -> bool:
        """Whether two tokens are what their joint spelling is encoded to."""
        pair = before, token
        if pair not in self.apart:
            if len(self.apart) > REMEMBERED_PIECES:
                self.apart.clear()
            self.apart[pair] = self._merged(before + token) == ([before, token] if before else [token])
        return self.apart[pair]

    def _merged(self, symbols: str) -> list[str]:
        parts = list(symbols)
        while len(parts) > 1:
            ranks = [self.ranks.get(pair, len(self.ranks)) for pair in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


def prefix_table(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ends, counts``: the safe prefixes of each text in characters and their tokens."""
    schema = keyed(docs, [key], "n_tokens long, ends array<int>, counts array<int>")

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        counter = PrefixCounter.of(path)
        for at in range(0, len(texts), DOCS_AT_A_TIME):
            tables = list(counter.tables([t or "" for t in texts[at : at + DOCS_AT_A_TIME].to_pylist()]))
            n, ends, counts = zip(*tables)
            yield {key: keys[key][at : at + DOCS_AT_A_TIME], "n_tokens": n, "ends": ends, "counts": counts}

    return map_texts(docs, [key], text, schema, per_batch)


def token_counts(
    docs: DataFrame, path: str, budget: int, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_bytes, n_tokens, fitting_chars``: the last column is the longest prefix within the budget."""
    schema = keyed(docs, [key], "n_bytes long, n_tokens long, fitting_chars long")

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        counter = PrefixCounter.of(path)
        for at in range(0, len(texts), DOCS_AT_A_TIME):
            part = pc.fill_null(texts[at : at + DOCS_AT_A_TIME], "")
            values = part.to_pylist()
            split = [counter.split(v) for v in values]
            counts = list(counter.counts(split))
            n_tokens = list(map(sum, counts))
            fitting = [
                len(v) if n <= budget else counter.fit_pieces(pieces, c, budget)
                for v, n, pieces, c in zip(values, n_tokens, split, counts)
            ]
            n_bytes = pc.binary_length(part.cast(pa.large_binary()))
            chosen = keys[key][at : at + DOCS_AT_A_TIME]
            yield {key: chosen, "n_bytes": n_bytes, "n_tokens": n_tokens, "fitting_chars": fitting}

    return map_texts(docs, [key], text, schema, per_batch)
