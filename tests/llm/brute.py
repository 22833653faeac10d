"""Plain Python versions of the contracts, and an odd table to hold the operators against."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(WORD, text or "")


def crc_fold(key, parts):
    return zlib.crc32(str(key).encode()) % parts


def quality_counts(text):
    text = text or ""
    found, seen, duplicates, marked = words(text), set(), 0, set()
    for line in text.split("\n"):
        if re.search(WORD, line):
            duplicates += line in seen
            seen.add(line)
    windows = collections.Counter(zip(found, found[1:], found[2:]))
    for i in range(len(found) - 2):
        if windows[tuple(found[i : i + 3])] > 1:
            marked |= {i, i + 1, i + 2}
    symbols = sum(text.count(s) for s in "#*$%&|<>")
    return len(found), sum(map(len, found)), symbols, duplicates, len(marked)


def shingles(text):
    found = words(lower(text))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def components(rows):
    """Smallest reachable key for ``(key, text)`` rows, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    names = collections.defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            names[root(i)].append(key)
    return [
        (key, len(s), (key if not s else min(names[root(i)], default=None)))
        for i, ((key, _), s) in enumerate(zip(rows, sets))
    ]


def hits(text, items):
    """``n_words, n_hit, n_items, items_sha256, contaminated`` for ``{item: text}``."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = collections.defaultdict(set)
    for name, item in items.items():
        own = re.findall(pattern, lower(item))
        size = min(13, len(own))
        for k in range(len(own) - size + 1):
            if size:
                windows[tuple(own[k : k + size])].add(str(name))
    found, hit, named = re.findall(pattern, lower(text)), set(), set()
    for size in {len(w) for w in windows}:
        for k in range(len(found) - size + 1):
            window = tuple(found[k : k + size])
            if window in windows:
                hit |= set(range(k, k + size))
                named |= windows[window]
    digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    return len(found), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(found)


PRIVATE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def private(text):
    out = []
    for kind, pattern in PRIVATE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                out.append((kind, m.start(), m.end()))
    return out


def unigrams(rows):
    """``{key: (n_tokens, n_known, train_tokens, base_score)}`` of ``(key, text)`` rows."""
    import math

    tokens = {key: [*words(lower(text)), None] for key, text in rows}
    seen = collections.Counter(w for key in tokens if crc_fold(key, 7) != 2 for w in tokens[key])
    total, distinct = sum(seen.values()), len(seen)
    return {
        key: (
            len(own),
            sum(seen[w] > 0 for w in own),
            total,
            sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in own),
        )
        for key, own in tokens.items()
    }


_BASE = "the report on grain prices in the northern valley was read aloud to the council before noon on market day"
PASSAGE = "quietly the seventh lantern drifted over a violet harbour while nobody counted the remaining copper bells"

#: doc_id, text, lang, source: nulls, empty and long texts, copies, near copies, repeated rows, ties.
ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n ", "en", "a"),
    (4, f"{_BASE} {PASSAGE}", "en", "a"),
    (5, f"{_BASE}  {PASSAGE.upper()}", "en", "a"),
    (6, f"{_BASE} {PASSAGE}", "fr", "b"),
    (6, f"{_BASE} {PASSAGE}", "fr", "b"),
    (7, f"{_BASE} {PASSAGE} indeed", "en", "b"),
    (None, "a row without a key has words too", None, None),
    (8, "two words", "en", "a"),
    (9, "Two  words", "en", "a"),
    (10, "mail bob.x@mail7.example.com or +1 (974) 555-3436, card 4111 1111 1111 1111 at 10.0.0.255 or 10.0.0.256.7", "en", "c"),
    (11, "é 漢字 😀 <|endoftext|> " + "naïve " * 3, "fr", "c"),
    (12, "line one is here\nline one is here\n\nline one is here\nother # * $ line", "en", "c"),
    (13, "word " * 60, "en", "c"),
    (14, " ".join(f"w{k}" for k in range(30_000)), "en", "a"),
    (15, "x" * 20_000, "en", "a"),
    (16, "Released under the MIT License.\nyou stupid idiot", "en", "a"),
]
ITEMS = [(1, PASSAGE), (2, "two words"), (3, None), (4, ""), (1, PASSAGE), (None, "without a key has words")]


def odd(spark, rows=None, extra=True):
    """The odd table; its further columns are named like results."""
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(ODD if rows is None else rows, schema)
    if not extra:
        return df
    names = ("n_chars", "n_words", "score", "hits", "component", "copy", "position", "shard", "spans", "rate", "n", "node")
    return df.selectExpr("*", *(f"length(text) AS {name}" for name in names))


def items(spark, rows=None):
    return spark.createDataFrame(ITEMS if rows is None else rows, "item_id long, text string")
