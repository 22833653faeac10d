"""Personal data in whole texts by anchor expansion.

One Aho-Corasick pass finds at-signs, schemes, plus signs, digits and the cue words of identifiers;
small parsers expand each anchor in place and validate it. E-mail addresses, IP addresses, payment
cards and telephone numbers follow the given patterns, leftmost and without overlap within a kind;
URLs, identifiers after a cue and street addresses are added.

Spans are in code points, the end exclusive. Defined results: null and empty texts have no spans,
null or repeated keys are rows like any others, further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.textkit import keyed, map_texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "street")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"[0-9]+(?:\.[0-9]+){3}").match
_card = re.compile(r"[0-9](?:[ -]?[0-9])+").match
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
_link = re.compile(r"://[^\s<>\"'|]+").match
_identifier = re.compile(r"(?:\s?(?:no|nr|number|id)\b\.?)?\s?[:=#]\s?[\"']?([A-Za-z0-9](?:[A-Za-z0-9_./+-]{4,}[A-Za-z0-9]))", re.I).match
_house = re.compile(r"([0-9]{1,5}[A-Za-z]?,? (?:[^\W\d_][\w'-]*\.? ){1,4})\Z").search

_CUES = "account acct iban bic ssn passport licence license token password passwd secret api_key apikey customer tax".split()
_STREETS = "street avenue boulevard lane drive road court square".split()


def _cases(word: str) -> set[str]:
    return {word, word.capitalize(), word.upper()}


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for mark in ("@", "://", "+", *_DIGITS):
        found.add_word(mark, (mark if len(mark) > 1 or mark not in _DIGITS else "0", len(mark)))
    for kind, words in (("cue", _CUES), ("street", _STREETS)):
        for word in words:
            for form in _cases(word):
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _free(text: str, at: int) -> bool:
    """No letter or digit at this place."""
    return not (0 <= at < len(text) and text[at].isalnum())


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans, by kind as listed in ``KINDS`` and then by start."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)

    def keep(kind: str, start: int, end: int, valid: bool = True) -> None:
        done[kind] = end
        if valid:
            found[kind].append((start, end))

    for last, (mark, length) in automaton().iter(text):
        start = last - length + 1
        if mark == "0":
            if start >= done["ip"] and (start == done["ip"] or text[start - 1] not in _DIGITS) and (m := _ip(text, start)):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                keep("ip", start, m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts))
            if start >= done["card"] and (m := _card(text, start)):
                digits = m[0].replace(" ", "").replace("-", "")
                keep("card", start, m.end(), 13 <= len(digits) <= 19 and passes_luhn(digits))
        elif mark == "@":
            left = start
            while left > done["email"] and text[left - 1] in _LOCAL:
                left -= 1
            if left < start and (m := _domain(text, start + 1)):
                keep("email", left, m.end())
        elif mark == "+":
            if start >= done["phone"] and (m := _phone(text, start)):
                keep("phone", start, m.end(), 9 <= sum(c in _DIGITS for c in m[0]) <= 15)
        elif mark == "://":
            left = start
            while left > done["url"] and (text[left - 1].isalnum() or text[left - 1] in "+.-"):
                left -= 1
            if left < start and text[left].isalpha() and (m := _link(text, start)):
                keep("url", left, left + len(text[left : m.end()].rstrip(".,;:!?)]}")))
        elif mark == "cue":
            if _free(text, start - 1) and last + 1 >= done["account"] and (m := _identifier(text, last + 1)):
                # a word without a digit is not an identifier
                keep("account", m.start(1), m.end(1), any(c in _DIGITS for c in m[1]))
        elif _free(text, start - 1) and _free(text, last + 1):
            head = text[max(done["street"], start - 80) : start]
            if m := _house(head):
                keep("street", start - len(m[1]), last + 1)
    return [(kind, a, b) for kind in KINDS for a, b in found[kind]]


def private_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans``: kind, start and end of everything found in each whole text."""
    schema = keyed(docs, [key], f"spans {SPANS}")

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        for at in range(0, len(texts), 512):
            part = [
                [{"kind": k, "start": a, "end": b} for k, a, b in spans(t.as_py() or "")] for t in texts[at : at + 512]
            ]
            yield {key: keys[key][at : at + 512], "spans": part}

    return map_texts(docs, [key], text, schema, per_batch)


def joined(of: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text``: every span replaced by its kind in brackets; of overlapping ones the first stays."""
    schema = keyed(docs, [key], f"`{text}` string")

    def mask(value: str) -> str:
        out, at = [], 0
        for kind, start, end in sorted(spans(value), key=lambda s: (s[1], -s[2])):
            if start >= at:
                out += [value[at:start], f"[{kind}]"]
                at = end
        return "".join(out) + value[at:]

    def per_batch(keys: dict[str, pa.Array], texts: pa.Array) -> Iterator[dict]:
        yield {key: keys[key], text: [None if t.as_py() is None else mask(t.as_py()) for t in texts]}

    return map_texts(docs, [key], text, schema, per_batch)
