"""Letters between groups of rows: what a group tells another is one row of packed numbers.

A letter has a kind, the group it is from (``here``), the group it is for (``there``), up to seven packed columns and
three numbers. What a group keeps for itself is a letter to itself. One shuffle by ``there`` delivers them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brightloom.workspace import import_here

PACKED = "abcdefg"


def packed(values: np.ndarray) -> bytes:
    """Numbers that are not negative, all lowest bytes first, then the next ones, as far as any number has them."""
    values = np.ascontiguousarray(values).view(np.uint64)
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return len(values).to_bytes(8, "little") + np.ascontiguousarray(planes).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(data, np.uint8, offset=8).reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def increasing(values: np.ndarray) -> bytes:
    """Ascending numbers of 64 bits without a sign, as their steps."""
    values = np.ascontiguousarray(values).view(np.uint64)
    return packed(np.diff(values, prepend=np.uint64(0)))


def rising(data: bytes) -> np.ndarray:
    """What ``increasing`` packed; numbers below 2^63 keep their value."""
    return np.cumsum(unpacked(data).view(np.uint64), dtype=np.uint64).view(np.int64)


def floats(values: np.ndarray) -> bytes:
    return values.astype(np.float32).tobytes()


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float32).astype(float)


def apart(parts: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """Each of ``n`` parts that occurs in the sorted ``parts``, and where."""
    bounds = np.searchsorted(parts, np.arange(n + 1))
    for part in np.flatnonzero(np.diff(bounds)).tolist():
        yield part, slice(int(bounds[part]), int(bounds[part + 1]))


class Letter(NamedTuple):
    here: int
    a: bytes | None
    b: bytes | None
    c: bytes | None
    d: bytes | None
    e: bytes | None
    f: bytes | None
    g: bytes | None


class Letters:
    """Letters being written."""

    SCHEMA = "kind string, here int, there int, " + ", ".join(f"{p} binary" for p in PACKED) + ", x double, y double, z double"

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, kind: str, here: int, there: int, *columns: bytes, x: float = 0, y: float = 0, z: float = 0) -> None:
        self.rows.append((kind, here, there, *columns, *[None] * (len(PACKED) - len(columns)), float(x), float(y), float(z)))

    def table(self) -> pa.Table:
        names = ["kind", "here", "there", *PACKED, "x", "y", "z"]
        kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * len(PACKED), *[pa.float64()] * 3]
        columns = zip(*self.rows) if self.rows else [()] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


class Mail:
    """The letters of one group by kind, each kind in the order of where they are from."""

    def __init__(self, table: pa.Table):
        self.of_kind: dict[str, list[Letter]] = {}
        columns = [table.column(c).to_pylist() for c in ("here", *PACKED)]
        for kind, *letter in zip(table.column("kind").to_pylist(), *columns):
            self.of_kind.setdefault(kind, []).append(Letter(*letter))
        for letters in self.of_kind.values():
            letters.sort(key=lambda m: m.here)

    def __getitem__(self, kind: str) -> list[Letter]:
        return self.of_kind.get(kind, [])


def answered(letters: DataFrame, answer: Callable[[int, Mail, Letters], None]) -> DataFrame:
    """The letters that each group writes when it has got all of its own."""
    import_here(letters)

    def run(table: pa.Table) -> pa.Table:
        out = Letters()
        answer(table.column("there")[0].as_py(), Mail(table), out)
        return out.table()

    return letters.groupBy("there").applyInArrow(run, Letters.SCHEMA)
