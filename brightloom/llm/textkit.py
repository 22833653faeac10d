"""Words, word hashes and shingles of whole texts, for Arrow batches inside tasks.

A batch is cut into blocks of documents of about two megabytes; a longer text is a block of its
own, so memory is bounded by the longest text. Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brightloom.workspace import import_here

BLOCK_BYTES = 2_000_000
SPACE = 32

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def _powers_of(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        factors = np.full(max(n, BLOCK_BYTES), base, np.uint64)
        factors[0] = 1
        have = _powers[name] = np.cumprod(factors, dtype=np.uint64)
    return have[:n]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, so that their order and remainders look random."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bytes_where(keep: Callable[[int], bool]) -> np.ndarray:
    return np.fromiter((keep(b) for b in range(256)), bool, 256)


#: Bytes of words that are separated by the space and \t to \r only.
NON_SPACE = bytes_where(lambda b: b != 32 and not 9 <= b <= 13)
#: Bytes of words of lower-case letters, digits and whatever is not ASCII.
ALNUM = bytes_where(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class Block:
    """Some documents of a batch as one array of UTF-8 bytes, each closed by a space.

    ``first_row`` is the place of its first document in the batch, ``bounds`` has the byte where
    each document begins and at last the length.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first_row: int):
        self.data, self.bounds, self.first_row = data, bounds, first_row
        self.n_docs = len(bounds) - 1

    def lower(self) -> Block:
        return Block(_LOWER[self.data], self.bounds, self.first_row)

    def per_doc(self, positions: np.ndarray) -> np.ndarray:
        """For each document the number of the first of these sorted byte positions, and their count at last."""
        return np.searchsorted(positions, self.bounds)

    def words(self, members: np.ndarray) -> Words:
        inside = members[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate(([0], edges))
        # every document ends in a space, so no word is open at the end
        return Words(self, edges[0::2], edges[1::2])


class Words:
    def __init__(self, block: Block, starts: np.ndarray, ends: np.ndarray):
        self.block, self.starts, self.ends = block, starts, ends
        self.bounds = block.per_doc(starts)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, the same wherever the word stands."""
        n = len(self.block.data)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUES[self.block.data] * _powers_of("up", _BASE, n), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * _powers_of("down", _BASE_INVERSE, n)[self.starts]
        return mix(raw + (self.ends - self.starts).astype(np.uint64))

    def docs(self) -> np.ndarray:
        """For each word the place of its document in the block."""
        return np.repeat(np.arange(self.block.n_docs), self.counts)


def window_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, by its first word; runs across documents are the caller's to leave out."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _STEP + word_hashes[k : k + n]
    return mix(out + np.uint64(size))


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        local = bounds[row : end + 1] - bounds[row]
        part = np.insert(raw[bounds[row] : bounds[end]], local[1:], SPACE)
        yield Block(part, local + np.arange(len(local)), row)
        row = end


def map_texts(
    docs: DataFrame,
    keys: list[str],
    text: str,
    schema: T.StructType | str,
    per_batch: Callable[[dict[str, pa.Array], pa.Array], Iterator[dict]],
) -> DataFrame:
    """Hand each Arrow batch of keys and texts to ``per_batch``; it yields columns of ``schema``.

    Only the named columns are read, so further columns of any name are of no matter.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    import_here(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = {k: batch.column(k) for k in keys}
            for columns in per_batch(named, batch.column("_text")):
                arrays = [as_array(columns[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(*keys, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array | pa.ChunkedArray):
        return values.cast(kind)
    return pa.array(values, type=kind)


def field(df: DataFrame, name: str) -> T.StructField:
    return T.StructField(name, df.schema[name].dataType)


def keyed(df: DataFrame, keys: list[str], ddl: str) -> T.StructType:
    """The schema of some columns of a table and then those of ``ddl``."""
    return T.StructType([*(field(df, k) for k in keys), *T.StructType.fromDDL(ddl).fields])


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An array of lists from flat values and where each list begins."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
