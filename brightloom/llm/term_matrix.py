"""A sparse document-term matrix in shards of compressed rows, over one dictionary of all words.

Each task cuts its texts into shards of about ``SHARD_BYTES`` and encodes the words of a shard by the
shard's own list of distinct words. These lists, and not the texts, are shuffled, once: sorted by word, the distinct
words of all shards get gapless numbers, and each shard gets back the numbers of its list, by which its
rows are encoded and sorted anew. A word that stands in every shard costs one row a shard, however often
it stands in texts.

A shard is one row of a table: ``rows`` (one value for each document), and three little-endian arrays:
``indptr`` (int64, where each row begins, and the end), ``indices`` (int64 word numbers, rising within
a row) and ``data`` (int32 counts). Words are maximal runs of characters other than the space and
``\\t`` to ``\\r``, and are told apart byte by byte.

Defined results: null and empty texts, and those of white space, are rows without entries; repeated rows and
null keys are rows like any others; an empty table has no shards and an empty dictionary; a text of any length
is in one shard. Columns of documents travel inside one value, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brightloom.llm.numbering import n_cells
from brightloom.llm.textkit import import_here
from brightloom.workspace import written

SHARD_BYTES = 12_000_000
#: A word's number and its place in a shard's list travel as one long.
NUMBER_BITS = 35
MOST_WORDS = 1 << NUMBER_BITS

LOCAL = {"indptr": "<i8", "indices": "<i4", "data": "<i4"}


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """Neighbouring texts of about ``most`` bytes, or one longer text, and the place of the first; nulls become empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else []
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, texts.slice(at, end - at)
        at = end


def encoded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of texts as places in a list of distinct words, the number of words of each text, and the list."""
    split = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words = pc.list_flatten(split)
    filled = pc.greater(pc.binary_length(words), 0)
    # white space at either end leaves an empty word there
    sums = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)))
    ends = np.cumsum(counts)
    encoded = words.filter(filled).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), sums[ends] - sums[ends - counts], encoded.dictionary


def counted_rows(row: np.ndarray, column: np.ndarray, n_rows: int, n_columns: int):
    """``indptr, indices, data`` of entries given by row and column, of which equal ones are counted."""
    keys = row * max(n_columns, 1)
    keys += column
    keys.sort()
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    data = np.diff(np.append(begins, len(keys)))
    row, column = np.divmod(keys[begins], max(n_columns, 1))
    return np.searchsorted(row, np.arange(n_rows + 1)), column, data


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def _one(kind: pa.DataType, values: pa.Array) -> pa.Array:
    """All values as the one list of an array of lists."""
    return pa.array([values.to_pylist()], kind) if len(values) == 0 else pa.ListArray.from_arrays([0, len(values)], values).cast(kind)


def _local_shards(docs: DataFrame, text: str, shard_bytes: int) -> DataFrame:
    """``shard, rows, words, indptr, indices, data``, with places in the shard's own ``words`` as indices."""
    source = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).cast("string").alias("text"))
    if text in docs.columns:
        source = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("rows", T.ArrayType(source.schema["row"].dataType)),
            T.StructField("words", T.ArrayType(T.StringType())),
            *(T.StructField(name, T.BinaryType()) for name in ("indptr", "indices", "data")),
        ]
    )
    arrow = to_arrow_schema(schema)
    import_here(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the same in a repeated task, so that a repeated task writes the same shards
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, texts in text_slices(batch.column("text"), shard_bytes):
                indices, counts, words = encoded_words(texts)
                rows = np.repeat(np.arange(len(texts)), counts)
                parts = counted_rows(rows, indices, len(texts), len(words))
                arrays = [
                    pa.array([shard], pa.int64()),
                    _one(arrow.field("rows").type, batch.column("row").slice(at, len(texts))),
                    _one(arrow.field("words").type, words.cast(pa.string())),
                    *(pa.array([_bytes(p, k)], pa.binary()) for p, k in zip(parts, LOCAL.values())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
                shard += 1

    return source.mapInArrow(run, schema)


#: Gets the rows' structs, where each row begins and the end, the numbers of its words and their counts; gives columns.
PerShard = Callable[[pa.Array, np.ndarray, np.ndarray, np.ndarray], list]


class TermMatrix:
    """Shards with places in their own lists, and the ``numbers`` of the words of these lists."""

    def __init__(self, local: DataFrame, numbered: DataFrame):
        self.local, self.numbered = local, numbered

    @property
    def dictionary(self) -> DataFrame:
        """``word, number`` of every distinct word; numbers have no gaps."""
        return self.numbered.where("word IS NOT NULL").select("word", "number")

    @property
    def row_type(self) -> T.DataType:
        return self.local.schema["rows"].dataType.elementType

    def map_shards(self, schema: T.StructType, per_shard: PerShard) -> DataFrame:
        """Hand each shard, its words by their numbers, to ``per_shard``; a task has one shard in memory at a time."""
        fits = F.assert_true(F.col("number") < MOST_WORDS, F.lit("too many distinct words"))
        packed = F.shiftleft(F.col("place").cast("long"), NUMBER_BITS).bitwiseOR(F.col("number"))
        numbers = (
            self.numbered.select("shard", F.when(fits.isNull(), packed).alias("packed"))
            .groupBy("shard")
            # as many as a shard has distinct words
            .agg(F.collect_list("packed").alias("numbers"))
        )
        arrow = to_arrow_schema(schema)
        import_here(self.local)

        def run(shard: pa.Table) -> pa.Table:
            one = shard.to_batches()[0]
            indptr, places, counts = (np.frombuffer(one.column(c)[0].as_buffer(), kind) for c, kind in LOCAL.items())
            packed = one.column("numbers")[0].values
            packed = np.empty(0, np.int64) if packed is None else packed.to_numpy()
            known = np.empty(len(packed), np.int64)
            known[packed >> NUMBER_BITS] = packed & (MOST_WORDS - 1)
            words = known[places]
            order = np.lexsort((words, np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))))
            columns = per_shard(one.column("rows")[0].values, indptr, words[order], counts[order])
            arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
            return pa.Table.from_arrays(arrays, schema=arrow)

        shards = self.local.drop("words").join(numbers, "shard", "left")
        return shards.groupBy("shard").applyInArrow(run, schema)

    def shards(self) -> DataFrame:
        """``rows, indptr, indices, data``: one row for each shard."""
        schema = T.StructType(
            [
                T.StructField("rows", T.ArrayType(self.row_type)),
                *(T.StructField(name, T.BinaryType()) for name in ("indptr", "indices", "data")),
            ]
        )
        kind = to_arrow_schema(schema).field("rows").type

        def whole(rows: pa.Array, indptr: np.ndarray, words: np.ndarray, counts: np.ndarray) -> list:
            return [_one(kind, rows), *([_bytes(v, k)] for v, k in ((indptr, "<i8"), (words, "<i8"), (counts, "<i4")))]

        return self.map_shards(schema, whole)

    def row_sums(self) -> DataFrame:
        """``row, n_words, n_distinct``: the sum and the number of entries of each row of the matrix."""
        schema = T.StructType([T.StructField("row", self.row_type)]).add("n_words", "long").add("n_distinct", "long")

        def sums(rows: pa.Array, indptr: np.ndarray, words: np.ndarray, counts: np.ndarray) -> list:
            before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
            return [rows, np.diff(before[indptr]), np.diff(indptr)]

        return self.map_shards(schema, sums)


def term_matrix(docs: DataFrame, *, text: str = "text", shard_bytes: int = SHARD_BYTES) -> TermMatrix:
    """The matrix of all texts; ``rows`` has a struct of all other columns for each document."""
    spark = docs.sparkSession
    cells = n_cells(spark)
    local = written(_local_shards(docs, text, shard_bytes), "term-shards", compression="zstd")
    listed = local.select("shard", F.posexplode("words").alias("place", "word"))
    by_word = Window.partitionBy("cell").orderBy("word")
    # a cell has many words, each at most once for each shard
    ranked = listed.withColumn("cell", F.pmod(F.xxhash64("word"), F.lit(cells))).select(
        "shard",
        "place",
        "cell",
        (F.dense_rank().over(by_word) - 1).alias("rank"),
        # each word is kept once
        F.when(~F.col("word").eqNullSafe(F.lag("word").over(by_word)), F.col("word")).alias("word"),
    )
    ranked = written(ranked, "ranked-words", compression="zstd")
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("cell").agg((F.max("rank") + 1).alias("size"))
    begins = sizes.select("cell", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    # a row for each cell, of which there are a few for each shuffle partition
    numbered = ranked.join(F.broadcast(begins), "cell").withColumn("number", F.col("begin") + F.col("rank"))
    return TermMatrix(local, numbered)
