"""Token ids of documents as files of Simple-8b blocks, in the order of the documents' keys.

One exchange puts texts in order; equal keys and equal rows may lie in several files, so no key
is too frequent. Each task then encodes its texts, writes one file and moves it to its final name when it is whole, so
a repeated or doubled task leaves the same file. A file holds any number of ids, of which a task has a few blocks in
memory at a time. Where each file's ids begin in the whole order follows from the table of files.

A file, all numbers little-endian:

* 8 bytes ``IDS-S8B1``;
* the blocks of ids: words, then places (int64) and values (uint64) of escapes;
* the documents: for each its key (int64), whether it has one (1 byte) and its number of ids (int64), as three arrays;
* for each block the byte where it begins, its words and its escapes (int64, three arrays);
* number of ids, of documents, of blocks, and the byte where the documents begin (four int64), and ``IDS-S8B1`` again.

Every block but the last has ``simple8b.BLOCK`` ids, so the block of any id is known, and blocks are decoded apart
from each other (:meth:`TokenFile.ids`).

Texts are encoded by their distinct words. The tokenizer must treat what stands between white space by itself and drop the
white space, and so must its added tokens; :func:`checked` refuses any other.

Defined results: null and empty texts have the closing id alone; null keys come first; repeated keys and rows are rows
of their own, equal keys ordered by a hash of their text; a text of any length is one document; an empty table gives no files;
further columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brightloom.llm import simple8b
from brightloom.llm.simple8b import BLOCK, Coded
from brightloom.llm.term_matrix import encoded_words, text_slices
from brightloom.llm.textkit import bytes_where, import_here
from brightloom.workspace import fresh_path, written

MAGIC = b"IDS-S8B1"
TEXT_BYTES = 6_000_000  # encoded at a time
REMEMBERED_WORDS = 1_000_000
WORDS_TOGETHER = 500
# fixed values: ASCII marks, none of which is a letter, a digit or white space
MARKS = string.punctuation
ALPHANUMERIC = bytes_where(lambda b: chr(b) in string.ascii_letters + string.digits)
IDS_AT_ONCE = BLOCK * simple8b.BLOCKS_AT_ONCE
FILES_PER_TASK_LIMIT = 8  # tasks to read files, for each shuffle partition


def store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder that driver and executors share: a path or a URI that pyarrow can open."""
    if re.match(r"^[a-zA-Z][\w+.-]*:", folder):
        return pa.fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", folder))
    return pa.fs.LocalFileSystem(), folder


class Known:
    """Ids of words, one word's after the other's in one array."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.lengths: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def add(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words))))
        self.lengths.append(lengths)
        self.ids.append(ids)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word's ids begin, how many they are, and all ids."""
        self.lengths = [np.concatenate([np.empty(0, np.int64), *self.lengths])]
        self.ids = [np.concatenate([np.empty(0, np.uint32), *self.ids])]
        return np.cumsum(self.lengths[0]) - self.lengths[0], self.lengths[0], self.ids[0]


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``begin, begin + 1, ...`` of runs, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(lengths.sum())


class WordEncoder:
    """Ids of texts by a tokenizer file; remembers the ids of words, within a bound."""

    _open: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.closing = closing_ids(path)
        self.known = Known()

    def _places(self, words: list[str]) -> np.ndarray:
        """The places of distinct words in ``known``, which learns the new ones; with too many it starts anew."""
        places = self.known.places
        if len(places) > REMEMBERED_WORDS:
            self.known = Known()
            places = self.known.places
        new = [w for w in words if w not in places]
        alone = new
        if self.closing is not None:
            alone = [w for w in new if not w.isalpha()]
            alone += self._together([w for w in new if w.isalpha()])
        for at in range(0, len(alone), 10_000):
            part = alone[at : at + 10_000]
            found = [f.ids for f in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self.known.add(part, lengths, np.fromiter(chain.from_iterable(found), np.uint32, lengths.sum()))
        return np.fromiter(map(places.__getitem__, words), np.int64, len(words))

    def _together(self, words: list[str]) -> list[str]:
        """Learn words of letters, many as one text, which takes half the time; returns those that have to be encoded alone.

        A word has one closing id or, if the tokenizer cuts it, several. So with as many closing ids as words each has its own.
        """
        left = []
        for at in range(0, len(words), 20 * WORDS_TOGETHER):
            parts = [words[k : k + WORDS_TOGETHER] for k in range(at, min(at + 20 * WORDS_TOGETHER, len(words)), WORDS_TOGETHER)]
            found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
            for part, encoded in zip(parts, found):
                ids = np.array(encoded.ids, np.uint32)
                ends = np.flatnonzero(self.closing[ids]) + 1
                if len(ends) == len(part) and ends[-1] == len(ids):
                    self.known.add(part, np.diff(ends, prepend=0), ids)
                else:
                    left += part
        return left

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of some distinct words has, and all ids.

        Most words are a letter or digit with marks after it. These are encoded apart, as the tokenizer does, and in
        lower case where a word is ASCII, so that fewer are new.
        """
        plain = pc.invert(pc.match_substring(words, "<|"))  # a part of an added token is not a word's own
        ascii_only = pc.and_(plain, pc.string_is_ascii(words))
        cores = pc.if_else(ascii_only, pc.ascii_lower(words), words)
        stems = pc.utf8_rtrim(cores, MARKS)
        ends = _last_bytes(stems)
        apart = pc.and_(plain, pa.array(ALPHANUMERIC[ends]))
        cores = pc.if_else(apart, stems, cores)
        tails = pc.binary_length(words).to_numpy() - pc.binary_length(cores).to_numpy()
        marks = _suffixes(words, tails)

        both = [pc.dictionary_encode(c) for c in (cores, marks)]
        parts = [self._places(e.dictionary.to_pylist()) for e in both[:1]]
        first = self.known
        parts += [self._places(both[1].dictionary.to_pylist())]
        if self.known is not first:  # it has just started anew
            parts[0] = self._places(both[0].dictionary.to_pylist())
        begins, lengths, ids = self.known.table()
        pairs = np.column_stack([p[e.indices.to_numpy()] for p, e in zip(parts, both)]).reshape(-1)
        return lengths[pairs].reshape(-1, 2).sum(axis=1), ids[_runs(begins[pairs], lengths[pairs])]

    def texts(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has, the closing id included."""
        indices, n_words, words = encoded_words(texts)
        lengths, flat = self.words(words)
        begins = np.cumsum(lengths) - lengths
        if end_id is not None:  # one more word that ends each text
            begins, lengths = np.append(begins, len(flat)), np.append(lengths, 1)
            flat = np.append(flat, np.uint32(end_id))
            closed = np.full(len(indices) + len(texts), len(lengths) - 1, np.int64)
            closed[np.arange(len(indices)) + np.repeat(np.arange(len(texts)), n_words)] = indices
            indices, n_words = closed, n_words + 1
        counts = lengths[indices]
        sums = np.concatenate(([0], np.cumsum(counts)))
        bounds = np.concatenate(([0], np.cumsum(n_words)))
        return flat[_runs(begins[indices], counts)], np.diff(sums[bounds])


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return bounds, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)


def _last_bytes(texts: pa.Array) -> np.ndarray:
    """The last byte of each text, 0 of an empty one."""
    if not len(texts):
        return np.empty(0, np.uint8)
    bounds, data = _buffers(texts)
    return np.where(bounds[1:] > bounds[:-1], data[np.maximum(bounds[1:] - 1, 0)], 0)


def _suffixes(texts: pa.Array, lengths: np.ndarray) -> pa.Array:
    """The last bytes of each text, which are ASCII."""
    if not len(texts):
        return pa.array([], pa.large_string())
    bounds, data = _buffers(texts)
    kept = np.ascontiguousarray(data[_runs(bounds[1:] - lengths, lengths)])
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept))


def closing_ids(path: str) -> np.ndarray | None:
    """Whether each id closes what is between white space or marks; None of a tokenizer that does not tell for every word."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    suffix, vocabulary = model.get("end_of_word_suffix"), model.get("vocab")
    steps = [content.get("pre_tokenizer") or {}]
    steps += steps[0].get("pretokenizers", [])
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = [*map(chr, plain), *map(chr, range(256, 256 + 256 - len(plain)))]
    # the last byte of any word has to be a token, or a word could have no closing id
    in_bytes = model.get("type") == "BPE" and any(s.get("type") == "ByteLevel" for s in steps)
    if not in_bytes or not suffix or any(c + suffix not in vocabulary or c not in vocabulary for c in alphabet):
        return None
    out = np.zeros(1 + max(chain(vocabulary.values(), (t["id"] for t in content.get("added_tokens", [])))), bool)
    out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return out


def checked(path: str) -> str:
    """The path, if the tokenizer takes words between white space one by one."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    steps = [content.get("pre_tokenizer") or {}]
    steps += steps[0].get("pretokenizers", [])
    drops_space = any(
        s.get("type") == "Split" and s.get("invert") and s.get("behavior") == "Removed" and r"\s" not in s["pattern"].get("Regex", r"\s").replace(r"[^\s", "")
        for s in steps
    )
    joins = [t["content"] for t in content.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"])]
    if not drops_space or joins:
        raise ValueError(f"{path} does not encode words between white space one by one")
    return path


class Writer:
    """Writes one file; holds ids of a few blocks, and of every document 17 bytes."""

    def __init__(self, out):
        self.out = out
        self.at = 0
        self._put(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.documents: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_ids = self.n_docs = 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, keys: np.ndarray, has_key: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Some documents with all their ids one after the other."""
        self.documents.append((keys, has_key, counts))
        self.n_docs += len(keys)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= IDS_AT_ONCE:
            self._blocks(self.n_waiting // BLOCK * BLOCK)

    def _blocks(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        coded = simple8b.encode(ids[:n])
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n
        sizes = 8 * (coded.n_words + 2 * coded.n_escapes)
        self.blocks.append((self.at + np.cumsum(sizes) - sizes, coded.n_words, coded.n_escapes))
        if not coded.n_escapes.any():
            self._put(coded.words.astype("<u8").tobytes())
            return
        words, escapes = np.cumsum(coded.n_words), np.cumsum(coded.n_escapes)
        for w, nw, e, ne in zip(words, coded.n_words, escapes, coded.n_escapes):
            self._put(coded.words[w - nw : w].astype("<u8").tobytes())
            self._put(coded.escape_places[e - ne : e].astype("<i8").tobytes())
            self._put(coded.escape_values[e - ne : e].astype("<u8").tobytes())

    def close(self) -> None:
        self._blocks(self.n_waiting)
        documents = self.at
        for k, kind in enumerate(("<i8", "u1", "<i8")):
            self._put(b"".join(np.ascontiguousarray(d[k], kind).tobytes() for d in self.documents))
        for k in range(3):
            self._put(b"".join(b[k].astype("<i8").tobytes() for b in self.blocks))
        n_blocks = sum(len(b[0]) for b in self.blocks)
        self._put(np.array([self.n_ids, self.n_docs, n_blocks, documents], "<i8").tobytes() + MAGIC)


class TokenFile:
    """Reads one file; any run of ids by its blocks alone."""

    TAIL = 4 * 8 + len(MAGIC)

    def __init__(self, file):
        self.file = file
        tail = self._read(file.size() - self.TAIL, self.TAIL)
        if tail[-len(MAGIC) :] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of ids")
        self.n_ids, self.n_docs, n_blocks, at = np.frombuffer(tail[: 4 * 8], "<i8").tolist()
        body = self._read(at, file.size() - self.TAIL - at)
        spans = np.cumsum([0, 8 * self.n_docs, self.n_docs, 8 * self.n_docs, 8 * n_blocks, 8 * n_blocks, 8 * n_blocks])
        parts = [body[a:b] for a, b in zip(spans, spans[1:])]
        self.keys, self.has_key, self.counts, self.begins, self.n_words, self.n_escapes = (
            np.frombuffer(p, kind) for p, kind in zip(parts, ("<i8", "u1", "<i8", "<i8", "<i8", "<i8"))
        )

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to before ``end``."""
        if end <= start:
            return np.empty(0, np.uint64)
        first, last = start // BLOCK, -(-end // BLOCK)
        here = slice(first, last)
        n_words, n_escapes = self.n_words[here], self.n_escapes[here]
        stop = self.begins[last - 1] + 8 * (n_words[-1] + 2 * n_escapes[-1])
        data = np.frombuffer(self._read(int(self.begins[first]), int(stop - self.begins[first])), "<u8")
        n_values = min(self.n_ids, last * BLOCK) - first * BLOCK
        none = data[:0]
        if n_escapes.any():
            cuts = np.cumsum(np.column_stack((n_words, n_escapes, n_escapes)).reshape(-1))[:-1]
            parts = np.split(data, cuts)
            words, places, values = (np.concatenate(parts[k::3]) for k in range(3))
            coded = Coded(n_values, words, n_words, n_escapes, places.astype(np.int64), values)
        else:
            coded = Coded(n_values, data, n_words, n_escapes, none.astype(np.int64), none)
        return simple8b.decode(coded)[start - first * BLOCK : end - first * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs of documents: the first and the one after the last, where each begins in the run, and the run's ids."""
        ends = np.cumsum(self.counts)
        at = 0
        while at < self.n_docs:
            begin = int(ends[at] - self.counts[at])
            end = max(at + 1, int(np.searchsorted(ends, begin + IDS_AT_ONCE, "right")))
            counts = self.counts[at:end]
            yield at, end, np.cumsum(counts) - counts, self.ids(begin, int(ends[end - 1]))
            at = end


FILES = "file string, part long, n_ids long, n_docs long, n_bytes long"


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, *, end_id: int | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the ids of all texts by rising key; returns the table of files ``file, part, n_ids, n_docs, n_bytes, start``."""
    checked(tokenizer)
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    # rows of one key are told apart, so that none is too frequent for a task
    order = ["key", "body", "row"]
    keyed = rows.select("*", F.xxhash64("text").alias("body"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    schema = T.StructType.fromDDL(FILES)
    arrow = to_arrow_schema(schema)
    import_here(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (files, root) = WordEncoder.of(tokenizer), store(folder)
        task = TaskContext.get()
        name = f"ids-{task.partitionId():06d}.s8b"
        # hidden until it is whole; attempts do not meet
        own = f"{root}/.{name}.{task.taskAttemptId()}"
        writer = None
        with files.open_output_stream(own) as out:
            writer = Writer(out)
            for batch in batches:
                for at, texts in text_slices(batch.column("text"), TEXT_BYTES):
                    keys = batch.column("key").slice(at, len(texts))
                    ids, counts = encoder.texts(texts, end_id)
                    has_key = keys.is_valid().to_numpy(zero_copy_only=False)
                    writer.add(keys.fill_null(0).to_numpy(), has_key, counts, ids)
            writer.close()
        if writer.n_docs:
            files.move(own, f"{root}/{name}")
            found = [[name], [task.partitionId()], [writer.n_ids], [writer.n_docs], [writer.at]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(found, arrow)], schema=arrow)
        else:
            files.delete_file(own)

    found = written(ordered.mapInArrow(run, schema), "token-files")
    # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(
    table: DataFrame, folder: str, schema: str, per_run: Callable[[TokenFile, int, int, np.ndarray, np.ndarray, int], list]
) -> DataFrame:
    """Hand every run of documents of the files in ``table`` to ``per_run``, which gives the columns of ``schema``.

    ``per_run`` gets the file, the first document and the one after the last, where each begins in the run, the ids, and
    the place of the run's first id among those of all files.
    """
    spark = table.sparkSession
    kinds = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kinds)
    import_here(table)
    most = FILES_PER_TASK_LIMIT * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(table.count(), most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with files.open_input_file(f"{root}/{name}") as opened:
                    file = TokenFile(opened)
                    for first, end, begins, ids in file.documents():
                        columns = per_run(file, first, end, begins, ids, start)
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
                        start += len(ids)

    return table.select("file", "start").repartition(tasks).mapInArrow(run, kinds)


def _keys(file: TokenFile, first: int, end: int) -> pa.Array:
    return pa.array(file.keys[first:end], mask=file.has_key[first:end] == 0)


def token_ids(table: DataFrame, folder: str, *, key: str = "doc_id") -> DataFrame:
    """``key, start, ids`` of every document in the files."""

    def per_run(file, first, end, begins, ids, start):
        lists = pa.ListArray.from_arrays(np.append(begins, len(ids)).astype(np.int32), ids.astype(np.int64))
        return [_keys(file, first, end), start + begins, lists]

    return read_documents(table, folder, f"`{key}` long, start long, ids array<long>", per_run)


def checksums(table: DataFrame, folder: str, *, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document in the files."""

    def per_run(file, first, end, begins, ids, start):
        data = memoryview(ids.astype("<u4").tobytes())
        bounds = 4 * np.append(begins, len(ids))
        sums = [zlib.crc32(data[a:b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        return [_keys(file, first, end), start + begins, file.counts[first:end], sums]

    return read_documents(table, folder, f"`{key}` long, start long, n_tokens long, ids_crc32 long", per_run)


def token_folder(spark: SparkSession) -> str:
    """A new folder for files, shared by driver and executors."""
    return fresh_path(spark, "ids")
