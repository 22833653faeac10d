"""Letters between groups, and the language model's use of them."""

from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom import workspace
from brightloom.llm import letters, scoring

TEXTS = ["a b a b c", "b a", None, "a b", "c c c c", "ü b A", "", "d e f g h", "a b a b c"]


@pytest.mark.parametrize("values", [[], [0], [0, 255, 256], [2**63 - 1, 1, 0], list(range(1000))])
def test_packed_numbers_come_back(values):
    values = np.array(values, np.int64)
    assert (letters.unpacked(letters.packed(values)) == values).all()
    assert (letters.rising(letters.increasing(np.sort(values))) == np.sort(values)).all()


def test_hashes_of_64_bits_come_back():
    hashes = np.array([0, 5, 2**63, 2**64 - 1], np.uint64)
    assert (letters.rising(letters.increasing(hashes)).view(np.uint64) == hashes).all()


def test_a_pair_is_one_number():
    numbering = scoring.Numbering({0: 3, 2: 4}, 3)
    u, w = (x.ravel() for x in np.meshgrid(np.arange(7), np.arange(7)))
    pairs = numbering.pairs(u, w)
    assert len(set(pairs.tolist())) == 49
    assert [x.tolist() for x in numbering.words(pairs)] == [u.tolist(), w.tolist()]
    assert [(part, s.start, s.stop) for part, s in numbering.by_part(np.arange(7))] == [(0, 0, 3), (2, 3, 7)]


def written_tables(monkeypatch):
    tables = {}

    def keep(df, name, **options):
        table = workspace.written(df, name, **options)
        tables.setdefault(name, table)
        return table

    monkeypatch.setattr(scoring, "written", keep)
    return tables


def test_customers_of_a_word_are_its_contexts(spark, monkeypatch):
    # several chunks and parts, of which only pairs of two customers or more keep their tables
    monkeypatch.setattr(scoring, "CHUNK_BYTES", 16)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    tables = written_tables(monkeypatch)
    scoring.scored(docs, F.col("doc_id") != 7)
    contexts, counts = Counter(), Counter()
    for k, text in enumerate(TEXTS):
        tokens = ["", *(text or "").lower().split(), ""]
        if k != 7:
            counts.update(zip(tokens, tokens[1:]))
    for _, w in counts:
        contexts[w] += 1
    vocabulary, pairs = tables["vocabulary"], tables["pairs"]
    n = vocabulary.agg(F.max("there")).first()[0] + 1
    assert n > 2
    found, kept = {}, 0
    for r in scoring.customers(scoring.only(vocabulary, "words").union(scoring.only(pairs, "tables")), n).where("kind = 'words'").collect():
        words = [w.decode() for w in scoring.words_from(bytes(r.a), bytes(r.b)).to_pylist()]
        found |= dict(zip(words, letters.unpacked(bytes(r.e)).tolist()))
    for r in scoring.only(pairs, "pairs").collect():
        kept += len(letters.rising(bytes(r.a)))
    assert {w: c for w, c in found.items() if c} == contexts
    assert set(found) - set(contexts) == set("defgh")
    assert kept == sum(c > 1 for c in counts.values())


def test_chunks_do_not_change_what_is_counted(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id long, text string")

    def scores():
        return {r.doc_id: r for r in scoring.scored(docs, F.col("doc_id") < 20)[0].collect()}

    whole = scores()
    monkeypatch.setattr(scoring, "CHUNK_BYTES", 16)
    for key, row in scores().items():
        assert tuple(row)[1:3] == tuple(whole[key])[1:3]
        assert row.base_score == pytest.approx(whole[key].base_score)
        assert row.score == pytest.approx(whole[key].score, abs=1.5)


def test_pairs_take_less_than_the_text(spark, monkeypatch, tmp_path):
    # nearly all pairs are seen once; a row for each, by chunk and again counted, took several times the text
    random = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{x}" for x in random.integers(0, 3000, 2000))) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = {}

    def keep(df, name, **options):
        table = workspace.written(df, name, **options)
        sizes[name] = sum(f.stat().st_size for f in Path(workspace._paths[table].removeprefix("file:")).glob("*.parquet"))
        return table

    monkeypatch.setattr(scoring, "written", keep)
    scoring.scored(docs, F.lit(True))
    assert 2 * sum(sizes.values()) < sum(len(t) for _, t in rows)


def test_shuffles_of_written_tables_are_deleted(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
        return {f for f in found if "/shuffle_" in f}

    before = files()
    table = workspace.written(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    assert not files() - before
    assert table.count() == 10
    assert spark.conf.get(workspace.SHUFFLE_CLEANUP, None) is None
