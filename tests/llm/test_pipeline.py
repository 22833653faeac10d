"""The stages of the pipeline, each on what the one before kept."""

from collections import Counter

import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from brightloom.workspace import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "near duplicates",
        "benchmark decontamination",
        "mixing",
        "sharding",
    ]
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SMALL), "stage"))
    given, good, single, clean, mixed, sharded = ([tuple(r) for r in t.collect()] for t in tables)
    assert all(t.columns == COLUMNS for t in tables[1:5])

    kept = {r[0] for r in good}
    base = {r[0]: brute.quality_counts(r[1]) for r in given}
    passes = {k for k, c in base.items() if c[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert kept <= passes
    judged = [k for k in passes if labels.get(k) is not None]
    assert sum((k in kept) == (labels[k] == 1) for k in judged) >= 0.9 * len(judged)

    expected = {key for key, _, component in brute.components([r[:2] for r in good]) if key == component}
    assert {r[0] for r in single} == expected and len(single) == len(expected)

    assert Counter(clean) == Counter(r for r in single if not brute.hits(r[1], items)[-1])

    assert set(mixed) <= set(clean)
    assert 0.7 * len(clean) < len(mixed) < 1.3 * len(clean)

    assert Counter(r[0] for r in sharded) == Counter(r[0] for r in mixed)
    shards = Counter(r[tables[-1].columns.index("shard")] for r in sharded)
    assert max(shards.values()) - min(shards[k] for k in range(40)) <= 1


@pytest.mark.parametrize("rows", [None, []])
def test_stages_of_odd_and_empty_rows(spark, tmp_path, rows):
    brute.items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = spark.createDataFrame([(4, 1, 0), (12, 0, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = brute.odd(spark, rows)
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, before, str(tmp_path)), "stage")
        if stage is not corpus_pipeline.shard:
            assert docs.columns == before.columns
    assert docs.count() >= 0


def test_near_duplicates_keep_one_of_each(spark):
    kept = corpus_pipeline.near_duplicates(spark, brute.odd(spark, extra=False), SMALL).collect()
    groups = brute.components([(key, text) for key, text, _, _ in brute.ODD])
    expected = {key for key, _, component in groups if key is not None and key == component}
    assert Counter(r.doc_id for r in kept if r.doc_id is not None) == Counter(expected)
    assert sum(r.doc_id is None for r in kept) == 1


def test_near_duplicates_decide_by_row(spark):
    text = " ".join(f"w{k}" for k in range(60))
    near, other = f"{text} more", " ".join(f"v{k}" for k in range(60))
    rows = [(3, text), (5, near), (5, other), (5, f"{other} more"), (None, near), (None, "alone but said twice or more")]
    rows += [(None, "alone but said twice or more"), (9, "three short words"), (9, "")]
    docs = spark.createDataFrame([(k, t, "en", "a") for k, t in rows], "doc_id long, text string, lang string, source string")
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect())
    seconds = [r for r in kept if r[0] == 5]
    assert len(seconds) == 1 and seconds[0][1] in (other, f"{other} more")
    del kept[seconds[0]]
    assert kept == Counter([(3, text), (None, "alone but said twice or more"), (9, "three short words"), (9, "")])


def test_stages_give_back_columns_named_like_inner_ones(spark):
    names = ["_row", "_given", "node", "component", "n", "counts", "slot", "n_shingles"]
    docs = brute.odd(spark, extra=False).select("*", *(F.lit(f"given {c}").alias(c) for c in names))
    labels = spark.createDataFrame([(4, 1, 0), (12, 0, 1)], "doc_id long, quality int, toxic int")
    rules = corpus_pipeline.quality.learn_rules(docs, labels)
    counts = corpus_pipeline.quality.text_counts(corpus_pipeline.whole_rows(docs), key=corpus_pipeline.ROW)
    good = corpus_pipeline.quality.judged(counts, rules).where("kept").select(f"{corpus_pipeline.ROW}.*")
    single = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    for kept in (good, single):
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.select(*names).collect()} <= {tuple(f"given {c}" for c in names)}
