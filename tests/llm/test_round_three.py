"""Token files, whitening and the filter audit: odd, empty and given tables, round trips and brute force."""

import re
import zlib
from collections import Counter
from functools import cache
from itertools import permutations

import brute
import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightloom.llm import feast, filter_audit, simple8b, term_matrix, token_files, whitening
from brightloom.llm.queries import register, tokenizer_path
from brightloom.workspace import fresh_path

WORDS = tokenizer_path("word_bpe_49k.json")


# Simple-8b


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 40), st.just(0)), max_size=600))
def test_any_integers_come_back(values):
    coded = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(coded).tolist() == values


@pytest.mark.parametrize("n", [simple8b.BLOCK - 1, simple8b.BLOCK, simple8b.BLOCK + 1, 70 * simple8b.BLOCK + 5])
def test_whole_blocks_come_back(n):
    draw = np.random.default_rng(n)
    for values in (draw.integers(0, 50_000, n), np.zeros(n), 2 ** draw.integers(0, 64, n, dtype=np.uint64)):
        values = values.astype(np.uint64)
        assert (simple8b.decode(simple8b.encode(values)) == values).all()


def test_words_are_as_full_as_they_can_be():
    def sizes(value, n):
        return len(simple8b.encode(np.full(n, value, np.uint64)).words)

    assert [sizes(v, 240) for v in (0, 1, 2, 1023, 1024, 2**20 - 1, 2**30, 2**59)] == [1, 4, 8, 40, 48, 80, 240, 240]
    coded = simple8b.encode(np.array([2**60, 7], np.uint64))
    assert coded.n_escapes.tolist() == [1] and coded.escape_values.tolist() == [2**60]


# token files


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def encoded(texts):
    return [[*f.ids, 2] for f in library().encode_batch(texts, add_special_tokens=False)]


def expected_files(rows):
    """``(key, start, n, crc)`` of ``(key, text)`` rows in order, equal keys in any order."""
    at, out = 0, []
    for (key, _), ids in zip(rows, encoded([t or "" for _, t in rows])):
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n'sStΣσ́ 　\x1c<|>9")), max_size=60))
def test_word_by_word_is_what_the_library_gives(text):
    import pyarrow as pa

    for whole in (text, f"a<|endoftext|>{text}", f"{text} <|startoftext|> 's"):
        ids, counts = token_files.WordEncoder.of(WORDS).texts(pa.array([whole, "", whole], pa.large_string()), 2)
        assert ids.tolist() == [*encoded([whole])[0], 2, *encoded([whole])[0]]
        assert counts.tolist()[1] == 1


def test_token_files_of_odd_rows(spark):
    folder = fresh_path(spark, "ids")
    files = token_files.write_token_files(brute.odd(spark).repartition(5), WORDS, folder, end_id=2)
    back = token_files.token_ids(files, folder).orderBy("start").collect()
    texts = Counter((k, tuple(ids)) for (k, *_), ids in zip(brute.ODD, encoded([r[1] or "" for r in brute.ODD])))
    assert Counter((r.doc_id, tuple(r.ids)) for r in back) == texts
    assert [r.doc_id for r in back] == sorted((r[0] for r in brute.ODD), key=lambda k: (k is not None, k))
    assert [r.start for r in back] == np.cumsum([0, *(len(r.ids) for r in back)])[:-1].tolist()
    sums = token_files.checksums(files, folder).collect()
    assert {(r.start, r.ids_crc32) for r in sums} == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in back}


def test_any_run_of_ids_is_read_by_its_blocks(spark, tmp_path):
    ids = np.random.default_rng(1).integers(0, 49_408, 3 * simple8b.BLOCK + 100).astype(np.uint32)
    path = tmp_path / "x.s8b"
    with open(path, "wb") as out:
        writer = token_files.Writer(out)
        writer.add(np.array([4, 9]), np.array([True, False]), np.array([100, len(ids) - 100]), ids)
        writer.close()
    with token_files.store(str(tmp_path))[0].open_input_file(str(path)) as opened:
        file = token_files.TokenFile(opened)
        for a, b in ((0, 1), (8191, 8193), (5, 20_000), (0, len(ids)), (len(ids) - 1, len(ids)), (7, 7)):
            assert (file.ids(a, b) == ids[a:b]).all()
        assert (file.keys.tolist(), file.has_key.tolist(), file.counts.tolist()) == ([4, 9], [1, 0], [100, len(ids) - 100])


def test_escapes_in_a_file(tmp_path):
    ids = np.zeros(2 * simple8b.BLOCK + 7, np.uint64)
    ids[[3, simple8b.BLOCK, -1]] = 2**64 - 1, 2**60, 2**61
    with open(tmp_path / "x.s8b", "wb") as out:
        writer = token_files.Writer(out)
        writer.add(np.array([1]), np.array([True]), np.array([len(ids)]), ids)
        writer.close()
    with token_files.store(f"file://{tmp_path}")[0].open_input_file(str(tmp_path / "x.s8b")) as opened:
        assert (token_files.TokenFile(opened).ids(0, len(ids)) == ids).all()


def test_a_row_repeated_often_lies_in_several_files(spark):
    rows = spark.range(60_000).selectExpr("7L AS doc_id", "'the same words every time' AS text")
    folder = fresh_path(spark, "ids")
    files = token_files.write_token_files(rows.repartition(8), WORDS, folder, end_id=2).collect()
    assert sum(f.n_docs for f in files) == 60_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = fresh_path(spark, "ids")
        files = token_files.write_token_files(rows.repartition(8), WORDS, folder, end_id=2).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(f.n_docs for f in files) < 20_000


def test_a_task_that_ran_before_leaves_no_second_file(spark):
    docs, folder = brute.odd(spark).coalesce(1), fresh_path(spark, "ids")
    for _ in range(2):
        files = token_files.write_token_files(docs, WORDS, folder, end_id=2)
        assert token_files.checksums(files, folder).count() == len(brute.ODD)
    import os

    assert all(re.fullmatch(r"ids-\d{6}\.s8b", f) for f in os.listdir(folder))


def test_no_documents_no_files(spark):
    folder = fresh_path(spark, "ids")
    files = token_files.write_token_files(brute.odd(spark, []), WORDS, folder, end_id=2)
    assert files.count() == 0 and token_files.checksums(files, folder).count() == 0


def test_words_of_letters_are_encoded_together():
    import pyarrow as pa
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    encoder = token_files.WordEncoder(WORDS)
    asked = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    random = np.random.default_rng(12)
    letters = [*"etaoinéßİǅʰªﬁ汉", "e\u0301", "\U0001f600", "1"]
    words = ["".join(random.choice(letters[:7], 6)) for _ in range(4_000)]
    words += ["".join(random.choice(letters, random.integers(1, 6))) for _ in range(1_000)]
    ids, counts = encoder.texts(pa.array([" ".join(words)], pa.large_string()), None)
    assert ids.tolist() == library.encode(" ".join(words), add_special_tokens=False).ids and counts.tolist() == [len(ids)]
    assert len(asked) < 2_500


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError, match="white space"):
        token_files.checked(tokenizer_path("byte_bpe_50k.json"))


def test_token_files_of_the_given_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    found = register["op11_token_files"].run(spark, SMALL)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in found.collect()) == expected_files(rows)


# contour integration


def symmetric_matrices():
    draw = np.random.default_rng(5)
    turned, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    yield "random", (lambda a: a @ a.T)(draw.standard_normal((40, 90)))
    yield "few directions", (lambda a: a @ a.T)(draw.standard_normal((40, 3)))
    yield "equal", turned @ np.diag([5.0] * 20 + [1.0] * 20) @ turned.T
    yield "close", turned @ np.diag(np.r_[1 + 1e-10 * np.arange(20), np.linspace(0.1, 0.9, 20)]) @ turned.T
    yield "falling", turned @ np.diag(0.3 ** np.arange(40.0)) @ turned.T
    yield "diagonal", np.diag(np.arange(1.0, 41))
    yield "one", np.array([[3.0]])
    yield "nothing", np.zeros((4, 4))


@pytest.mark.parametrize("name, matrix", list(symmetric_matrices()))
def test_largest_eigenvalues(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, vectors = feast.largest(matrix, 16)
    exact = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) == min(16, (exact > 1e-12 * max(exact[0], 1e-300)).sum())
    scale = max(exact[0], 1e-300)
    assert np.abs(values - exact[: len(values)]).max(initial=0) < 1e-13 * scale
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) < 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13


def test_inertia_counts():
    draw = np.random.default_rng(2)
    matrix = draw.standard_normal((30, 30))
    matrix = matrix + matrix.T
    exact = np.linalg.eigvalsh(matrix)
    diagonal, beside = feast.tridiagonal(matrix)
    for shift in draw.uniform(exact[0] - 1, exact[-1] + 1, 50):
        assert feast.n_below(diagonal, beside, shift) == (exact < shift).sum()


# whitening


def whitening_by_hand(rows):
    """``{(key, component): ...}`` by whole numbers and a dense solver."""
    grid = [(k, np.floor(64 * np.array(v, float)).astype(int) + 1_000_000) for k, v in rows]
    fit = np.unique([x for _, x in grid], axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    far = (fit * n - sums) / n
    values, vectors = np.linalg.eigh(far.T @ far / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = {}
    for k, x in grid:
        projected = (x * n - sums) / n @ vectors / np.sqrt(np.abs(values) + 1e-300)
        white[k] = (n, sum(int(c) ** 2 for c in x * n - sums), projected)
    return values, white


def test_whitening_of_the_given_vectors(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    values, white = whitening_by_hand([(r.vec_id, r.embedding) for r in table.collect()])
    found = register["op12_whitening"].run(spark, SMALL).collect()
    assert len(found) == 16 * len(white)
    signs = {}
    for r in found:
        n, deviation, projected = white[r.vec_id]
        other = projected[r.component - 1]
        sign = signs.setdefault(r.component, np.sign(other * r.whitened))
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened == pytest.approx(sign * other, abs=1e-9)
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


NAN, INF = float("nan"), float("inf")
VECTORS = [
    (1, [0.5, 1.5, -3.0]),
    (2, [2.0, 0.1, 0.2]),
    (2, [2.0, 0.1, 0.2]),
    (None, [9.0, 0.1, 4.0]),
    (3, None),
    (4, [1.0, None, 2.0]),
    (5, [1.0, NAN, 2.0]),
    (6, [1.0, INF, 2.0]),
    (7, [1.0, -INF, 2.0]),
    (8, []),
    (9, [1.0]),
    (10, [1e30, 0.0, 0.0]),
    (11, [-4.0, 4.0, 1.0]),
    *((12, [1.0, 1.0, 1.0]) for _ in range(50)),
]


def vectors_table(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return table.withColumns({name: F.lit(5) for name in ("x", "c", "n", "key", "size", "component")})


def test_whitening_of_odd_vectors(spark):
    found = whitening.whiten(vectors_table(spark, VECTORS)).collect()
    left = [(k, v) for k, v in VECTORS if k in (1, 2, None, 11, 12)]
    assert Counter(r.vec_id for r in found) == {k: 3 * n for k, n in Counter(k for k, _ in left).items()}
    values, white = whitening_by_hand(left)
    for r in found:
        n, deviation, projected = white[r.vec_id]
        assert n == 5 and (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(abs(projected[r.component - 1]), abs=1e-9)
    assert {r.component: r.explained for r in found} == pytest.approx(dict(enumerate(values / values.sum(), 1)))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(vectors_table(spark, rows))
    assert found.columns == ["vec_id", *(c.split()[0] for c in whitening.COLUMNS.split(", "))]
    assert found.count() == 0


def test_deviations_beyond_a_long_are_null():
    model = whitening.Whitening(2**31, np.array([0, 0]), np.ones(1), np.ones((2, 1)), 1.0)
    x = np.array([[1, 0], [1, 1], [2**10, 0]])
    assert whitening._deviations(model, x).to_pylist() == [2**62, None, None]


# the document-term matrix and the audit


def test_term_matrix_by_brute_force(spark):
    matrix = term_matrix.term_matrix(brute.odd(spark).repartition(4))
    numbers = {r.word: r.number for r in matrix.dictionary.collect()}
    expected = Counter((k, tuple(sorted(Counter(brute.words(t)).items()))) for k, t, _, _ in brute.ODD)
    assert sorted(numbers.values()) == list(range(len({w for _, t, _, _ in brute.ODD for w in brute.words(t)})))
    names = {n: w for w, n in numbers.items()}
    found = Counter()
    for r in matrix.shards().collect():
        indptr, indices, data = (np.frombuffer(b, k) for b, k in ((r.indptr, "<i8"), (r.indices, "<i8"), (r.data, "<i4")))
        assert len(r["rows"]) == len(indptr) - 1
        for row, a, b in zip(r["rows"], indptr, indptr[1:]):
            assert (np.diff(indices[a:b]) > 0).all()
            found[row.doc_id, tuple(sorted((names[i], n) for i, n in zip(indices[a:b].tolist(), data[a:b].tolist())))] += 1
    assert found == expected


def test_many_shards_share_one_dictionary(spark):
    docs = brute.odd(spark, [r for r in brute.ODD if r[0] != 14]).coalesce(1)
    matrix = term_matrix.term_matrix(docs, shard_bytes=300)
    sums = matrix.row_sums().select("row.doc_id", "n_words", "n_distinct").collect()
    expected = [(k, len(brute.words(t)), len(set(brute.words(t)))) for k, t, _, _ in brute.ODD if k != 14]
    assert Counter(map(tuple, sums)) == Counter(expected)
    assert matrix.shards().count() > 5
    assert matrix.dictionary.count() == matrix.dictionary.select("word").distinct().count()


def audit_by_hand(rows, labels):
    """``{(part, order, step): counts}`` of ``(key, text, part)`` rows."""
    texts = {}
    for key, text, _ in rows:
        if key is not None:
            texts.setdefault(text or "", []).append(key)
    sets = []
    for key, text, part in rows:
        text = text or ""
        words = brute.words(text)
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
        fails += "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * (key is not None and key > min(texts[text]))
        known = [(q, t) for k, q, t in labels if key is not None and k == key]
        sets.append((part or "", fails, any(q == 1 for q, _ in known), any(t == 1 for _, t in known)))
    out, turns = {}, Counter()
    orders = ["".join(o) for o in permutations("ABCDE")]
    for part in {s[0] for s in sets}:
        own = [s for s in sets if s[0] == part]
        for order in orders:
            for _, fails, _, _ in own:
                first = next((c for c in order if c in fails), None)
                turns[part, first] += 1
        for order in orders:
            for k, c in enumerate(order):
                left = [s for s in own if not set(s[1]) & set(order[:k])]
                removed = [s for s in left if c in s[1]]
                out[part, order, k + 1] = [
                    len(left) - len(removed),
                    len(removed),
                    sum(c in s[1] for s in own) - len(removed),
                    sum(s[1] == c for s in own),
                    sum(s[2] for s in removed),
                    sum(s[3] for s in removed),
                    c,
                ]
    return {(p, o, k): (*v[:-1], turns[p, v[-1]]) for (p, o, k), v in out.items()}


def test_audit_of_odd_rows(spark):
    long_text = " ".join(f"W{k} #" for k in range(300))
    more = [(20, long_text, "en", "a"), (21, long_text, None, "a"), (None, long_text, "en", "a"), (22, None, "", "a"), (20, long_text, "en", "a")]
    rows = [*brute.ODD, *more]
    labels = [(20, 1, 0), (20, 0, 1), (4, None, 1), (5, 1, 1), (99, 1, 1), (None, 1, 1), (14, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = brute.odd(spark, rows).withColumns({n: F.lit("x") for n in ("key", "part", "body", "row", "rows", "word", "marked", "good")})
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.filter_audit(docs, table).collect()}
    assert found == audit_by_hand([r[:3] for r in rows], labels)


def test_audit_of_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(brute.odd(spark, []), labels).count() == 0
    one = filter_audit.filter_audit(brute.odd(spark, [(1, None, None, None)]), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}


def test_labels_are_not_broadcast(spark):
    path = fresh_path(spark, "labels")
    spark.range(2000).selectExpr("id AS doc_id", "id % 2 AS quality", "int(id % 4 = 1) AS toxic").write.parquet(path)
    flags = ["id % 5 = 0 AS short", *(f"false AS {f}" for f in ("repeated", "shouting", "marked"))]
    found = spark.range(1000).selectExpr("id AS key", "'en' AS part", "sha1(string(id)) AS body", *flags)
    counts = filter_audit.failure_counts(found, spark.read.parquet(path)).where("n > 0")
    by_label = {(False, False): 100, (True, False): 50, (True, True): 50}
    expected = {("en", 1, *label, n) for label, n in by_label.items()} | {("en", 0, *label, 4 * n) for label, n in by_label.items()}
    assert set(map(tuple, counts.collect())) == expected
    # the plan that ran
    assert "Broadcast" not in counts._jdf.queryExecution().executedPlan().toString()
