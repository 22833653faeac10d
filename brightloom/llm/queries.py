"""The operators on the given tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.llm import decontaminate, jaccard, licences, quality, scoring, toxicity
from brightloom.llm.filter_audit import filter_audit
from brightloom.llm.mixing import mix, rates
from brightloom.llm.private import BASE, joined, private_spans
from brightloom.llm.sharding import shards
from brightloom.llm.token_files import checksums, token_folder, write_token_files
from brightloom.llm.tokens import token_counts
from brightloom.llm.whitening import whiten
from brightloom.plans.catalogue.registry import Register, table

register = Register()

N_SHARDS = 40


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

#: 60 bits of a text's md5
_BITS = "('0x' || substr(md5({}), 1, 15))::BIGINT"
SQL_CRC = """crcs AS (
  SELECT text, xor(list_reduce(
      list_prepend(4294967295::BIGINT, bytes),
      lambda c, b: xor(c // 256, steps[(xor(c, b) % 256 + 1)::INT])), 4294967295) AS crc
  FROM (SELECT text, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
        FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
       (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS steps))"""


@register.query(
    f"""WITH {SQL_CRC},
rows AS (SELECT doc_id, source, octet_length(encode(coalesce(d.text, ''))) + 16 AS size, crc,
    {_BITS.format("'0|' || doc_id || '|' || crc")} AS h
  FROM documents d JOIN crcs ON crcs.text = coalesce(d.text, '')),
ranks AS (SELECT *, ((row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1)::DOUBLE
    + ({_BITS.format("'0|offset|=' || source")}::DOUBLE + 0.5) / 1152921504606846976.0::DOUBLE)
    / (count(*) OVER (PARTITION BY source))::DOUBLE AS place FROM rows),
places AS (SELECT *, row_number() OVER (ORDER BY place, source) - 1 AS position, count(*) OVER () AS n FROM ranks)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law,
  (position * {N_SHARDS} // n)::INT AS shard,
  (row_number() OVER (PARTITION BY position * {N_SHARDS} // n ORDER BY position) - 1)::BIGINT AS slot,
  NULL::INT AS grown_shard, position::BIGINT AS position, source FROM places"""
)
def op1_sharding(spark, folder):
    """Every document in one of 40 shards of equal counts, each with the mixture of all sources."""
    placed = shards(table(spark, folder, "documents"), N_SHARDS, carry=["source"])
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@register.query(
    f"""WITH {SQL_CRC},
rows AS (SELECT doc_id, source, octet_length(encode(coalesce(d.text, ''))) + 16 AS size, crc
  FROM documents d JOIN crcs ON crcs.text = coalesce(d.text, '')),
sources AS (SELECT source, sum(size)::DOUBLE AS b FROM rows GROUP BY source),
rates AS (SELECT source, pow(b, 0.7) / sum(pow(b, 0.7)) OVER () * sum(b) OVER () / b AS rate FROM sources),
chances AS (SELECT source, rate, k, exp(k * ln(rate) - rate - coalesce(sum(ln(greatest(k, 1))) OVER (PARTITION BY source ORDER BY k), 0)) AS p
  FROM (SELECT source, rate, unnest(range((rate + 12 * sqrt(rate) + 41)::INT)) AS k FROM rates)),
steps AS (SELECT source, any_value(rate) AS rate, list(below ORDER BY k) AS steps FROM (
  SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM chances) GROUP BY source),
drawn AS (SELECT doc_id, source, crc, rate, len(list_filter(steps,
    lambda s: s <= ({_BITS.format("'0|copies|' || doc_id || '|' || crc")}::DOUBLE + 0.5) / 1152921504606846976.0::DOUBLE)) AS n_copies
  FROM rows JOIN steps USING (source)),
copies AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM drawn)
SELECT doc_id, source, round(rate, 9) AS rate, n_copies::INT AS n_copies, copy::INT AS copy,
  (row_number() OVER (ORDER BY {_BITS.format("'0|order|' || doc_id || '|' || crc || '|' || copy")}, doc_id, copy) - 1)::BIGINT AS position
FROM copies"""
)
def op2_mixing(spark, folder):
    """Copies of every document so that sources weigh their bytes to the power 0.7, in shuffled order."""
    documents = table(spark, folder, "documents")
    mixed = mix(documents, rates(documents, temperature=0.7))
    return mixed.select("doc_id", "source", F.round("rate", 9).alias("rate"), "n_copies", "copy", "position")


@register.query()
def op8_private_data(spark, folder):
    """Personal data in every whole text."""
    found = private_spans(table(spark, folder, "documents"))

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(joined(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


TOKEN_LIMIT = 1024


@register.query()
def op10_token_counts(spark, folder, tokenizer=None):
    """Tokens of every whole text, and the longest prefix that keeps the limit."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    counted = token_counts(table(spark, folder, "documents"), path, TOKEN_LIMIT)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register.query()
def op4_quality_rules(spark, folder):
    """Counts of every whole text, and the verdict of rules learned from the quality labels."""
    documents = table(spark, folder, "documents")
    rules = quality.learn_rules(documents, table(spark, folder, "labels"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judged(quality.text_counts(documents), rules).select(*columns)


def held_out(parts: int, remainder: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts == remainder


@register.query()
def op6_toxicity(spark, folder):
    """Toxicity of every whole text; labels of a fifth of the documents are never seen."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.learn(documents, labels.where(~held_out(5, 0)))
    return toxicity.scored(documents, model).select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register.query()
def op7_decontamination(spark, folder):
    """Words of every document inside benchmark windows."""
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.judged(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@register.query()
def op5_near_duplicates(spark, folder):
    """Components of documents whose five-word shingles have a similarity of 0.8 or more."""
    found = jaccard.near_duplicates(table(spark, folder, "documents"))
    return found.withColumnRenamed("component", "component_id")


@register.query()
def op9_language_model(spark, folder):
    """Log-probability of every whole text; a seventh of the documents never trains."""
    scored, sums = scoring.scored(table(spark, folder, "documents"), ~held_out(7, 2))
    return scored.select(
        "doc_id",
        held_out(7, 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(sums["customers"])).cast("long").alias("train_tokens"),
        "base_score",
        # the spelling of unseen words counts, and not only that they are unseen
        F.col("spelled_score").alias("score"),
        F.col("score").alias("event_score"),
    )


@register.query()
def op3_licences(spark, folder):
    """Licences of every document taken as a file: its own, or that of the nearest directory above.

    A document is a file in the folder of its thousand and of its hundred within its source;
    every fifth stands for a licence file of its folder.
    """
    documents = table(spark, folder, "documents")
    name = F.expr("CASE WHEN doc_id div 20 % 5 = 0 THEN concat('LICENSE.', doc_id) ELSE concat(doc_id, '.txt') END")
    path = F.concat_ws("/", "source", F.expr("doc_id div 1000"), F.expr("doc_id div 100"), name)
    found = licences.licences(documents.select("doc_id", path.alias("path"), "text"))
    return found.withColumn("similarity", F.round("similarity", 6))


@register.query(
    r"""WITH read AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
flags AS (SELECT part, doc_id,
    (len(words) < 200)::INT AS a,
    (100 * len(list_distinct(words)) < 50 * len(words))::INT AS b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT AS c,
    regexp_matches(text, '[#$%&*|]')::INT AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)::INT AS e FROM read),
known AS (SELECT doc_id, max(coalesce(quality = 1, FALSE)::INT) AS good, max(coalesce(toxic = 1, FALSE)::INT) AS bad
  FROM labels GROUP BY doc_id),
counts AS (SELECT part, a, b, c, d, e, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, count(*) AS n
  FROM flags LEFT JOIN known USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (SELECT p.l || q.l || r.l || s.l || t.l AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.l, q.l, r.l, s.l, t.l])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
judged AS (SELECT part, filter_order, step, good, bad, n, a + b + c + d + e AS failed,
    list_extract([a, b, c, d, e], strpos('ABCDE', substr(filter_order, step, 1))) AS own,
    len(list_filter(range(1, step),
      lambda k: list_extract([a, b, c, d, e], strpos('ABCDE', substr(filter_order, k, 1))) = 1)) > 0 AS gone
  FROM counts, steps),
turns AS (SELECT part, substr(filter_order, step, 1) AS l, sum(n)::BIGINT AS shapley
  FROM judged WHERE own = 1 AND NOT gone GROUP BY ALL)
SELECT judged.part AS part, filter_order, step, sum(CASE WHEN own = 0 AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN own = 1 AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN own = 1 AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN own = 1 AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN own = 1 AND NOT gone AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN own = 1 AND NOT gone AND bad = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost,
  coalesce(any_value(shapley), 0)::BIGINT AS shapley
FROM judged LEFT JOIN turns ON turns.part = judged.part AND l = substr(filter_order, step, 1)
GROUP BY judged.part, filter_order, step"""
)
def op13_filter_audit(spark, folder):
    """What five filters of whole texts remove in all 120 orders, by language."""
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


END_ID = 2


@register.query()
def op11_token_files(spark, folder, tokenizer=None):
    """Where the ids of every whole text stand in files of Simple-8b blocks, and their checksum, read from the files."""
    target = token_folder(spark)
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    files = write_token_files(table(spark, folder, "documents"), path, target, end_id=END_ID)
    return checksums(files, target)


@register.query()
def op12_whitening(spark, folder):
    """Every usable embedding on the 16 principal components of the distinct ones, at unit variance."""
    return whiten(table(spark, folder, "embeddings"), 16)
