"""TF-IDF features.

Fitting aggregates terms with map-side combine and ends in a vocabulary of at most
``max_features`` rows. Transforming is row-wise: each document becomes a sparse
vector without any shuffle, however frequent a term or long a document is.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.functions.stopwords import ENGLISH
from brightloom.functions.text import clean_text, tokens
from brightloom.workspace import written

MAX_FEATURES = 5000
TOKENS, COUNTS, WEIGHTED, WEIGHTS = "tokens", "term_counts", "weighted_counts", "features"


def with_tokens(df: DataFrame, text: str) -> DataFrame:
    """Replace ``text`` by the tokens of its cleaned form."""
    return df.withColumn(TOKENS, tokens(clean_text(F.col(text)))).drop(text)


def term_statistics(
    tokenised: DataFrame, stop_words: Iterable[str] = ENGLISH, candidates: DataFrame | None = None
) -> DataFrame:
    """``term, term_count, doc_count``: corpus count and number of documents of each term, or of the ``candidates`` alone.

    A document is exploded twice, once with all tokens and once with its distinct ones, so a
    single aggregation by term yields both counts, without a shuffle by document and term. Stop
    words drop out after it, one comparison per term instead of one per token.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    twice = tokenised.select(
        F.inline(
            F.array(
                F.struct(F.col(TOKENS).alias("terms"), one.alias("uses"), zero.alias("documents")),
                F.struct(F.array_distinct(TOKENS).alias("terms"), zero.alias("uses"), one.alias("documents")),
            )
        )
    )
    terms = twice.select(F.explode("terms").alias("term"), "uses", "documents")
    if candidates is not None:
        terms = terms.join(F.broadcast(candidates), "term", "left_semi")
    counted = (
        terms.groupBy("term")
        .agg(F.sum("uses").alias("term_count"), F.sum("documents").alias("doc_count"))
    )
    listed = sorted(set(stop_words))
    return counted.where(~F.col("term").isin(listed)) if listed else counted


def vocabulary(tokenised: DataFrame, max_features: int = MAX_FEATURES, stop_words: Iterable[str] = ENGLISH) -> DataFrame:
    """The ``max_features`` terms of largest corpus count; equal counts go by term."""
    return term_statistics(tokenised, stop_words).orderBy(F.desc("term_count"), "term").limit(max_features)


#: Terms a sketch follows, and so the most that are counted and broadcast.
TRACKED = 100_000


def certified_vocabulary(
    tokenised: DataFrame, max_features: int = MAX_FEATURES, stop_words: Iterable[str] = ENGLISH, *, tracked: int = TRACKED
) -> DataFrame:
    """The same terms as :func:`vocabulary` without a shuffle of all terms, where that can be proved.

    A sketch of bounded size names the frequent terms, which alone are then counted exactly. A term that it does not name
    has at most a share of ``7 / tracked`` of all uses, so if the last term of the vocabulary has more, or if the counted
    terms are all there are, nothing is missing. Otherwise every term is counted.
    """
    listed = sorted(set(stop_words))
    terms = tokenised.select(F.explode(TOKENS).alias("term"))
    terms = terms.where(~F.col("term").isin(listed)) if listed else terms
    top = F.expr(f"approx_top_k(term, {tracked}, {tracked})")
    found = written(terms.agg(top.alias("top"), F.count(F.lit(1)).alias("uses")), "frequent-terms")
    candidates = found.select(F.inline("top")).select(F.col("item").alias("term"))
    counted = written(term_statistics(tokenised, (), candidates), "counted-terms")
    chosen = counted.orderBy(F.desc("term_count"), "term").limit(max_features)
    return chosen if certified(found, counted, max_features, tracked) else vocabulary(tokenised, max_features, listed)


def certified(found: DataFrame, counted: DataFrame, max_features: int, tracked: int) -> bool:
    """Whether no term outside the counted ones can be among the ``max_features`` most frequent."""
    uses = found.first()["uses"]
    total = counted.agg(F.coalesce(F.sum("term_count"), F.lit(0))).first()[0]
    if total == uses:
        return True
    largest = counted.orderBy(F.desc("term_count"), "term").limit(max_features)
    last = largest.agg(F.count(F.lit(1)).alias("n"), F.min("term_count").alias("least")).first()
    # fixed value: the sketch is off by at most 3.5 / tracked of all uses, above or below
    return last["n"] == max_features and last["least"] * tracked > 7 * uses


def with_idf(terms: DataFrame, documents: int) -> DataFrame:
    """Smoothed inverse document frequency, ``ln((1 + n) / (1 + df)) + 1``."""
    n = F.lit(float(1 + documents))
    return terms.withColumn("idf", F.log(n / (1 + F.col("doc_count")).cast("double")) + 1)


@dataclass(frozen=True)
class TfidfModel:
    """A vocabulary with its statistics: at most ``max_features`` terms, so it fits the driver."""

    terms: list[str]
    idf: list[float]
    pipeline: PipelineModel

    @classmethod
    def fit(
        cls, tokenised: DataFrame, max_features: int = MAX_FEATURES, stop_words: Iterable[str] = ENGLISH
    ) -> TfidfModel:
        table = with_idf(vocabulary(tokenised, max_features, stop_words), tokenised.count())
        rows = table.select("term", "idf").collect()
        return cls.of([row["term"] for row in rows], [row["idf"] for row in rows])

    @classmethod
    def of(cls, terms: list[str], idf: list[float]) -> TfidfModel:
        if not terms:
            raise ValueError("empty vocabulary: the documents hold no terms besides stop words")
        stages = [
            CountVectorizerModel.from_vocabulary(terms, TOKENS, COUNTS),
            ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=COUNTS, outputCol=WEIGHTED),
            Normalizer(p=2.0, inputCol=WEIGHTED, outputCol=WEIGHTS),
        ]
        return cls(terms, idf, PipelineModel(stages))

    def transform(self, tokenised: DataFrame) -> DataFrame:
        """Add unit-length ``features``; unknown terms are dropped, no known term gives the zero vector."""
        return self.pipeline.transform(tokenised).drop(TOKENS, COUNTS, WEIGHTED)

    def term_table(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(range(len(self.terms)), self.terms, self.idf))
        return spark.createDataFrame(rows, "term_index int, term string, idf double")

    def weights(self, tokenised: DataFrame) -> DataFrame:
        """Long form: the other columns with ``term, weight``, one row per known term of a document."""
        vectors = self.transform(tokenised)
        kept = [c for c in vectors.columns if c != WEIGHTS]
        vector = F.unwrap_udt(WEIGHTS)
        # tokens hold no control characters, so one literal carries the whole vocabulary
        names = F.split(F.lit("\x01".join(self.terms)), "\x01")
        terms = F.transform(vector["indices"], lambda i: F.get(names, i))
        return vectors.select(*kept, F.inline(F.arrays_zip(terms.alias("term"), vector["values"].alias("weight"))))
