"""Sources: delimited files, text lines, test-case documents, topics, saved splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

Schema = StructType | str


def read_delimited(spark: SparkSession, path: str, schema: Schema | None = None, sep: str = "\t") -> DataFrame:
    """Header plus ``sep``. Without a schema Spark infers one, which costs a pass over the files.

    Empty fields read as null. Spark skips blank lines, and with tabs a row of nothing but nulls is one.
    """
    reader = spark.read.options(header=True, sep=sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_latin1_csv(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """CSV in ISO-8859-1 with doubled quotes and quoted line breaks; texts named by the header without a schema.

    Quoted line breaks make a file unsplittable: keep such data in many files.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return (
        reader.options(header=True, encoding="ISO-8859-1", quote='"', escape='"', multiLine=True).csv(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


TEST_CASE = StructType(
    [
        StructField("name", StringType()),
        StructField("X", ArrayType(MapType(StringType(), StringType()))),
        StructField("y", ArrayType(MapType(StringType(), IntegerType()))),
    ]
)


def read_test_cases(spark: SparkSession, path: str, *, one_per_file: bool = True) -> DataFrame:
    """Labelled messages ``(source, id, text, label)`` of nested test-case documents.

    A document without ``X`` or ``y``, or that is no valid JSON, yields no rows. With
    ``one_per_file=False`` each line is a document, which keeps large files splittable;
    its optional ``name`` then takes the place of the file name.
    """
    documents = spark.read.schema(TEST_CASE).json(path, multiLine=one_per_file)
    source = F.coalesce("name", F.element_at(F.split("_metadata.file_path", "/"), -1))
    return (
        documents.select(source.alias("source"), F.get("X", F.lit(0)).alias("texts"), F.get("y", F.lit(0)).alias("labels"))
        .where((F.size("texts") > 0) & (F.size("labels") > 0))
        .select("source", "labels", F.explode("texts").alias("key", "text"))
        .select("source", F.col("key").cast("int").alias("id"), "text", F.col("labels")[F.col("key")].alias("label"))
    )


def read_case_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Test cases of one document a file: the messages ``file, id, text, label``, and the files that have none, ``file, reason``.

    Every file is in exactly one of the two, but for files without a byte, which Spark does not list. A document is rejected as a whole if it is no JSON (or repeats a key), has no
    ``X`` or no ``y``, has other keys in one than in the other, or has a key or a label that is no whole number.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    kinds = "struct<X: array<map<string, string>>, y: array<map<string, string>>>"
    # broken texts are set aside first, since the second parser stops at a repeated key
    parsed = whole.withColumn("document", F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", kinds)))
    texts, labels = F.get("document.X", F.lit(0)), F.get("document.y", F.lit(0))
    cases = parsed.select("file", "document", texts.alias("texts"), labels.alias("labels"))

    def whole_number(text: Column) -> Column:
        return text.try_cast("int").isNotNull()

    def missing(part: str) -> Column:
        return F.coalesce(F.size(part) <= 0, F.lit(True))

    def all_keys(part: str) -> Column:
        return F.array_sort(F.map_keys(part))

    reason = (
        F.when(F.col("document").isNull(), "no valid JSON")
        .when(missing("texts"), "no X")
        .when(missing("labels"), "no y")
        .when(all_keys("texts") != all_keys("labels"), "other keys in X than in y")
        .when(F.exists(F.map_keys("texts"), lambda k: ~whole_number(k)), "a key that is no whole number")
        .when(F.exists(F.map_values("labels"), lambda v: ~whole_number(v)), "a label that is no whole number")
    )
    judged = cases.withColumn("reason", reason)
    messages = judged.where("reason IS NULL").select("file", "labels", F.explode("texts").alias("key", "text"))
    kept = messages.select(
        "file", F.col("key").cast("int").alias("id"), "text", F.col("labels")[F.col("key")].cast("int").alias("label")
    )
    return kept, judged.where("reason IS NOT NULL").select("file", "reason")


def in_key_order(cases: DataFrame) -> DataFrame:
    return cases.orderBy("source", "id")


def read_topic(spark: SparkSession, servers: str, topic: str, *, max_offsets: int | None = None) -> DataFrame:
    """Stream of a topic from its earliest record; the checkpoint of the query keeps the position.

    Needs the Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return topic_columns(reader.load())


def topic_columns(records: DataFrame) -> DataFrame:
    """What later steps use of a topic's records: key and value as text, place, and the topic's own time."""
    texts = (F.col(name).cast("string").alias(name) for name in ("key", "value"))
    return records.select(*texts, "topic", "partition", "offset", F.col("timestamp").alias("topic_time"))


def read_split(spark: SparkSession, path: str, part: str) -> DataFrame:
    """One side of a saved split; the filter prunes the other side's folder."""
    return spark.read.parquet(path).where(F.col("split") == part).drop("split")
