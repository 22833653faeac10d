"""Streams into the predictions table, each batch exactly once.

A batch is staged first, in day folders that no reader looks at. One row in the ledger, under the batch's query
and number, then makes it count, and its folders become partitions of the table. Whatever is lost in between is made up for when
the batch is replayed: staged folders without a ledger row are written again, and a batch with one is only published again.
Readers of the table never see a part of a batch.

The ledger also keeps how many rows each day got, so the newest rows are found without opening older days, and the largest
offset of each topic partition, so that records delivered again are dropped without state by key.

A query's name stands for its checkpoint: a new checkpoint needs a new name. The ledger's row is one
file, which the commit of its write renames into place; an object store needs a committer that does this.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators.predictions import create_daily_table, newest
from brightloom.streaming.ingest import of_sink

LEDGER = (
    "query string, batch long, folder string, days array<struct<day: date, n: long>>,"
    " marks array<struct<topic: string, partition: int, offset: long>>"
)
OFFSETS = ("topic", "partition", "offset")
Hook = Callable[[int], None]


def ignore(batch: int) -> None:
    pass


@dataclass
class TableSink:
    """Writes the batches of one query; ``write`` is for ``foreachBatch``.

    Rows bring ``message, prediction`` and may bring their ``timestamp``; one without gets the time of storing. With
    ``by_offset`` they also bring ``topic, partition, offset``, none of them null, and a record whose offset was seen
    is dropped. Offsets of a topic partition must arrive in order, as a topic gives them; within a batch any order will do.

    ``staged`` and ``committed`` are called with a batch's number after it was staged and after it was made to count.
    """

    spark: SparkSession
    table: str
    root: str
    query: str
    by_offset: bool = False
    staged: Hook = ignore
    committed: Hook = ignore
    _marks: dict[tuple[str, int], int] | None = field(default=None, init=False)

    def __post_init__(self) -> None:
        create_daily_table(self.spark, self.table, f"{self.root}/table")

    def write(self, batch: DataFrame, number: int) -> None:
        done = self._row(number)
        if done is None:
            days, marks = self._stage(batch, number)
            self.staged(number)
            done = (self.query, number, self._folder(number), days, marks)
            one = self.spark.createDataFrame([done], LEDGER).coalesce(1)
            one.write.mode("overwrite").parquet(self._entry(number))
            self._marks = {(t, p): o for t, p, o in marks}
            self.committed(number)
        self._publish(*done[2:4], number)

    def _folder(self, number: int) -> str:
        return f"{self.root}/loads/{self.query}/{number}"

    def _entry(self, number: int) -> str:
        return f"{self.root}/ledger/{self.query}/{number}"

    def _row(self, number: int) -> tuple | None:
        """The ledger's row of a batch."""
        row = of_sink(self.spark, self._entry(number), LEDGER).first()
        return None if row is None else tuple(row)

    def _stage(self, batch: DataFrame, number: int) -> tuple[list, list]:
        """Write a batch's folders over those of a lost attempt; rows by day, and the new marks."""
        rows = batch if "timestamp" in batch.columns else batch.withColumn("timestamp", F.lit(None).cast("timestamp"))
        rows = rows.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp()))
        kept = ["timestamp", "message", "prediction"]
        if self.by_offset:
            rows, kept = self._unseen(rows), [*kept, *OFFSETS]
        folder = self._folder(number)
        days = rows.select(*kept, F.to_date("timestamp").alias("day"))
        days.sortWithinPartitions("day", "timestamp").write.mode("overwrite").partitionBy("day").parquet(folder)

        stored = of_sink(self.spark, folder, days.schema)
        counts = [(r["day"], r["count"]) for r in stored.groupBy("day").count().orderBy("day").collect()]
        if not self.by_offset:
            return counts, []
        # a row for each topic partition of the batch
        highest = stored.groupBy("topic", "partition").agg(F.max("offset").alias("highest")).collect()
        marks = self.marks() | {(r["topic"], r["partition"]): r["highest"] for r in highest}
        return counts, [(t, p, o) for (t, p), o in sorted(marks.items())]

    def marks(self) -> dict[tuple[str, int], int]:
        """The largest stored offset of each topic partition."""
        if self._marks is None:
            last = self.entries().where(F.col("query") == self.query).orderBy(F.desc("batch")).first()
            self._marks = {} if last is None else {(m["topic"], m["partition"]): m["offset"] for m in last["marks"]}
        return self._marks

    def _unseen(self, rows: DataFrame) -> DataFrame:
        """Rows over the marks, each offset once."""
        marks = self.spark.createDataFrame(
            [(t, p, o) for (t, p), o in self.marks().items()], "topic string, partition int, mark long"
        )
        named = F.assert_true(F.expr("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL"))
        # a row for each topic partition
        marked = rows.where(named.isNull()).join(F.broadcast(marks), ["topic", "partition"], "left")
        return marked.where(F.col("offset") > F.coalesce("mark", F.lit(-1))).drop("mark").dropDuplicates([*OFFSETS])

    def _publish(self, folder: str, days: Sequence, number: int) -> None:
        """Make a counted batch visible; repeating it changes nothing."""
        if days:
            parts = (f"PARTITION (day = DATE'{day}', load = '{self.query}-{number}') LOCATION '{folder}/day={day}'" for day, _ in days)
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(parts)}")

    def entries(self) -> DataFrame:
        """The ledger: a row for each batch of any query that counts."""
        return of_sink(self.spark, f"{self.root}/ledger/*/*", LEDGER)

    def restore(self) -> None:
        """Publish all batches of the ledger, for a catalogue that does not know them."""
        for row in self.entries().toLocalIterator():
            TableSink(self.spark, self.table, self.root, row["query"])._publish(row["folder"], row["days"], row["batch"])

    def rows(self) -> DataFrame:
        return self.spark.table(self.table).select("timestamp", "message", "prediction", "load")

    def newest(self, n: int = 10, tie: str | None = None) -> DataFrame:
        """The ``n`` latest rows; days that the ledger shows to be too old are not opened."""
        by_day = self.entries().select(F.inline("days")).groupBy("day").agg(F.sum("n").alias("n")).orderBy(F.desc("day"))
        found, earliest = 0, None
        # ends as soon as there are enough rows, as a rule with the first day
        for row in by_day.toLocalIterator():
            found, earliest = found + row["n"], row["day"]
            if found >= n:
                break
        recent = self.spark.table(self.table)
        if earliest is not None:
            recent = recent.where(F.col("day") >= F.lit(earliest))
        return newest(recent.select("timestamp", "message", "prediction"), n, tie=tie)
