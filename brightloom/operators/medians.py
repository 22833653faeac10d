"""Column medians: approximate in one pass, exact in a few, both with bounded state.

A plain exact percentile keeps every distinct value of a column in one task. The
exact medians here close in on the middle rank instead. Each pass counts the rows
below, at and between two values, which settles for certain where the rank lies, and
sketches the rows between them to choose the next two. Only once few enough rows lie
between does a pass look at their values one by one.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators.columns import quoted

# A sketch's rank error is at most rows / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000
# Quantiles asked of the first sketch, close around the middle, and of the later ones.
MIDDLE = tuple(0.5 + side * step for side, step in ((-1, 0.02), (-1, 0.002), (-1, 0.0002), (1, 0.0002), (1, 0.002), (1, 0.02)))
GRID = tuple(i / 64 for i in range(65))


def _batches(columns: Sequence[str], size: int) -> Iterator[list[str]]:
    for start in range(0, len(columns), size or 1):
        yield list(columns[start : start + size])


def approximate_medians(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the approximate median of every column."""
    return df.agg(*(F.percentile_approx(quoted(c), 0.5).alias(c) for c in columns or df.columns))


def approximate_median_values(
    df: DataFrame, columns: Sequence[str] | None = None, batch_size: int | None = None
) -> dict[str, float | None]:
    """Medians as a dictionary; all columns in one scan, or ``batch_size`` columns to a scan."""
    found: dict[str, float | None] = {}
    columns = columns or df.columns
    for batch in _batches(columns, batch_size or len(columns)):
        found.update(approximate_medians(df, batch).first().asDict())
    return found


@dataclass
class _Search:
    """The open interval a column's middle rank is known to lie in; None is unbounded."""

    rank: int = 0
    below: int = 0
    between: int = 0
    low: float | None = None
    high: float | None = None
    fractions: tuple[float, ...] = MIDDLE
    quantiles: list[float] | None = None
    margin: int = 0
    answer: float | None = None
    settled: bool = False

    def settle(self, answer: float | None) -> None:
        self.answer, self.settled = answer, True

    def next_bounds(self) -> tuple[float | None, float | None]:
        """The sketched values around the rank, ``margin`` more steps away after a miss."""
        fraction = (self.rank - self.below) / self.between
        first = bisect_left(self.fractions, fraction - 1 / SKETCH_ACCURACY) - 1 - self.margin
        last = bisect_right(self.fractions, fraction + 1 / SKETCH_ACCURACY) + self.margin
        return (
            self.quantiles[first] if first >= 0 else self.low,
            self.quantiles[last] if last < len(self.fractions) else self.high,
        )


def _between(value: Column, low: float | None, high: float | None) -> Column:
    test = value.isNotNull()
    if low is not None:
        test = test & (value > low)
    if high is not None:
        test = test & (value < high)
    return test


def _counts(value: Column, low: float | None, high: float | None, fractions: tuple[float, ...] = GRID) -> Column:
    """Rows below ``low``, at ``low``, between, at ``high``; and quantiles of those between."""
    none = F.lit(0).cast("long")
    between = _between(value, low, high)
    # parsed as one expression, which is quicker than building the literals one by one
    asked = F.expr("array(" + ", ".join(f"{fraction}D" for fraction in fractions) + ")")
    return F.struct(
        (none if low is None else F.count_if(value < low)).alias("below"),
        (none if low is None else F.count_if(value == low)).alias("at_low"),
        F.count_if(between).alias("between"),
        (none if high is None else F.count_if(value == high)).alias("at_high"),
        F.percentile_approx(F.when(between, value), asked, SKETCH_ACCURACY).alias("quantiles"),
    )


def _one_row(df: DataFrame, columns: dict[str, Column]) -> dict:
    """Aggregate one expression per column, whatever characters the names hold."""
    row = df.agg(*(expression.alias(f"c{i}") for i, expression in enumerate(columns.values()))).first()
    return dict(zip(columns, row))


def exact_median_values(
    df: DataFrame, columns: Sequence[str] | None = None, *, batch_size: int | None = None, few_rows: int = 2_000
) -> dict[str, float | None]:
    """Lower medians (the value at rank ``ceil(n / 2)``), null for a column without values.

    All columns take part in each scan; with ``batch_size`` that many at a time. A column's search
    ends when at most ``few_rows`` of its values are left between the bounds.
    """
    found: dict[str, float | None] = {}
    columns = columns or df.columns
    for batch in _batches(columns, batch_size or len(columns)):
        found.update(_search(df, batch, few_rows))
    return found


def _search(df: DataFrame, columns: list[str], few_rows: int) -> dict[str, float | None]:
    searches = {c: _Search() for c in columns}
    for c, seen in _one_row(df, {c: _counts(quoted(c), None, None, MIDDLE) for c in columns}).items():
        search = searches[c]
        search.between, search.quantiles = seen["between"], seen["quantiles"]
        search.rank = math.ceil(search.between / 2)
        if search.between == 0:
            search.settle(None)
    while unsettled := {c: s for c, s in searches.items() if not s.settled and s.between > few_rows}:
        _close_in(df, unsettled)
    _pick(df, {c: s for c, s in searches.items() if not s.settled})
    return {c: s.answer for c, s in searches.items()}


def _close_in(df: DataFrame, searches: dict[str, _Search]) -> None:
    bounds = {c: search.next_bounds() for c, search in searches.items()}
    seen = _one_row(df, {c: _counts(quoted(c), *bounds[c]) for c in searches})
    for c, search in searches.items():
        (low, high), counts = bounds[c], seen[c]
        up_to_low = counts["below"] + counts["at_low"]
        up_to_between = up_to_low + counts["between"]
        if low is not None and counts["below"] < search.rank <= up_to_low:
            search.settle(low)
        elif up_to_low < search.rank <= up_to_between:
            search.low, search.high, search.below, search.between = low, high, up_to_low, counts["between"]
            search.fractions, search.quantiles, search.margin = GRID, counts["quantiles"], 0
        elif high is not None and up_to_between < search.rank <= up_to_between + counts["at_high"]:
            search.settle(high)
        else:
            search.margin += 1  # the sketch missed: try a wider interval


def _sorted(value: Column) -> Column:
    return F.sort_array(F.collect_list(value))


def _pick(df: DataFrame, searches: dict[str, _Search]) -> None:
    """Look the rank up among the few values left between the bounds."""
    if not searches:
        return
    values = {
        c: _sorted(F.when(_between(quoted(c), s.low, s.high), quoted(c)))[s.rank - s.below - 1]
        for c, s in searches.items()
    }
    for c, value in _one_row(df, values).items():
        searches[c].settle(value)


def median_table(spark: SparkSession, medians: dict[str, float | None]) -> DataFrame:
    """``column, median`` rows of a dictionary of medians."""
    rows = [(c, None if m is None else float(m)) for c, m in medians.items()]
    return spark.createDataFrame(rows, "column string, median double")
