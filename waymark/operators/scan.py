"""What comes before a row, over chunks: scans whose longest task is a chunk, not an episode.

A group's rows are cut by position into chunks of ``size`` positions, which Spark deals out like any
other key.  Each chunk is reduced to a summary of one row, the summaries of a group are scanned by
a window - it has as many rows as the group has chunks - and what a chunk is handed on meets its
rows by the key that they are dealt by already.  Rows are read twice, for the summaries and for
the result, so those that are dear to make are written once before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from waymark.sources.scratch import materialize

#: Positions in a chunk.
SIZE = 4096
CHUNK = "_chunk"


def with_chunk(rows: DataFrame, position: str, size: int = SIZE) -> DataFrame:
    """The rows with the number of their chunk."""
    return rows.withColumn(CHUNK, F.floor(F.col(position) / F.lit(size)).cast("long"))


def in_chunks(rows: DataFrame, position: str, size: int = SIZE) -> DataFrame:
    """``with_chunk``, written once; for rows that are dear to make."""
    return materialize(with_chunk(rows, position, size), "chunks")


def within(by: list[str], position: str) -> WindowSpec:
    """The rows of one chunk in order."""
    return Window.partitionBy(*by, CHUNK).orderBy(position)


def across(by: list[str]) -> WindowSpec:
    """The chunks of one group in order."""
    return Window.partitionBy(*by).orderBy(CHUNK)


def handed_on(rows: DataFrame, summaries: DataFrame, by: list[str]) -> DataFrame:
    """Each row beside what the chunks before its own hand on."""
    return rows.join(summaries, [*by, CHUNK], "left")


def lags(chunked: DataFrame, by: list[str], position: str, columns: dict[str, str]) -> DataFrame:
    """Add to each row values of the row before it: ``columns`` maps new names to old ones."""
    order = within(by, position)
    names = list(columns)
    inner = chunked.withColumns(
        {"_at": F.row_number().over(order)} | {name: F.lag(old).over(order) for name, old in columns.items()}
    )
    last = chunked.groupBy(*by, CHUNK).agg(
        F.max_by(F.struct(*[F.col(old).alias(name) for name, old in columns.items()]), position).alias("_last")
    )
    before = last.select(*by, CHUNK, F.lag("_last").over(across(by)).alias("_before"))
    found = {n: F.when(F.col("_at") == 1, F.col("_before")[n]).otherwise(F.col(n)) for n in names}
    return handed_on(inner, before, by).withColumns(found).drop("_at", "_before")


def earlier_sum(chunked: DataFrame, by: list[str], position: str, value: Column, name: str) -> DataFrame:
    """Add the sum of a whole number over all rows before each row (0 for the first)."""
    before = within(by, position).rowsBetween(Window.unboundedPreceding, -1)
    earlier = across(by).rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(*by, CHUNK).agg(F.sum(value).alias("_sum"))
    bases = totals.select(*by, CHUNK, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inner = chunked.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    return handed_on(inner, bases, by).withColumn(name, F.col("_base") + F.col(name)).drop("_base")


def _settled_by(order: WindowSpec, settled: Column, turn: Column) -> tuple[Column, Column]:
    """(last settled value up to here turned as often as since then, turns since the last
    settled value or the start)."""
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum(F.when(settled.isNull(), turn).otherwise(0)).over(so_far)
    start = F.last(F.when(settled.isNotNull(), F.struct(settled.alias("value"), turned.alias("turned"))), ignorenulls=True).over(so_far)
    since = turned - F.coalesce(start["turned"], F.lit(0))
    return start["value"] != (since % 2 == 1), since


def settle(chunked: DataFrame, by: list[str], position: str, settled: str, turn: str, name: str) -> DataFrame:
    """Add a truth value - ``settled`` where that is known, else the one of the row before,
    turned round if ``turn`` is 1 - and as ``<name>_before`` that of the row before.

    A chunk's summary is of the same form as a row - a value, or how it turns what it is
    handed - so both levels are the same computation.  A group's first row is settled.
    """
    value, since = _settled_by(within(by, position), F.col(settled), F.col(turn))
    inner = chunked.withColumns({"_value": value, "_since": since})
    ends = inner.groupBy(*by, CHUNK).agg(
        F.max_by(F.struct("_value", (F.col("_since") % 2).alias("_odd")), position).alias("_end")
    )
    ends = ends.select(*by, CHUNK, F.col("_end._value").alias("_value"), F.col("_end._odd").alias("_odd"))
    upto, _ = _settled_by(across(by), F.col("_value"), F.col("_odd"))
    ends = ends.withColumn("_upto", upto)
    before = ends.select(*by, CHUNK, F.lag("_upto").over(across(by)).alias("_before"))
    passed = F.col("_before") != (F.col("_since") % 2 == 1)
    found = handed_on(inner, before, by).withColumn(name, F.coalesce("_value", passed))
    one_back = F.lag(name).over(within(by, position))
    return found.withColumn(f"{name}_before", F.coalesce(one_back, "_before")).drop("_value", "_since", "_before")
