"""What a rolling mean carries from one micro-batch to the next: the last ``window - 1`` accepted values."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewire.operators.ordering import BUCKET_WIDTH, KeySpread
from tidewire.operators.rolling import rolling_average
from tidewire.spec import AVERAGE

_OLD = "__old"
_VALUES = "seq bigint, value double"


class Tail(NamedTuple):
    """Where the values are, their least number, and how many they are."""

    path: str
    low: int
    rows: int


def carried_average(
    rows: DataFrame, tail: Tail | None, seq_col: str, value_col: str, window: int, spread: KeySpread | None = None
) -> DataFrame:
    """``rolling_average`` of ``rows``, whose first windows reach back into the values kept before."""
    names = rows.columns
    if tail is None:
        return rolling_average(rows, seq_col, value_col, window, spread=spread)
    kind = {c: rows.schema[c].dataType for c in (seq_col, value_col)}
    values = rows.sparkSession.read.schema(_VALUES).parquet(tail.path)
    # the values kept go first, with no other column
    old = values.select(
        F.col("seq").cast(kind[seq_col]).alias(seq_col),
        F.col("value").cast(kind[value_col]).alias(value_col),
        F.lit(True).alias(_OLD),
    )
    both = rows.withColumn(_OLD, F.lit(False)).unionByName(old, allowMissingColumns=True)
    if spread:
        spread = KeySpread(tail.low, spread.low + spread.span - tail.low, spread.rows + tail.rows)
    averaged = rolling_average(both, seq_col, value_col, window, spread=spread)
    return averaged.filter(~F.col(_OLD)).select(*names, AVERAGE)


def keep_last_values(
    written: DataFrame, rows: int, tail: Tail | None, seq_col: str, value_col: str, window: int, path: str
) -> Tail | None:
    """Store the last values after ``rows`` rows were ``written``; ``tail`` stays if there are none."""
    most = window - 1
    if not most or not rows:
        return tail
    values = written.select(F.col(seq_col).cast("bigint").alias("seq"), F.col(value_col).cast("double").alias("value"))
    if tail and rows < most:
        values = values.unionByName(written.sparkSession.read.schema(_VALUES).parquet(tail.path))
    seen = Observation()
    last = values.orderBy(F.desc("seq")).limit(most).observe(seen, F.min("seq").alias("low"), F.count("*").alias("rows"))
    last.write.mode("overwrite").parquet(path)
    return Tail(path, seen.get["low"], seen.get["rows"])


def write_in_order(rows: DataFrame, seq_col: str, span: int, path: str, grouped: bool) -> int:
    """Write released rows sorted, one file if they span one stretch; how many they are.

    ``grouped`` rows come from a window and lie by stretch already."""
    seen = Observation()
    if span > BUCKET_WIDTH:
        rows = rows.repartitionByRange(seq_col)
    elif not grouped:
        rows = rows.repartition(1)
    # counted behind the shuffle: to find the ranges, all that lies before it is run once more
    rows = rows.observe(seen, F.count("*").alias("rows"))
    rows.sortWithinPartitions(seq_col).write.mode("overwrite").parquet(path)
    return seen.get["rows"]
