"""Sinks for processed rows and chart feeds, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators.charts import (
    POINTS,
    POINTS_SCHEMA,
    chart_points,
    newest_points,
    place_points,
)
from tidewire.spec import SEQUENCE, Chart
from tidewire.streaming.progress import count_written


def write_processed(
    df: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None
) -> StreamingQuery | None:
    """Write processed rows as Parquet. A stream needs ``checkpoint`` and returns its query; its reports count the rows
    written (see ``streaming.progress``).

    A batch with sequence numbers is written in their order: each file is sorted, and holds higher numbers than
    the files named before it.
    """
    if not df.isStreaming:
        if SEQUENCE in df.columns:
            df = df.repartitionByRange(SEQUENCE).sortWithinPartitions(SEQUENCE)
        df.write.mode(mode).parquet(path)
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint folder")
    return (
        count_written(df).writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def write_feed(
    df: DataFrame,
    path: str,
    charts: Sequence[Chart],
    n: int = POINTS,
    seq_col: str = SEQUENCE,
    mode: str = "overwrite",
    checkpoint: str | None = None,
) -> StreamingQuery | None:
    """Write the last ``n`` points of each chart; they are few, so they are replaced as a whole.

    Each micro-batch of a stream merges its points with those of the batch before into its own
    folder ``batch=<id>``, so a batch that is run again replaces only its own work.
    """
    if not df.isStreaming:
        chart_points(df, charts, n, seq_col).write.mode(mode).parquet(path)
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint folder")

    def merge(batch: DataFrame, batch_id: int) -> None:
        points = chart_points(batch, charts, n, seq_col)
        if batch_id > 0:
            points = points.unionByName(_points_of(batch.sparkSession, path, batch_id - 1))
        newest_points(points, n).coalesce(1).write.mode("overwrite").parquet(_folder(path, batch_id))

    return (
        df.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_feed(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """The feed as written by a batch write, or by micro-batch ``batch_id`` of a stream."""
    return place_points(_points_of(spark, path, batch_id))


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def _points_of(spark: SparkSession, path: str, batch_id: int | None) -> DataFrame:
    folder = path if batch_id is None else _folder(path, batch_id)
    return spark.read.schema(POINTS_SCHEMA).parquet(folder)
