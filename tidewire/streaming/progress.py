"""Stage samples of streaming queries, for ``stage_health``."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidewire.operators.health import SAMPLES
from tidewire.spec import STAGES, whole_number
from tidewire.streaming.release import Release
from tidewire.workspace import exists, put_text, small_frame

#: The observation by which a streaming plan counts the rows that it writes, and its one metric.
WRITTEN, ROWS = "tidewire_written", "rows"


def count_written(sdf: DataFrame) -> DataFrame:
    """Count the rows of each micro-batch as they pass: sinks that write files do not report how many they wrote."""
    return sdf.observe(WRITTEN, F.count("*").alias(ROWS))


def _sizes(report) -> dict[str, int | None]:
    """Rows read, held in state and written by one micro-batch; null for what is not known."""
    observed = report["observedMetrics"].get(WRITTEN)
    told = report["sink"]["numOutputRows"]
    written = observed[ROWS] if observed is not None else told if told is not None and told >= 0 else None
    state = sum(op["numRowsTotal"] for op in report["stateOperators"])
    return dict(zip(STAGES, (report["numInputRows"], state, written)))


def progress_samples(spark: SparkSession, query: StreamingQuery, capacity: int) -> DataFrame:
    """One row per recent micro-batch and stage: rows read, rows in state, rows written (null if unknown).

    Spark keeps a bounded number of progress reports per query; ``ProgressLog`` keeps all.
    """
    whole_number("capacity", capacity)
    rows = [
        (report["batchId"], stage, size, capacity)
        for report in query.recentProgress
        for stage, size in _sizes(report).items()
    ]
    return small_frame(spark, rows, SAMPLES)


class ProgressLog(StreamingQueryListener):
    """Every progress report of the streams started while it listens, kept as a table below ``path``.

    One small file per report, so a stream of any length is kept whole; the driver holds none of them."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._end_of(event.id)

    def onQueryProgress(self, event) -> None:
        report = event.progress
        rows = [
            {"sample": report["batchId"], "stage": stage, "size": size} for stage, size in _sizes(report).items()
        ]
        put_text(self._spark, f"{self._path}/{report['id']}/batch={report['batchId']}.json", "\n".join(map(json.dumps, rows)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(event.id).set()

    def _end_of(self, query_id) -> threading.Event:
        return self._ended.setdefault(str(query_id), threading.Event())

    def samples(self, query: StreamingQuery, capacity: int, patience: float = 60.0) -> DataFrame:
        """One row per micro-batch and stage of ``query``. Reports come a little later than the batches that they tell of:
        of a query that has ended the last is waited for."""
        whole_number("capacity", capacity)
        if not query.isActive:
            self._end_of(query.id).wait(patience)
        folder = f"{self._path}/{query.id}"
        if not exists(self._spark, folder):
            return small_frame(self._spark, [], SAMPLES)
        stored = self._spark.read.schema(SAMPLES).json(folder)
        return stored.select("sample", "stage", "size", F.lit(capacity).cast("bigint").alias("max"))


def release_samples(spark: SparkSession, release: Release, capacity: int) -> DataFrame:
    """One row per micro-batch and stage of a release: rows come in, waiting, and given out."""
    whole_number("capacity", capacity)
    stored = spark.read.schema(SAMPLES).json(f"{release.out}/samples")
    return stored.select("sample", "stage", "size", F.lit(capacity).cast("bigint").alias("max"))
