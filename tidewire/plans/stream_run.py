"""A whole run as a stream: CSV files in, every table of a run out, a micro-batch at a time.

One micro-batch scans its files once, sets faulty lines and bad rows aside, numbers the clean rows on from those of
the batches before, verifies them, carries the rolling mean on, and merges the last points into the chart feed. Each
sink has a folder per batch. A batch counts once its notes are written, after all of its sinks: readers look no
further than the last notes, and a batch that was cut off half-way is run again over its own folders only.

Files are numbered in the order of their paths within a batch, and batches in the order in which they come. A stream
whose files land in the order of their paths thus has the numbers of a batch scan over all of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators import charts, health, ingest
from tidewire.operators.ordering import KeySpread
from tidewire.operators.staging import FAULTS, QUARANTINE, Staged, stage_scan
from tidewire.operators.verify import DigestTable, verify_signatures
from tidewire.plans.run import flag_and_store, processed_schema
from tidewire.sources.csv import csv_header, line_errors, stream_csv
from tidewire.spec import SEQUENCE, STAGES, RunSpec
from tidewire.streaming.carry import Tail, carried_average, keep_last_values, write_in_order
from tidewire.workspace import exists, free, get_text, names_in, put_text, small_frame

#: Folders of one batch; the name is one that no input column has.
_BATCH = "__batch"
#: Iterations from which a digest is worth being looked up.
KEPT_FROM = 1000
SINKS = ("clean", "processed", "quarantine", "faults", "feed")


@dataclass(frozen=True)
class _Notes:
    """What a batch hands on: rows and clean rows so far, faults by kind, and where the last values are."""

    batch: int = -1
    rows: int = 0
    clean: int = 0
    bad: int = 0
    verified: int = 0
    overlong: int = 0
    open: int = 0
    tail: Tail | None = None
    feed: str | None = None
    sizes: tuple[int, ...] = field(default=())

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def of(cls, text: str) -> _Notes:
        kept = json.loads(text)
        return cls(**{**kept, "tail": Tail(*kept["tail"]) if kept["tail"] else None, "sizes": tuple(kept["sizes"])})


@dataclass(frozen=True)
class StreamRun:
    """The sinks of a streamed run under ``out``; what passes from batch to batch lies under ``state``."""

    spec: RunSpec
    out: str
    state: str

    # ---- one micro-batch --------------------------------------------------------------------

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark, spec = batch.sparkSession, self.spec
        before = self._notes(spark, batch_id - 1) if batch_id else _Notes()
        lines = batch.withColumn("__line", F.monotonically_increasing_id())
        if spec.multiline:
            lines = lines.withColumn("__open", F.lit(False))
        staged_path = self._folder("staged", batch_id, self.state)
        staged = stage_scan(
            lines, spec.columns, staged_path, self._folder("splits", batch_id, self.state), keep_lines=not spec.multiline
        )
        clean = self._folder("clean", batch_id)
        flagged, verified = flag_and_store(staged.good(start=before.clean + 1), spec, clean, self._verifier(batch_id))
        tail = self._average(flagged, staged.good_rows, verified, before, batch_id)
        bad = self._set_aside(staged, before, batch_id)
        feed = self._merge_feed(spark, before, batch_id)
        notes = _Notes(
            batch_id,
            before.rows + staged.counts["loaded"],
            before.clean + staged.good_rows,
            before.bad + bad,
            before.verified + verified,
            before.overlong + staged.counts["overlong"],
            before.open + staged.counts["open"],
            tail,
            feed,
            (staged.counts["loaded"], staged.good_rows, verified),
        )
        put_text(spark, self._notes_path(batch_id), notes.text())
        free(spark, [staged_path, self._folder("splits", batch_id, self.state)])

    def _verifier(self, batch_id: int) -> Callable[[DataFrame], DataFrame]:
        """Costly digests are kept from batch to batch; cheap ones are hashed where the rows are."""
        spec = self.spec
        names = {"value_col": spec.value_col, "signature_col": spec.signature_col, "keep_flag": True}
        if spec.iterations >= KEPT_FROM:
            table = DigestTable(f"{self.state}/digests", spec.secret_key, spec.iterations)
            return lambda rows: table.verify(rows, batch_id, **names)
        return lambda rows: verify_signatures(rows, spec.secret_key, spec.iterations, route="udf", **names)

    def _average(self, flagged: DataFrame, rows: int, verified: int, before: _Notes, batch_id: int) -> Tail | None:
        """Write the verified rows with their mean; where the last values are after them."""
        spark, path = flagged.sparkSession, self._folder("processed", batch_id)
        if not verified:
            small_frame(spark, [], processed_schema(self.spec)).write.mode("overwrite").parquet(path)
            return before.tail
        value, window = self.spec.value_col, self.spec.window
        accepted = flagged.filter("verified").drop("verified")
        spread = KeySpread(before.clean + 1, rows, verified)
        averaged = carried_average(accepted, before.tail, SEQUENCE, value, window, spread)
        written = write_in_order(averaged, SEQUENCE, rows, path, grouped=True)
        kept = self._folder("tail", batch_id, self.state)
        return keep_last_values(spark.read.parquet(path), written, before.tail, SEQUENCE, value, window, kept)

    def _set_aside(self, staged: Staged, before: _Notes, batch_id: int) -> int:
        """Write bad rows and faulty lines, if there are any; how many rows are bad."""
        spark, counts, bad = staged.spark, staged.counts, 0
        paths = {sink: self._folder(sink, batch_id) for sink in ("quarantine", "faults")}
        free(spark, [p for p in paths.values() if exists(spark, p)])
        if counts["bad"]:
            rows = staged.quarantine(start=before.rows).sortWithinPartitions("row_index")
            rows.write.mode("overwrite").parquet(paths["quarantine"])
            bad = counts["bad"] if staged.torn is None else spark.read.parquet(paths["quarantine"]).count()
        if counts["fault"]:
            staged.faults().write.mode("overwrite").parquet(paths["faults"])
        return bad

    def _merge_feed(self, spark: SparkSession, before: _Notes, batch_id: int) -> str | None:
        """The last points of the charts, of this batch and those before."""
        if not self.spec.charts:
            return None
        processed = spark.read.schema(processed_schema(self.spec)).parquet(self._folder("processed", batch_id))
        points = charts.chart_points(processed, self.spec.charts, charts.POINTS, SEQUENCE)
        if before.feed:
            points = points.unionByName(spark.read.schema(charts.POINTS_SCHEMA).parquet(before.feed))
        path = self._folder("feed", batch_id)
        charts.newest_points(points, charts.POINTS).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    # ---- what has been committed ------------------------------------------------------------

    def table(self, spark: SparkSession, sink: str) -> DataFrame:
        """All committed rows of a sink; of ``feed`` the points as they are now."""
        if sink not in SINKS:
            raise ValueError(f"sink must be one of {SINKS}")
        last = self._last(spark)
        if sink == "feed":
            schema = charts.POINTS_SCHEMA
            points = spark.read.schema(schema).parquet(last.feed) if last.feed else small_frame(spark, [], schema)
            return charts.place_points(points)
        folder, schema = f"{self.out}/{sink}", self._schema(sink)
        if last.batch < 0 or not exists(spark, folder):
            return small_frame(spark, [], schema)
        # the folder's number is a column here, and is pruned by
        rows = spark.read.schema(f"{schema}, {_BATCH} int").parquet(folder)
        return rows.filter(F.col(_BATCH) <= last.batch).drop(_BATCH)

    def counts(self, spark: SparkSession) -> DataFrame:
        """Rows loaded, passed and skipped so far; lines set aside as faulty are in none of the last two."""
        last = self._last(spark)
        return small_frame(spark, [(last.rows, last.clean, last.bad)], "loaded bigint, passed bigint, skipped bigint")

    def errors(self, spark: SparkSession) -> DataFrame:
        """How many lines were cut or torn, as ``scan_errors`` tells it of a batch."""
        last = self._last(spark)
        return line_errors(small_frame(spark, [(last.overlong, last.open)], "overlong bigint, open bigint"))

    def fault_counts(self, spark: SparkSession) -> DataFrame:
        """Lines set aside per file and code."""
        return self.table(spark, "faults").groupBy("file", "code").agg(F.count("*").alias("lines"))

    def samples(self, spark: SparkSession) -> DataFrame:
        """Rows read, clean and verified per batch, with the declared capacity, for ``stage_health``."""
        last = self._last(spark)
        if last.batch < 0:
            return small_frame(spark, [], health.SAMPLES)
        notes = spark.read.schema("batch bigint, sizes array<bigint>").json(f"{self.state}/notes")
        named = F.arrays_zip(F.array(*map(F.lit, STAGES)).alias("stage"), F.col("sizes").alias("size"))
        rows = notes.filter(F.col("batch") <= last.batch).select(F.col("batch").alias("sample"), F.inline(named))
        return rows.select("sample", "stage", "size", F.lit(self.spec.queue_max_size).cast("bigint").alias("max"))

    def health(self, spark: SparkSession) -> DataFrame:
        """Fill, colour and label of the stages that the configuration shows, per batch."""
        return health.stage_health(self.samples(spark), self.spec.show)

    def _schema(self, sink: str) -> str:
        declared = processed_schema(self.spec)
        return {
            "clean": f"{declared.rpartition(', ')[0]}, verified boolean",
            "processed": declared,
            "quarantine": QUARANTINE,
            "faults": FAULTS,
        }[sink]

    def _folder(self, part: str, batch_id: int, top: str | None = None) -> str:
        return f"{top or self.out}/{part}/{_BATCH}={batch_id}"

    def _notes_path(self, batch_id: int) -> str:
        return f"{self.state}/notes/batch={batch_id}.json"

    def _notes(self, spark: SparkSession, batch_id: int) -> _Notes:
        text = get_text(spark, self._notes_path(batch_id))
        if text is None:
            raise RuntimeError(f"state of batch {batch_id} is not in {self.state}")
        return _Notes.of(text)

    def _last(self, spark: SparkSession) -> _Notes:
        names = [n for n in names_in(spark, f"{self.state}/notes") if n.endswith(".json")]
        done = [int(n.removeprefix("batch=").removesuffix(".json")) for n in names]
        return self._notes(spark, max(done)) if done else _Notes()


def run_stream(
    spark: SparkSession, spec: RunSpec, out: str, state: str, checkpoint: str, max_files: int = 1, every: str | None = None
) -> tuple[StreamingQuery, StreamRun]:
    """Run ``spec`` over the CSV files of its folder, ``max_files`` per batch: those there now, or a batch ``every``
    so often. At least one file must be there, as the header says which columns there are; all files must agree on it."""
    header = csv_header(spark, spec.dataset_path, spec.multiline)
    lacking = [c.source_name for c in spec.columns if c.source_name not in header]
    if lacking:
        raise ValueError("; ".join(ingest.MISSING.format(name) for name in lacking))
    lines = stream_csv(spark, spec.dataset_path, header, max_files, multiline=spec.multiline, ragged=True)
    run = StreamRun(spec, out, state)
    writer = lines.writeStream.foreachBatch(run.run_batch).option("checkpointLocation", checkpoint)
    pace = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**pace).start(), run
