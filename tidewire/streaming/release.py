"""Streams released in sequence order, with a rolling mean, by micro-batch.

A global sequence has one order, so keyed state would put it, and its whole backlog, into a single task. Here each
micro-batch is worked on by distributed jobs instead, and what passes from batch to batch lies in shared folders:

* the rows, written once as they come, sorted, one segment per batch (``out/arrived``). A segment is read again when
  some of its numbers are due, and only the part that holds them;
* the numbers of each segment as bits, 64 to a row (``state/bits``), from which repeats and the next number missing
  are found without reading any waiting row;
* notes of a few hundred bytes: the next number expected, the segments that still hold rows back, and where the last
  ``window - 1`` accepted values are. They are written last, and commit the batch.

So a batch writes what it brings and what it releases, however long the backlog is. Segments that wait long are
merged sixteen at a time, so that they stay few. Every folder carries its batch number: a batch that is run again
replaces its own work and nothing else.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators.ordering import KeySpread
from tidewire.spec import AVERAGE, whole_number
from tidewire.streaming.carry import Tail, carried_average, keep_last_values, write_in_order
from tidewire.workspace import exists, free, get_text, put_text, small_frame

# Fixed value: seconds a later row waits before a gap is passed.
GAP_TIMEOUT = 2.0
# Segments of one level that are merged into one of the next.
MERGED_AT_ONCE = 16

_KIND, _ROW = "__kind", "__row"
TICK = "__tick"
PARTS = ("rows", "late", "repeated", "no_sequence")
_ROW_FIELD = T.StructField(_ROW, T.LongType())
_BITS = "word bigint, bits bigint, n bigint"
_FULL = (1 << 64) - 1


@dataclass(frozen=True)
class Segment:
    """Rows of one or more batches: where they are, where their numbers' bits are, and what they reach over.

    ``marks`` are pairs of arrival time and highest number, from which overdue gaps are told."""

    rows: str
    bits: str
    low: int
    high: int
    level: int
    marks: tuple[tuple[float, int], ...]


@dataclass(frozen=True)
class _Notes:
    batch: int
    expected: int
    segments: tuple[Segment, ...] = ()
    tail: Tail | None = None
    #: what no later batch reads
    dropped: tuple[str, ...] = field(default=())

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> _Notes:
        kept = json.loads(text)
        segments = [Segment(**{**s, "marks": tuple(map(tuple, s["marks"]))}) for s in kept.pop("segments")]
        tail = kept.pop("tail")
        return cls(**kept, segments=tuple(segments), tail=Tail(*tail) if tail else None)


@dataclass(frozen=True)
class Release:
    """Where and how a sequence is released. ``accepted_col`` marks rows that only fill their place.

    Of rows with one number the first is released. Rows without a number are kept apart.
    ``gap_timeout`` seconds after a later row came in, a gap below it is passed (``GAP_TIMEOUT`` is the
    usual time); ``None`` waits for ever. The clock is read once per micro-batch.
    """

    out: str
    state: str
    seq_col: str
    value_col: str | None = None
    window: int = 1
    accepted_col: str | None = None
    gap_timeout: float | None = None
    first: int = 1
    clock: Callable[[], float] = time.time

    def __post_init__(self):
        whole_number("window", self.window)
        if self.gap_timeout is not None and self.gap_timeout < 0:
            raise ValueError("gap_timeout must not be negative")

    # ---- one micro-batch --------------------------------------------------------------------

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if TICK in batch.columns:
            batch = batch.filter(~F.col(TICK)).drop(TICK)
        before = self._notes(spark, batch_id - 1) if batch_id else _Notes(-1, self.first)
        free(spark, before.dropped)
        now = self.clock()
        schema = batch.schema
        arrived, counts = self._arrive(batch, batch_id, before.expected)
        overdue = [high for s in before.segments for since, high in s.marks if self._is_overdue(since, now)]
        reached = max([before.expected - 1, *overdue])
        expected, waiting, due_rows, segments = before.expected, 0, 0, list(before.segments)
        if counts["open"] or segments:
            bits = self._folder("bits", batch_id, self.state)
            found = self._number(spark, arrived, bits, before, reached, schema)
            rows = f"{arrived}/{_KIND}=open"
            if found["conflicts"]:
                rows = self._without_repeats(spark, rows, bits, before, schema, batch_id)
            expected = found["expected"]
            due_rows = found["below"] + expected - 1 - reached
            waiting = found["total"] - due_rows
            if counts["open"]:
                segments.append(Segment(rows, bits, counts["low"], counts["high"], 0, ((now, counts["high"]),)))
        released, tail = self._release(spark, schema, segments, before, expected, due_rows, batch_id)
        live = [s for s in segments if s.high >= expected]
        kept = self._merge(spark, live, expected, schema, batch_id)
        dropped = [p for s in segments if s not in kept for p in (s.rows, s.bits)]
        sizes = {"raw": counts["fresh"], "intermediate": waiting, "processed": released}
        samples = [{"sample": batch_id, "stage": stage, "size": size} for stage, size in sizes.items()]
        put_text(spark, f"{self.out}/samples/batch={batch_id}.json", "\n".join(map(json.dumps, samples)))
        notes = _Notes(batch_id, expected, tuple(kept), tail, tuple(dropped))
        put_text(spark, self._notes_path(batch_id), notes.text())
        # two are kept, as the last batch may be run again
        free(spark, [self._notes_path(batch_id - 2)])

    def _arrive(self, batch: DataFrame, batch_id: int, expected: int) -> tuple[str, dict]:
        """Write the batch's rows by kind, sorted: its only pass over them."""
        seq = F.col(self.seq_col)
        kind = F.when(seq.isNull(), "no_sequence").when(seq < expected, "late").otherwise("open")
        is_open = F.col(_KIND) == "open"
        seen = Observation()
        path = self._folder("arrived", batch_id)
        marked = batch.withColumns({_KIND: kind, _ROW: F.monotonically_increasing_id()}).observe(
            seen,
            F.count("*").alias("fresh"),
            F.count_if(is_open).alias("open"),
            F.min(F.when(is_open, seq)).alias("low"),
            F.max(F.when(is_open, seq)).alias("high"),
        )
        marked.sortWithinPartitions(_KIND, seq).write.mode("overwrite").partitionBy(_KIND).parquet(path)
        return path, seen.get

    def _number(
        self, spark: SparkSession, arrived: str, bits: str, before: _Notes, reached: int, schema: T.StructType
    ) -> dict:
        """Write the bits of the fresh numbers; from them and those waiting, tell what is missing and what is repeated.

        All numbers below ``reached`` count as passed. Every word of 64 numbers names its successor too, so that the
        first word that no row has is among the words."""
        fresh = self._words_of(self._read(spark, [f"{arrived}/{_KIND}=open"], schema))
        words = fresh.select("word", "bits", "n", F.col("bits").alias("new"), F.col("n").alias("new_n"))
        base, top = (before.expected - 1) >> 6, reached >> 6
        if before.segments:
            old = spark.read.schema(_BITS).parquet(*[s.bits for s in before.segments]).filter(F.col("word") >= base)
            words = words.unionByName(old, allowMissingColumns=True)
        empty = [F.lit(0).cast("bigint").alias(c) for c in ("bits", "n")]
        nothing = [F.lit(None).cast("bigint").alias(c) for c in ("new", "new_n")]
        pairs = F.array(
            F.struct("word", "bits", "n", "new", "new_n"), F.struct((F.col("word") + 1).alias("word"), *empty, *nothing)
        )
        start = spark.range(1).select(F.lit(top).cast("bigint").alias("word"), *empty, *nothing)
        grouped = (
            words.select(F.inline(pairs)).unionByName(start).groupBy("word")
            .agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"), F.bit_or("new").alias("new"), F.sum("new_n").alias("new_n"))
        )
        word, present = F.col("word"), F.col("bits")
        passed = present.bitwiseOR(F.when(word == top, F.lit(_signed((1 << (reached & 63)) - 1))).otherwise(F.lit(0)))
        is_open = (word >= top) & (passed != -1)
        ahead = _from(present, word, before.expected)
        seen = Observation()
        observed = grouped.observe(
            seen,
            F.min(F.when(is_open, F.struct(word.alias("word"), passed.alias("bits")))).alias("first"),
            F.count_if(F.col("n") > F.bit_count("bits")).alias("conflicts"),
            F.sum(F.bit_count(ahead)).alias("total"),
            F.sum(F.bit_count(_from(present, word, reached + 1))).alias("above"),
        )
        fresh_words = observed.filter("new is not null").select("word", F.col("new").alias("bits"), F.col("new_n").alias("n"))
        fresh_words.write.mode("overwrite").parquet(bits)
        found = seen.get
        first, has = found["first"]["word"], found["first"]["bits"] & _FULL
        place = ((has ^ _FULL) & -(has ^ _FULL)).bit_length() - 1
        return {
            "expected": first * 64 + place + 1,
            "conflicts": found["conflicts"],
            "total": found["total"],
            "below": found["total"] - found["above"],
        }

    def _words_of(self, rows: DataFrame) -> DataFrame:
        """Each row's number as a bit of its word; rows of a word are put together by whoever groups them."""
        place = F.col(self.seq_col).cast("bigint") - 1
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
        return rows.select(F.shiftright(place, 6).alias("word"), bit.alias("bits"), F.lit(1).cast("bigint").alias("n"))

    def _without_repeats(
        self, spark: SparkSession, path: str, bits: str, before: _Notes, schema: T.StructType, batch_id: int
    ) -> str:
        """Write the fresh rows anew, one per number, without those whose number waits already; and the others apart.

        Of each number the first row is kept, found with a map-side minimum, and all joins are on unique keys, so a
        number that very many rows have takes no task more than others."""
        rows = self._read(spark, [path], schema)
        chosen = rows.groupBy(F.col(self.seq_col).cast("bigint").alias("seq")).agg(F.min(_ROW).alias(_ROW))
        if before.segments:
            waiting = self._read(spark, [s.rows for s in before.segments], schema)
            numbers = waiting.select(F.col(self.seq_col).cast("bigint").alias("seq")).filter(F.col("seq") >= before.expected)
            chosen = chosen.join(numbers, "seq", "left_anti")
        kept = self._folder("kept", batch_id, self.state)
        rows.join(chosen.select(_ROW), _ROW, "left_semi").sortWithinPartitions(self.seq_col).write.mode("overwrite").parquet(kept)
        clean = self._read(spark, [kept], schema)
        repeated = rows.join(clean.select(_ROW), _ROW, "left_anti").drop(_ROW)
        repeated.write.mode("overwrite").parquet(self._folder("repeated", batch_id))
        self._write_bits(clean, bits)
        return kept

    def _write_bits(self, rows: DataFrame, path: str) -> None:
        words = self._words_of(rows).groupBy("word").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
        words.write.mode("overwrite").parquet(path)

    def _release(
        self, spark: SparkSession, schema: T.StructType, segments: list[Segment], before: _Notes, expected: int,
        rows: int, batch_id: int,
    ) -> tuple[int, Tail | None]:
        """Write the rows that are due, in order; how many were accepted, and where the last values are now."""
        path = self._folder("rows", batch_id)
        if not rows:
            if batch_id == 0:
                self._emit(small_frame(spark, [], schema), before, None).write.mode("overwrite").parquet(path)
            elif exists(spark, path):
                free(spark, [path])
            return 0, before.tail
        due = self._between(spark, segments, before.expected, expected, schema)
        span = expected - before.expected
        emitted = self._emit(due, before, KeySpread(before.expected, span, rows))
        released = write_in_order(emitted, self.seq_col, span, path, grouped=self.value_col is not None)
        if self.value_col is None:
            return released, None
        kept = self._folder("tail", batch_id, self.state)
        last = keep_last_values(
            spark.read.parquet(path), released, before.tail, self.seq_col, self.value_col, self.window, kept
        )
        return released, last

    def _merge(
        self, spark: SparkSession, segments: list[Segment], expected: int, schema: T.StructType, batch_id: int
    ) -> list[Segment]:
        """Segments of one level, once there are enough of them, as one of the next with their waiting rows only."""
        levels: dict[int, list[Segment]] = {}
        for segment in segments:
            levels.setdefault(segment.level, []).append(segment)
        for level, some in sorted(levels.items()):
            if len(some) < MERGED_AT_ONCE:
                continue
            rows, bits = (self._folder(f"{part}-{level + 1}", batch_id, self.state) for part in ("merged", "bits"))
            waiting = self._between(spark, some, expected, None, schema, keep_row=True)
            waiting.sortWithinPartitions(self.seq_col).write.mode("overwrite").parquet(rows)
            self._write_bits(self._read(spark, [rows], schema), bits)
            marks, top = [], expected - 1
            for since, high in sorted(mark for s in some for mark in s.marks):
                # a mark below an earlier one tells nothing more
                if high > top:
                    marks.append((since, high))
                    top = high
            merged = Segment(rows, bits, expected, max(s.high for s in some), level + 1, tuple(marks))
            return [s for s in segments if s not in some] + [merged]
        return segments

    def _between(
        self, spark: SparkSession, segments: list[Segment], low: int, end: int | None, schema: T.StructType, keep_row=False
    ) -> DataFrame:
        """Rows of the segments with numbers from ``low`` to before ``end``; segments without any are not opened."""
        some = [s.rows for s in segments if s.high >= low and (end is None or s.low < end)]
        seq = F.col(self.seq_col)
        rows = self._read(spark, some, schema).filter(seq >= low if end is None else (seq >= low) & (seq < end))
        return rows if keep_row else rows.drop(_ROW)

    def _read(self, spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
        known = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + [_ROW_FIELD])
        there = [p for p in paths if exists(spark, p)]
        return spark.read.schema(known).parquet(*there) if there else small_frame(spark, [], known)

    def _is_overdue(self, since: float, now: float) -> bool:
        return self.gap_timeout is not None and since < now - self.gap_timeout

    def _emit(self, due: DataFrame, before: _Notes, spread: KeySpread | None) -> DataFrame:
        """The accepted rows, with their means if there are values."""
        rows = due.filter(F.col(self.accepted_col)) if self.accepted_col else due
        if self.value_col is None:
            return rows
        return carried_average(rows, before.tail, self.seq_col, self.value_col, self.window, spread)

    # ---- state ------------------------------------------------------------------------------

    def _folder(self, part: str, batch_id: int, top: str | None = None) -> str:
        return f"{top or self.out}/{part}/batch={batch_id}"

    def _notes_path(self, batch_id: int) -> str:
        return f"{self.state}/notes/batch={batch_id}.json"

    def _notes(self, spark: SparkSession, batch_id: int) -> _Notes:
        text = get_text(spark, self._notes_path(batch_id))
        if text is None:
            raise RuntimeError(f"state of batch {batch_id} is not in {self.state}")
        return _Notes.of(text)

    # ---- after the stream -------------------------------------------------------------------

    def drain(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows still waiting after the last batch, ``batch_id``, in order across all gaps, averages carried on."""
        before = self._notes(spark, batch_id)
        # what was given out has the columns too, if nothing waits
        known = spark.read.option("recursiveFileLookup", True).parquet(f"{self.out}/rows").limit(0)
        stored = [spark.read.parquet(s.rows) for s in before.segments] or [known.drop(AVERAGE) if self.value_col else known]
        waiting = reduce(DataFrame.unionByName, stored).drop(_ROW, _KIND).filter(F.col(self.seq_col) >= before.expected)
        return self._emit(waiting, before, None)


def _signed(bits: int) -> int:
    """64 bits as a signed number."""
    return bits - (1 << 64) if bits >> 63 else bits


def _from(bits: Column, word: Column, number: int) -> Column:
    """The bits of a word that stand for ``number`` and those above."""
    at, mask = (number - 1) >> 6, _signed(_FULL ^ ((1 << ((number - 1) & 63)) - 1))
    return F.when(word < at, F.lit(0)).when(word == at, bits.bitwiseAND(F.lit(mask))).otherwise(bits)


def start_release(
    sdf: DataFrame, release: Release, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start releasing ``sdf``: all that is available now, or a batch ``every`` so often."""
    writer = sdf.writeStream.foreachBatch(release.run_batch).option("checkpointLocation", checkpoint)
    pace = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**pace).start()


def stream_resequence(
    sdf: DataFrame, out: str, state: str, checkpoint: str, seq_col: str, every: str | None = None, **kw
) -> tuple[StreamingQuery, Release]:
    """Release rows in sequence order. Keywords are those of ``Release``."""
    release = Release(out, state, seq_col, **kw)
    return start_release(sdf, release, checkpoint, every), release


def stream_rolling_average(
    sdf: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    seq_col: str,
    value_col: str,
    window: int,
    every: str | None = None,
    **kw,
) -> tuple[StreamingQuery, Release]:
    """Release rows in sequence order with the rolling mean of the accepted ones."""
    release = Release(out, state, seq_col, value_col, window, **kw)
    return start_release(sdf, release, checkpoint, every), release


def drain(spark: SparkSession, release: Release, batch_id: int) -> DataFrame:
    """What an ended stream still holds back (see ``Release.drain``)."""
    return release.drain(spark, batch_id)


def released_rows(spark: SparkSession, release: Release, part: str = "rows") -> DataFrame:
    """All rows released so far; other parts are ``late`` (came after their turn), ``repeated`` (their number had
    come before) and ``no_sequence`` (no number). These have the columns of the input."""
    if part not in PARTS:
        raise ValueError(f"part must be one of {PARTS}")
    # folders are not columns: the input may have a column called batch
    reader = spark.read.option("recursiveFileLookup", True)
    if part == "rows" or (part == "repeated" and exists(spark, f"{release.out}/repeated")):
        return reader.parquet(f"{release.out}/{part}")
    arrived = f"{release.out}/arrived"
    if part != "repeated" and exists(spark, f"{arrived}/batch=*/{_KIND}={part}"):
        return reader.parquet(f"{arrived}/batch=*/{_KIND}={part}").drop(_ROW)
    rows = reader.parquet(f"{release.out}/rows").limit(0)
    return rows.drop(AVERAGE) if release.value_col is not None else rows


def with_ticks(sdf: DataFrame, per_second: int = 1) -> DataFrame:
    """Add empty rows at a steady pace, so that gaps are passed while the input is idle.

    They are marked in the column ``TICK``, which a release takes away again.
    """
    ticks = sdf.sparkSession.readStream.format("rate").option("rowsPerSecond", per_second).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in sdf.schema.fields]
    marked = sdf.withColumn(TICK, F.lit(False))
    return marked.unionByName(ticks.select(*empty, F.lit(True).alias(TICK)))
