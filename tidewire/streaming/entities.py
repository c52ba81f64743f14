"""One sequence per entity: order, gaps and rolling means from keyed state, and what is left in it.

Where every entity numbers its own rows, sequences do not depend on each other, and keyed state spreads them over the
cluster. Per entity there is the next number expected (a value), the rows that wait for one (a map of pieces, some thousands
of numbers to a chunk), which numbers have come (a map of bits by chunk) and the last ``window - 1`` accepted values (a
list); a timer passes gaps while nothing comes. All rows of an entity go through one task: for a single sequence, or one that holds much of all rows, take ``streaming.release``.

State is kept by RocksDB (``STATE_STORE``), on which Spark's keyed state with maps and timers rests. It can be read
while the stream stands still: ``left_in_state`` gives the rows that never had their turn, with the means that they
would have had.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewire.operators.rolling import rolling_average
from tidewire.spec import AVERAGE, whole_number
from tidewire.workspace import materialise, ship

#: The setting that a session needs for it, and its value.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
#: What became of a row: in order, come after its turn, number come before, no number.
KIND = "kind"
KINDS = ("row", "late", "repeated", "no_sequence")
#: Numbers whose rows lie together in the state (a multiple of eight), rows held before they go there, and chunks whose
#: bits are held meanwhile.
CHUNK = 1 << 12
AT_ONCE = 1 << 17
KNOWN = 1 << 13


class _Chunk:
    """What is known of ``CHUNK`` numbers: which have come, as bits, in how many pieces their rows lie in the state, and
    pairs of arrival time and highest number, from which overdue gaps are told."""

    def __init__(self, kept: Row | None):
        self.stored = kept is not None
        self.changed = False
        self.seen = bytearray(kept[0]) if kept else bytearray(CHUNK // 8)
        self.pieces = kept[1] if kept else 0
        self.marks = [tuple(mark) for mark in kept[2]] if kept else []

    def mark(self, since: int, high: int) -> None:
        # times go up, so a mark that is not above the last tells nothing more
        if self.marks and self.marks[-1][0] == since:
            self.marks[-1] = (since, max(high, self.marks[-1][1]))
        elif not self.marks or high > self.marks[-1][1]:
            self.marks.append((since, high))


class _Waiting:
    """One entity's rows that wait, while one batch of it is worked on.

    Rows come to the state in pieces of a chunk, some thousands of rows with one call each way: a call costs far more than a
    row. A chunk's bits tell what has come without a look at its rows."""

    def __init__(self, chunks, pieces):
        self._chunks, self._pieces = chunks, pieces
        self._known: dict[int, _Chunk] = {}
        self._fresh: dict[int, list[tuple]] = {}
        self.fresh = 0

    def chunk(self, number: int) -> _Chunk:
        known = self._known.get(number)
        if known is None:
            known = self._known[number] = _Chunk(self._chunks.getValue((number,)))
        return known

    def has(self, seq: int) -> bool:
        number, place = divmod(seq - 1, CHUNK)
        return bool(self.chunk(number).seen[place >> 3] >> (place & 7) & 1)

    def add(self, seq: int, since: int, row: tuple) -> None:
        number, place = divmod(seq - 1, CHUNK)
        self.chunk(number).seen[place >> 3] |= 1 << (place & 7)
        self._fresh.setdefault(number, []).append((seq, since, row))
        self.fresh += 1

    def numbers(self) -> list[int]:
        """All chunks that have rows, in order."""
        return sorted({number for (number,) in self._chunks.keys()} | set(self._fresh))

    def overdue(self, until: int) -> int:
        """The highest number that came no later than ``until``; 0 if there is none."""
        return max((high for _, kept in self._chunks.iterator() for since, high in kept[2] if since <= until), default=0)

    def take(self, number: int, end: int) -> list[tuple]:
        """The chunk's rows with numbers below ``end``, in order; the rest goes on waiting."""
        known = self.chunk(number)
        rows = self._fresh.pop(number, [])
        self.fresh -= len(rows)
        for piece in range(known.pieces):
            rows += [(seq, since, row) for seq, since, row in self._pieces.getValue((number, piece))[0]]
            self._pieces.removeKey((number, piece))
        known.changed, known.pieces = True, 0
        rows.sort(key=lambda kept: kept[0])
        due = [row for row in rows if row[0] < end]
        if len(due) < len(rows):
            known.marks = []
            rest = rows[len(due) :]
            for seq, since, _ in sorted(rest, key=lambda kept: kept[1]):
                known.mark(since, seq)
            self._put(number, known, rest)
        elif end > (number + 1) * CHUNK:
            # all of its numbers have had their turn
            if known.stored:
                self._chunks.removeKey((number,))
            del self._known[number]
        else:
            known.marks = []
        return due

    def store(self) -> None:
        """Write the rows that are new, and what is known of their chunks once that is much."""
        for number, rows in self._fresh.items():
            known = self.chunk(number)
            for seq, since, _ in rows:
                known.mark(since, seq)
            self._put(number, known, rows)
        self._fresh, self.fresh = {}, 0
        if len(self._known) > KNOWN:
            self.close()

    def close(self) -> None:
        for number, known in self._known.items():
            if known.changed:
                self._chunks.updateValue((number,), (bytes(known.seen), known.pieces, known.marks))
        self._known = {}

    def _put(self, number: int, known: _Chunk, rows: list[tuple]) -> None:
        plain = [(seq, since, tuple(row)) for seq, since, row in rows]
        self._pieces.updateValue((number, known.pieces), (plain,))
        known.pieces += 1
        known.changed = True


class _Sequence(StatefulProcessor):
    """One entity's rows in order."""

    def __init__(self, schema: T.StructType, seq: str, value: str, accepted: str | None, window: int, timeout: float | None):
        self._names = schema.names
        self._seq, self._value, self._accepted = (schema.names.index(c) if c else None for c in (seq, value, accepted))
        self._window = window
        self._patience = None if timeout is None else int(timeout * 1000)
        kept = T.StructType().add("seq", T.LongType()).add("since", T.LongType()).add("row", schema)
        self._kept = T.StructType().add("rows", T.ArrayType(kept))
        self._out = Row(*schema.names, AVERAGE, KIND)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._next = handle.getValueState("next", "expected bigint, waiting bigint")
        known = "seen binary, pieces int, marks array<struct<since: bigint, high: bigint>>"
        self._chunks = handle.getMapState("chunks", "chunk bigint", known)
        self._pieces = handle.getMapState("waiting", "chunk bigint, piece int", self._kept)
        self._tail = handle.getListState("tail", "value double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        given, waiting = self._next.get() or (1, 0)
        values, backlog, expected = self._values(), _Waiting(self._chunks, self._pieces), given
        pick = None
        for row in rows:
            pick = pick or itemgetter(*map(row.__fields__.index, self._names))
            row = pick(tuple(row))
            seq = row[self._seq]
            if seq is None:
                yield self._out(*row, None, "no_sequence")
            elif seq < expected:
                yield self._out(*row, None, "late")
            elif backlog.has(seq):
                yield self._out(*row, None, "repeated")
            else:
                backlog.add(seq, now, row)
                waiting += 1
                while waiting and backlog.has(expected):
                    expected += 1
                if backlog.fresh >= AT_ONCE:
                    waiting -= yield from self._released(backlog, given, expected, values)
                    given = expected
                    backlog.store()
        waiting -= yield from self._released(backlog, given, expected, values)
        self._keep(backlog, expected, waiting, values, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Pass the gaps below rows that have waited for too long."""
        now = timerValues.getCurrentProcessingTimeInMs()
        given, waiting = self._next.get() or (1, 0)
        values, backlog = self._values(), _Waiting(self._chunks, self._pieces)
        expected = max(given, backlog.overdue(now - self._patience) + 1)
        while backlog.has(expected):
            expected += 1
        waiting -= yield from self._released(backlog, given, expected, values, backlog.numbers())
        self._keep(backlog, expected, waiting, values, now)

    def _values(self) -> deque:
        values: deque = deque(maxlen=self._window)
        if self._window > 1 and self._tail.exists():
            values.extend(v for (v,) in self._tail.get())
        return values

    def _keep(self, backlog: _Waiting, expected: int, waiting: int, values: deque, now: int) -> None:
        backlog.store()
        backlog.close()
        self._next.update((expected, waiting))
        if self._window > 1 and values:
            self._tail.put([(v,) for v in list(values)[1 - self._window :]])
        if self._patience is not None and waiting and not any(True for _ in self._handle.listTimers()):
            self._handle.registerTimer(now + self._patience)

    def _released(self, backlog: _Waiting, given: int, expected: int, values: deque, numbers=None) -> Iterator[Row]:
        """Rows with numbers from ``given`` to before ``expected``, a chunk at a time; returns how many they were."""
        count, last = 0, (expected - 2) // CHUNK
        if given == expected:
            return count
        # without gaps, every chunk in between has rows
        for number in range((given - 1) // CHUNK, last + 1) if numbers is None else numbers:
            if number > last:
                break
            for _, _, row in backlog.take(number, expected):
                count += 1
                if self._accepted is not None and not row[self._accepted]:
                    continue
                values.append(row[self._value])
                known = [v for v in values if v is not None]
                yield self._out(*row, round(math.fsum(known) / len(known), 4) if known else 0.0, "row")
        return count


def by_entity(
    sdf: DataFrame,
    entity_col: str,
    seq_col: str,
    value_col: str,
    window: int,
    accepted_col: str | None = None,
    gap_timeout: float | None = None,
) -> DataFrame:
    """The stream's rows in the order of each entity's numbers, with the rolling mean of the accepted ones and ``kind``.

    Numbers begin at 1. Rows that come late, repeat a number or have none come out at once, with no mean. A gap is
    passed once a later row has waited for ``gap_timeout`` seconds, whether or not rows come in meanwhile.
    """
    whole_number("window", window)
    if gap_timeout is not None and gap_timeout < 0:
        raise ValueError("gap_timeout must not be negative")
    name, store = STATE_STORE
    if sdf.sparkSession.conf.get(name, None) != store:
        raise ValueError(f"state by entity needs {name} = {store}")
    ship(sdf.sparkSession)
    typed = sdf.withColumns({seq_col: F.col(seq_col).cast("bigint"), value_col: F.col(value_col).cast("double")})
    added = [T.StructField(AVERAGE, T.DoubleType()), T.StructField(KIND, T.StringType())]
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in typed.schema.fields])
    processor = _Sequence(plain, seq_col, value_col, accepted_col, window, gap_timeout)
    return typed.groupBy(entity_col).transformWithState(
        statefulProcessor=processor,
        outputStructType=T.StructType([*plain.fields, *added]),
        outputMode="append",
        timeMode="processingTime" if gap_timeout is not None else "none",
    )


def stream_by_entity(
    sdf: DataFrame, out: str, checkpoint: str, entity_col: str, seq_col: str, value_col: str, window: int,
    every: str | None = None, **kw,
) -> StreamingQuery:
    """Write ``by_entity`` as Parquet, one folder per kind: all that is available now, or a batch ``every`` so often."""
    ordered = by_entity(sdf, entity_col, seq_col, value_col, window, **kw)
    writer = ordered.writeStream.format("parquet").partitionBy(KIND).option("checkpointLocation", checkpoint)
    pace = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**pace).start(out)


def left_in_state(
    spark: SparkSession, checkpoint: str, entity_col: str, seq_col: str, value_col: str, window: int,
    accepted_col: str | None = None,
) -> DataFrame:
    """Rows that still wait in the state of a stream that stands still, across all gaps, with their means carried on.

    The state is read as a table, an entity's rows and its last values side by side; no stream is started.
    """
    whole_number("window", window)

    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    rows = state("waiting").select(F.explode("user_map_value.rows").alias("kept")).select("kept.row.*")
    names = rows.columns
    taken = rows.filter(F.col(accepted_col)) if accepted_col else rows
    old = state("tail").select(F.col("key")[entity_col].alias(entity_col), F.col("list_element.value").alias(value_col))
    # the last values come first, in their order; they have numbers below all others
    place = F.monotonically_increasing_id() - F.lit(1 << 62)
    both = taken.withColumn("__old", F.lit(False)).unionByName(
        old.withColumns({seq_col: place, "__old": F.lit(True)}), allowMissingColumns=True
    )
    # stored as they are: the state is read once
    averaged = rolling_average(materialise(both, "left-in-state"), seq_col, value_col, window, partition_by=[entity_col])
    return averaged.filter(~F.col("__old")).select(*names, AVERAGE)
