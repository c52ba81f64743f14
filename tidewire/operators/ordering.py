"""Dense numbering, sequence order, gaps and late rows, without a one-partition window over rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.workspace import materialise, ship

# Rows of one bucket go to one task. Sequence numbers are unique, so a bucket of this width is also
# bounded in rows.
BUCKET_WIDTH = 1 << 18
# A sequence known to be this short is one task's work, and is not looked at before.
ONE_STRETCH = BUCKET_WIDTH
# Splits of one scan that may be broadcast: about 150 bytes each, so at most 150 MB.
BROADCAST_SPLITS = 1_000_000

SOURCE_ORDER = ("__file", "__block", "__line")
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row in partition below


def add_sequence(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str = "priority_index",
    start: int = 1,
    unique: bool = False,
    keep_order: bool = False,
) -> DataFrame:
    """Put a dense number ``start..`` in ``order_by`` order in front of each row, and store that.

    ``order_by=SOURCE_ORDER`` numbers a scanned file set in its own order and needs no shuffle; the
    order columns are dropped unless ``keep_order``.
    One integer key declared ``unique`` is cut into stretches, which are counted and then sorted:
    one shuffle. Any other order is sorted across the cluster, which reads ``df`` once more to
    sample it. There, unless the order is ``unique``, ties are split by a hash of the row and by
    input partition, so that one value held by very many rows does not end up in one task.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if name in df.columns:
        raise ValueError(f"column {name!r} exists already")
    if tuple(order) == SOURCE_ORDER:
        numbered = _number_by_split(df, name, start)
        return numbered if keep_order else numbered.drop(*SOURCE_ORDER)
    if unique and len(order) == 1 and df.schema[order[0]].dataType in (T.LongType(), T.IntegerType()):
        numbered = _number_by_stretch(df, order[0], name, start)
        if numbered is not None:
            return numbered
    return _number_by_sort(df, order, name, start, unique)


def _number_by_stretch(df: DataFrame, key: str, name: str, start: int) -> DataFrame | None:
    """Numbers from the row counts of stretches of the key; ``None`` if the keys lie too sparsely."""
    spread = key_spread(df, key)
    if spread is None or not spread.fills(BUCKET_WIDTH):
        return None
    cut = Buckets(df, key, spread.low, _fit(df, spread.span, 0, BUCKET_WIDTH), 0, 0)
    # read before the other columns are: only the key is scanned for it
    counts = df.groupBy(cut.bucket().alias("__bucket")).agg(F.count("*").alias("__rows"))
    before = counts.select("__bucket", _sum_before("__rows", "__bucket").alias("__before"))
    local = F.row_number().over(Window.partitionBy("__bucket").orderBy(key))
    numbered = df.withColumn("__bucket", cut.bucket()).join(before, "__bucket")
    number = (F.col("__before") + local + F.lit(start - 1)).alias(name)
    return materialise(numbered.select(number, *df.columns), "numbered")


def _number_by_sort(
    df: DataFrame, order: list[str], name: str, start: int, unique: bool
) -> DataFrame:
    ties = [] if unique else [F.xxhash64(*df.columns), F.spark_partition_id()]
    helpers = [f"__tie{i}" for i in range(len(ties))]
    stored = materialise(
        df.withColumns(dict(zip(helpers, ties)))
        .orderBy(*order, *helpers)
        .drop(*helpers)
        .withColumn("__place", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("__place", _LOCAL_BITS)
    local = _in_partition("__place")
    counts = stored.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    # as many rows as the sort had partitions, whatever the data
    offsets = counts.select("__part", _sum_before("__rows", "__part").alias("__before"))
    return (
        stored.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .select((F.col("__before") + local + F.lit(start)).alias(name), *df.columns)
    )


def _in_partition(row_id: str) -> Column:
    """The place of a row in its partition, from its ``monotonically_increasing_id``."""
    return F.col(row_id).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))


def _sum_before(rows: str, *order: str):
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(rows).over(before), F.lit(0))


def _number_by_split(df: DataFrame, name: str, start: int) -> DataFrame:
    """Rows of one file split are read in order by one task: only whole splits must be counted."""
    file, block, line = SOURCE_ORDER
    # a fresh row id after all filters of df, so that kept rows of a split are consecutive
    stored = materialise(
        df.withColumn("__place", F.monotonically_increasing_id()), "source-order"
    )
    splits = stored.groupBy(file, block).agg(
        F.min("__place").alias("__first"),
        F.max("__place").alias("__final"),
        F.count("*").alias("__rows"),
    )
    whole = F.col("__final") - F.col("__first") + 1 == F.col("__rows")
    count, broken = splits.agg(F.count("*"), F.count_if(~whole)).first()
    if broken:  # the rows were shuffled since the scan: their own order columns still hold
        return _number_by_sort(stored.drop("__place"), list(SOURCE_ORDER), name, start, True)
    offsets = splits.select(
        file, block, "__first", _sum_before("__rows", file, block).alias("__before")
    )
    if count <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    number = F.col("__before") + F.col("__place") - F.col("__first") + F.lit(start)
    return stored.join(offsets, [file, block]).select(number.alias(name), *df.columns)


def number_kept(df: DataFrame, keep: Column, rest: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Rows of a scan where ``keep`` holds, numbered in source order among *all* rows of the scan.

    ``rest`` is the stored table of the scan's other rows, with its ``SOURCE_ORDER`` columns. Each
    row is in one of the two, so the line numbers of both tell how many rows each split has. They
    come from two reads of the same files; if those were split in different ways, the line numbers of
    a split do not run from first to last, and all rows are numbered instead.
    """
    file, block, line = SOURCE_ORDER
    kept = materialise(df.filter(keep), "kept")
    splits = materialise(
        kept.select(*SOURCE_ORDER)
        .unionByName(rest.select(*SOURCE_ORDER))
        .groupBy(file, block)
        .agg(
            F.min(line).alias("__first"),
            F.max(line).alias("__final"),
            F.count("*").alias("__rows"),
            F.try_sum(_in_partition(line)).alias("__sum"),
        ),
        "splits",
    )
    # as many numbers as from first to last, adding up to as much
    ends = _in_partition("__first") + _in_partition("__final")
    adds_up = F.col("__sum").cast("decimal(38,0)") * 2 == ends.cast("decimal(38,0)") * F.col("__rows")
    whole = (F.col("__final") - F.col("__first") + 1 == F.col("__rows")) & F.coalesce(adds_up, F.lit(True))
    count, broken = splits.agg(F.count("*"), F.count_if(~whole)).first()
    if broken:
        return add_sequence(df, SOURCE_ORDER, name, start).filter(keep)
    offsets = splits.select(
        file, block, "__first", _sum_before("__rows", file, block).alias("__before")
    )
    if count <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    number = F.col("__before") + F.col(line) - F.col("__first") + F.lit(start)
    others = [c for c in df.columns if c not in SOURCE_ORDER]
    return kept.join(offsets, [file, block]).select(number.alias(name), *others)


def resequence(df: DataFrame, seq_col: str) -> DataFrame:
    """Rows in sequence order, by one range-partitioned, spilling sort."""
    return df.orderBy(seq_col)


@dataclass(frozen=True)
class Buckets:
    """Rows cut into stretches of ``width`` consecutive keys, none of which holds too many rows.

    The last ``zone`` keys of a stretch surely hold as many rows as the caller asked for.
    """

    rows: DataFrame
    key: str
    low: int
    width: int
    zone: int
    last: int

    def bucket(self):
        return F.expr(f"cast((`{self.key}` - {self.low}L) div {self.width}L as bigint)")

    def in_zone(self):
        into = F.expr(f"cast((`{self.key}` - {self.low}L) % {self.width}L as bigint)")
        return (into >= self.width - self.zone) & (self.bucket() < self.last)


def cut_in_buckets(
    df: DataFrame, seq_col: str, carry: int = 0, width: int = BUCKET_WIDTH, spread: KeySpread | None = None
) -> Buckets | None:
    """Cut ``df`` along an integer sequence column; ``None`` for no rows at all.

    A sequence that is dense up to ordinary gaps is cut as it is, which costs no shuffle. If gaps
    are so long that the end of a stretch may hold fewer than ``carry`` rows, or numbers so sparse
    that the buckets outnumber what the rows need, the rows are first numbered densely. ``spread`` is looked up
    unless it is given.
    """
    if spread and spread.span <= ONE_STRETCH:
        return Buckets(df, seq_col, spread.low, spread.span, 0, 0)
    spread = spread or key_spread(df, seq_col)
    if spread is None:
        return None
    width = _fit(df, spread.span, carry, width)
    zone = min(width, max(8 * carry + 64, width // 16)) if carry else 0
    cut = Buckets(df, seq_col, spread.low, width, zone, (spread.span - 1) // width)
    if cut.last == 0 or (spread.fills(width) and (not carry or _zones_hold(cut, carry))):
        return cut
    dense = add_sequence(df, seq_col, "__dense", start=0, unique=True)
    width = _fit(df, spread.rows, carry, width)
    return Buckets(dense, "__dense", 0, width, carry, (spread.rows - 1) // width)


@dataclass(frozen=True)
class KeySpread:
    """How many rows there are and how far their integer keys reach."""

    low: int
    span: int
    rows: int

    def fills(self, width: int) -> bool:
        """Whether stretches of ``width`` keys are not many more than the rows need."""
        return self.span // width + 1 <= 16 * (self.rows // width + 1)


def key_spread(df: DataFrame, key: str) -> KeySpread | None:
    """The spread of a key column, from one pass over it alone; ``None`` for no rows."""
    low, high, rows, keyed = df.agg(F.min(key), F.max(key), F.count("*"), F.count(key)).first()
    if keyed < rows:
        raise ValueError(f"{key!r} is NULL in {rows - keyed} rows, which thus have no place in order")
    if rows and rows > high - low + 1:
        # numbers held by very many rows would also end up in one task
        raise ValueError(f"{key!r} has {rows} rows on {high - low + 1} numbers, so some are repeated")
    return KeySpread(low, high - low + 1, rows) if rows else None


def _fit(df: DataFrame, span: int, carry: int, width: int) -> int:
    """Narrower buckets for small inputs, so that all cores work; wider ones for long carries."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(min(width, max(span // (4 * cores) + 1, 4096)), 16 * carry, 1)


def _zones_hold(cut: Buckets, carry: int) -> bool:
    """Whether every stretch but the last carries enough rows over to the next one."""
    held = (
        cut.rows.filter(cut.in_zone()).groupBy(cut.bucket().alias("b")).agg(F.count("*").alias("n"))
    )
    fewest, zones = held.agg(F.min("n"), F.count("*")).first()
    return zones == cut.last and fewest >= carry


def gap_ranges(df: DataFrame, seq_col: str, upto: int | None = None) -> DataFrame:
    """Numbers of ``1..upto`` (default: the highest present) that no row has, as ranges ``first``, ``last``.

    Work and result grow with the rows and the gaps, not with the numbers: 64 numbers become one word of bits before
    the shuffle, words are sorted across the cluster, each task looks between neighbours, and only the ends of the
    tasks' parts come together.
    """
    place = F.col(seq_col).cast("bigint") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    inside = df.filter(F.col(seq_col) >= 1 if upto is None else F.col(seq_col).between(1, upto))
    words = inside.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    ship(df.sparkSession)
    found = materialise(words.orderBy("word").mapInArrow(_between_runs, _GAPS), "gaps")
    within = found.filter("part is null").select("first", "last")
    # of each part its lowest and highest number
    parts = found.filter("part is not null")
    before = F.lag("last").over(Window.orderBy("part"))
    between = parts.select((F.coalesce(before, F.lit(0)) + 1).alias("first"), (F.col("first") - 1).alias("last"))
    ranges = within.unionByName(between)
    if upto is not None:
        after = parts.agg((F.coalesce(F.max("last"), F.lit(0)) + 1).alias("first")).withColumn("last", F.lit(upto).cast("bigint"))
        ranges = ranges.unionByName(after)
    return ranges.filter("first <= last")


def find_gaps(df: DataFrame, seq_col: str, upto: int | None = None) -> DataFrame:
    """Numbers of ``1..upto`` (default: the highest present) that no row has, one row each."""
    stretch = F.lit(1 << 16)
    pieces = gap_ranges(df, seq_col, upto).select(
        F.explode(F.sequence("first", "last", stretch.cast("bigint"))).alias("from"), "last"
    )
    upto_last = F.least(F.col("from") + stretch - 1, F.col("last"))
    return pieces.select(F.explode(F.sequence("from", upto_last)).alias("missing"))


def first_missing(df: DataFrame, seq_col: str, after: int, rows: int) -> int:
    """The least number above ``after`` that none of the ``rows`` rows of ``df`` has.

    As many rows cannot fill one number more than they are, so no later number matters.
    """
    later = df.filter(F.col(seq_col) > after).select((F.col(seq_col) - F.lit(after)).alias("seq"))
    return after + gap_ranges(later, "seq", rows + 1).agg(F.min("first")).first()[0]


_GAPS = "part bigint, first bigint, last bigint"


def _between_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words of bits as the ranges between runs of set bits; then the ends of all, with the part's number."""
    low = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        starts, ends = _runs(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        if low is None:
            low, first, after = int(starts[0]), starts[1:], ends[:-1]
        else:
            first, after = starts, np.concatenate([[last], ends[:-1]])
        last = int(ends[-1])
        gap = first - after > 1
        yield _ranges(np.full(gap.sum(), -1), after[gap] + 1, first[gap] - 1)
    if low is not None:
        yield _ranges(np.array([TaskContext.get().partitionId()]), np.array([low]), np.array([last]))


def _ranges(part: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(c.astype(np.int64), mask=(c < 0) if c is part else None) for c in (part, first, last)]
    return pa.RecordBatch.from_arrays(columns, names=["part", "first", "last"])


def _runs(words: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last number of each run of set bits within its word, in order."""
    full = bits == -1
    some = np.flatnonzero(~full)
    places = np.unpackbits(bits[some].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    edges = np.diff(np.pad(places, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edges == 1)
    _, stop = np.nonzero(edges == -1)
    base = words * 64 + 1
    starts = np.concatenate([base[full], base[some][row] + start])
    ends = np.concatenate([base[full] + 63, base[some][row] + stop - 1])
    order = np.argsort(starts)
    return starts[order], ends[order]


def reject_stale(
    df: DataFrame, seq_col: str, arrival_col: str, cutoff: float = 2.0
) -> tuple[DataFrame, DataFrame]:
    """Split rows into (kept, late) by their arrival time in seconds.

    A row is late if a higher number arrived more than ``cutoff`` before it.
    """
    flagged = flag_stale(df, seq_col, arrival_col, cutoff)
    late = F.col("__late")
    return flagged.filter(~late).drop("__late"), flagged.filter(late).drop("__late")


def flag_stale(
    df: DataFrame, seq_col: str, arrival_col: str, cutoff: float = 2.0, name: str = "__late"
) -> DataFrame:
    """Add the boolean ``name``: whether the row is late (see ``reject_stale``).

    The earliest later arrival is the lesser of two: that within the row's own bucket, and that of
    all later buckets, which is worked out on one row per bucket.
    """
    if cutoff < 0:
        raise ValueError("cutoff must not be negative")
    cut = cut_in_buckets(df, seq_col)
    if cut is None:
        return df.withColumn(name, F.lit(False))
    rows = cut.rows.withColumn("__bucket", cut.bucket())
    later_buckets = Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        rows.groupBy("__bucket")
        .agg(F.min(arrival_col).alias("__first"))
        .select("__bucket", F.min("__first").over(later_buckets).alias("__after"))
    )
    later_rows = (
        Window.partitionBy("__bucket")
        .orderBy(F.desc(cut.key))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earliest = F.least(F.min(arrival_col).over(later_rows), F.col("__after"))
    late = F.coalesce(F.col(arrival_col) - earliest > F.lit(cutoff), F.lit(False))
    return rows.join(ends, "__bucket").withColumn(name, late).select(*df.columns, name)
