"""One pass over scanned CSV rows: good rows, bad rows and faulty lines stored apart, all numbered from one count.

The scan is parsed, checked and written once, by kind, in source order. A scan task reads each file split from its
first row to its last, and writes it so, hence the rows of a split lie one after the other in one stored file. So a
good row's place among the good rows of its split is its place in the stored file less that of the split's first;
and its place among all rows is its line number less the split's first line. Only whole splits are counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column as Expression
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators import ingest
from tidewire.operators.ordering import BROADCAST_SPLITS, SOURCE_ORDER, _sum_before
from tidewire.spec import DATA_TYPES, SEQUENCE, Column
from tidewire.workspace import exists, small_frame

KINDS = ("good", "bad", "fault")
FAULTS = "file string, code string, line string"
QUARANTINE = "row_index bigint, column string, raw_value string, reason string"
_KIND, _AT, _BAD, _FAULT, _FIRST_OPEN = "__kind", "__at", "__bad", "__fault", "__first_open"
_COUNTS = ("loaded", "good", "bad", "fault", "overlong", "open")
_SPLITS = "__file string, __block bigint, first_line bigint, n bigint, first_at bigint, good bigint, n_before bigint, good_before bigint"


@dataclass(frozen=True)
class Staged:
    """Stored rows of one scan; ``counts`` has loaded, good, bad, fault, overlong and open.

    ``torn`` names the first line with an open quote per file, from which on the file's rows cannot be trusted."""

    spark: SparkSession
    path: str
    columns: tuple[Column, ...]
    counts: dict[str, int]
    splits: DataFrame
    few_splits: bool
    good_rows: int
    torn: DataFrame | None = None

    def good(self, start: int = 1) -> DataFrame:
        """Clean rows, typed, by their internal names, numbered densely in source order."""
        file, block, _ = SOURCE_ORDER
        number = F.col("good_before") + F.col(_AT) - F.col("first_at") + F.lit(start)
        rows = self._placed(_trusted(self._rows("good"), self.torn))
        return rows.select(number.alias(SEQUENCE), *[F.col(f"`{c.internal_mapping}`") for c in self.columns])

    def quarantine(self, start: int = 0) -> DataFrame:
        """Bad rows with their number among all rows of the scan."""
        if not self.counts["bad"]:
            return small_frame(self.spark, [], QUARANTINE)
        rows = self._placed(_trusted(self._rows("bad"), self.torn))
        number = F.col("n_before") + F.col(SOURCE_ORDER[2]) - F.col("first_line") + F.lit(start)
        return rows.select(number.cast("bigint").alias("row_index"), f"{_BAD}.column", f"{_BAD}.raw_value", f"{_BAD}.reason")

    def faults(self) -> DataFrame:
        """Lines that the parser cuts or tears, and rows after an open quote, by file."""
        found = [self._rows("fault").select(F.col(SOURCE_ORDER[0]).alias("file"), f"{_FAULT}.code", f"{_FAULT}.line")]
        if self.torn is not None:
            # the cells as they were read: typed rows of these files are not used
            for kind in ("good", "bad"):
                lost = _after(self._rows(kind), self.torn)
                found.append(lost.select(F.col(SOURCE_ORDER[0]).alias("file"), F.lit("AFTER_OPEN_QUOTE").alias("code"), F.col(f"{_FAULT}.line").alias("line")))
        return reduce(DataFrame.unionByName, found)

    def _rows(self, kind: str) -> DataFrame:
        return _stored(self.spark, self.path, kind, self.columns)

    def _placed(self, rows: DataFrame) -> DataFrame:
        splits = F.broadcast(self.splits) if self.few_splits else self.splits
        return rows.join(splits, list(SOURCE_ORDER[:2]))


def stage_scan(scanned: DataFrame, columns: Sequence[Column], path: str, splits_path: str, keep_lines: bool = False) -> Staged:
    """Store ``scanned`` (with ``SOURCE_ORDER``, ``__overlong``, ``__open`` and ``__text``) under ``path``.

    ``keep_lines`` keeps the text of every row, so that rows after an open quote can be told as they were; without
    it, only faulty lines keep theirs."""
    spark = scanned.sparkSession
    helpers = [*SOURCE_ORDER, "__overlong", "__open", "__text"]
    cast = ingest.cast_declared(ingest.select_declared(scanned, columns, keep=helpers), columns)
    faulty = F.col("__overlong") | F.col("__open")
    kind = F.when(faulty, "fault").when(ingest.all_ok(columns), "good").otherwise("bad")
    code = F.when(F.col("__overlong"), "RAGGED_ROW").otherwise("OPEN_QUOTE")
    text = F.coalesce("__text", F.to_csv(F.struct(*[F.col(f"`{c.source_name}`") for c in columns])))
    fault = F.struct(F.when(faulty, code).alias("code"), (text if keep_lines else F.when(faulty, text)).alias("line"))
    seen = Observation()
    tagged = cast.withColumn(_KIND, kind).observe(
        seen,
        F.count("*").alias("loaded"),
        *[F.count_if(F.col(_KIND) == k).alias(k) for k in KINDS],
        F.count_if("__overlong").alias("overlong"),
        F.count_if("__open").alias("open"),
    )
    rows = tagged.select(
        *[F.col(f"`{c.source_name}__cast`").alias(c.internal_mapping) for c in columns],
        F.when(F.col(_KIND) == "bad", ingest.first_bad_cell(columns)).alias(_BAD),
        F.when(F.lit(keep_lines) | (F.col(_KIND) == "fault"), fault).alias(_FAULT),
        *SOURCE_ORDER,
        _KIND,
    )
    # sorted as the writer by kind wants them, so that it does not sort by kind alone and lose the order of lines
    writer = rows.sortWithinPartitions(_KIND, SOURCE_ORDER[2]).write.mode("overwrite").option("maxRecordsPerFile", 0)
    writer.partitionBy(_KIND).parquet(path)
    counts = {name: seen.get[name] for name in _COUNTS}
    torn = _first_open(_stored(spark, path, "fault", columns)) if counts["open"] else None
    return _counted(spark, path, tuple(columns), counts, torn, splits_path)


def _counted(spark, path, columns, counts, torn, splits_path) -> Staged:
    """Count the rows of each split, and what lies before it."""
    file, block, line = SOURCE_ORDER
    good = _trusted(_stored(spark, path, "good", columns), torn).select(file, block, line, _AT)
    rest = [_stored(spark, path, k, columns).select(file, block, line) for k in ("bad", "fault")]
    if torn is not None:
        rest.append(_after(_stored(spark, path, "good", columns), torn).select(file, block, line))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [good, *rest])
    splits = every.groupBy(file, block).agg(
        F.min(line).alias("first_line"), F.count("*").alias("n"), F.min(_AT).alias("first_at"), F.count(_AT).alias("good")
    )
    seen = Observation()
    placed = splits.withColumns({f"{c}_before": _sum_before(c, file, block) for c in ("n", "good")})
    observed = placed.observe(seen, F.count("*").alias("splits"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    observed.write.mode("overwrite").parquet(splits_path)
    stored = spark.read.schema(_SPLITS).parquet(splits_path)
    return Staged(spark, path, columns, counts, stored, seen.get["splits"] <= BROADCAST_SPLITS, seen.get["good"], torn)


def _stored(spark: SparkSession, path: str, kind: str, columns: Sequence[Column]) -> DataFrame:
    """Stored rows of one kind, with their place in the file that they lie in."""
    typed = T.StructType.fromDDL(", ".join(f"`{c.internal_mapping}` {DATA_TYPES[c.data_type]}" for c in columns))
    helpers = T.StructType.fromDDL(
        f"{_BAD} struct<column: string, raw_value: string, reason: string>, {_FAULT} struct<code: string, line: string>,"
        " __file string, __block bigint, __line bigint"
    )
    schema = T.StructType(typed.fields + helpers.fields)
    folder = f"{path}/{_KIND}={kind}"
    if not exists(spark, folder):
        return small_frame(spark, [], T.StructType([*schema.fields, T.StructField(_AT, T.LongType())]))
    return spark.read.schema(schema).parquet(folder).select("*", F.col("_metadata.row_index").alias(_AT))


def _first_open(faults: DataFrame) -> DataFrame:
    file, block, line = SOURCE_ORDER
    opened = faults.filter(F.col(_FAULT)["code"] == "OPEN_QUOTE")
    return opened.groupBy(file).agg(F.min(F.struct(F.col(block).alias("b"), F.col(line).alias("l"))).alias(_FIRST_OPEN))


def _is_after() -> Expression:
    _, block, line = SOURCE_ORDER
    first = F.col(_FIRST_OPEN)
    return F.coalesce((F.col(block) > first["b"]) | ((F.col(block) == first["b"]) & (F.col(line) > first["l"])), F.lit(False))


def _trusted(rows: DataFrame, torn: DataFrame | None) -> DataFrame:
    """Rows that lie before any open quote of their file. Files are as many as splits at most."""
    if torn is None:
        return rows
    return rows.join(torn, SOURCE_ORDER[0], "left").filter(~_is_after()).select(*rows.columns)


def _after(rows: DataFrame, torn: DataFrame) -> DataFrame:
    return rows.join(torn, SOURCE_ORDER[0], "left").filter(_is_after()).select(*rows.columns)
