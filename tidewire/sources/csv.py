"""CSV scans, batch and streaming: every column text, missing-value tokens as NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.text import NA_TOKENS
from tidewire.operators.ingest import errors_frame
from tidewire.operators.ordering import SOURCE_ORDER

CORRUPT = "__corrupt"


def _reader(reader, multiline: bool):
    return (
        reader.option("header", True)
        .option("escape", '"')
        # files of a set must agree on the header, not only on the number of columns
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def missing_as_null(df: DataFrame, names: Sequence[str], na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Cells that equal a missing-value token, untrimmed, as NULL."""
    cells = {c: F.col(f"`{c}`") for c in names}
    return df.withColumns({c: F.when(~v.isin(*na_tokens), v) for c, v in cells.items()})


def csv_header(spark: SparkSession, path: str, multiline: bool = False) -> list[str]:
    """Cells of the first line; raises ``AnalysisException`` if the path is missing, ``ValueError`` if it is empty."""
    lines = _reader(spark.read, multiline).option("header", False).csv(path)
    first = lines.first() if lines.columns else None
    if first is None:
        raise ValueError("no header line")
    return [cell or f"_c{place}" for place, cell in enumerate(first)]


def _told_apart(header: Sequence[str]) -> list[str]:
    """Names that differ in more than case: later ones get ``.1``, ``.2``, as free."""
    names: list[str] = []
    taken = {name.lower() for name in header}
    for name in header:
        own, number = name, 0
        while own.lower() in {n.lower() for n in names} or (number and own.lower() in taken):
            number += 1
            own = f"{name}.{number}"
        names.append(own)
    return names


def scan_csv(
    spark: SparkSession,
    path: str,
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = False,
    source_order: bool = False,
    ragged: bool = False,
) -> DataFrame:
    """All columns as text, by header name; cells equal to a missing-value token are NULL.

    ``source_order`` adds the columns ``SOURCE_ORDER`` for ``add_sequence``; files rank by path.
    ``ragged`` adds ``__overlong``, whether the line has more cells than the header, ``__open``,
    whether it leaves a quote open, and ``__text``, such a line itself. ``multiline`` allows line breaks within quotes, and makes each file
    one unsplittable task. Of header names that are equal but for case the first keeps its name, and the
    others get a number; the files of a set then agree by place.
    """
    header = csv_header(spark, path, multiline)
    names = _told_apart(header)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    reader = _reader(spark.read, multiline).option("enforceSchema", names != header)
    if ragged:
        # with unread columns pruned, the parser would not notice surplus cells
        schema = schema.add(CORRUPT, T.StringType())
        reader = reader.option("columnPruning", False)
    df = reader.schema(schema).csv(path)
    extra = []
    if source_order:
        file, block, line = SOURCE_ORDER
        extra += [
            F.col("_metadata.file_path").alias(file),
            F.col("_metadata.file_block_start").alias(block),
            F.monotonically_increasing_id().alias(line),
        ]
    if ragged:
        extra += fault_columns(names)
    cells = [F.col(f"`{c}`") for c in names]
    return missing_as_null(df.select(*cells, *extra), names, na_tokens)


def fault_columns(names: Sequence[str]) -> list:
    """``__overlong``, ``__open`` and ``__text`` (the line, if it has too few or too many cells)."""
    text = F.when(_holds_cell(names), F.col(CORRUPT))
    return [_overlong(names).alias("__overlong"), _open_quote(names).alias("__open"), text.alias("__text")]


def _bare(line):
    """A line without its quoted cells. A quote opens a cell only at its start; elsewhere it is text."""
    return F.regexp_replace(line, r'(^|,)"(?:[^"]|"")*"', "$1")


def _overlong(names: Sequence[str]):
    """A line is kept as corrupt if it is too short or too long: count its unquoted commas."""
    line = F.col(CORRUPT)
    bare = _bare(line)
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.coalesce((commas >= len(names)) & _holds_cell(names), F.lit(False))


def _open_quote(names: Sequence[str]):
    """A corrupt line with a quote that opens a cell and is not closed in it: the cell goes on in the next line."""
    return F.coalesce(_bare(F.col(CORRUPT)).rlike('(^|,)"') & _holds_cell(names), F.lit(False))


def _holds_cell(names: Sequence[str]):
    # always true, but Spark refuses to read the corrupt-record column all by itself
    first = F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0))
    return F.length(CORRUPT) >= F.least(first, F.lit(0))


def scan_errors(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """FATAL rows for files that cannot be read, lines with too many cells and quotes left open; empty if all is well."""
    try:
        scanned = scan_csv(spark, path, multiline=multiline, ragged=True)
    except (AnalysisException, ValueError) as wrong:
        return unreadable(spark, path, wrong)
    counts = scanned.agg(F.count_if("__overlong").alias("overlong"), F.count_if("__open").alias("open"))
    return line_errors(counts)


def unreadable(spark: SparkSession, path: str, wrong: Exception) -> DataFrame:
    """Why a path could not be scanned: it is not there, it holds nothing, or else."""
    if isinstance(wrong, AnalysisException) and wrong.getCondition() == "PATH_NOT_FOUND":
        row = ("FATAL", "MISSING_FILE", None, f"CSV file not found: '{path}'")
    else:
        row = ("FATAL", "UNREADABLE_FILE", None, f"Could not read CSV: {str(wrong).splitlines()[0]}")
    return errors_frame(spark, [row])


def line_errors(counts: DataFrame) -> DataFrame:
    """FATAL rows from the one row of counts ``overlong`` and ``open``."""
    kinds = (
        ("RAGGED_ROW", "Could not read CSV: lines with too many cells: ", "overlong"),
        ("OPEN_QUOTE", "Could not read CSV: lines that leave a quote open: ", "open"),
    )
    found = [F.struct(F.lit(c).alias("code"), F.lit(t).alias("text"), F.col(n).alias("n")) for c, t, n in kinds]
    return (
        counts.select(F.inline(F.array(*found)))
        .filter("n > 0")
        .select(
            F.lit("FATAL").alias("severity"),
            "code",
            F.lit(None).cast("string").alias("column"),
            F.concat("text", F.col("n").cast("string")).alias("message"),
        )
    )


def stream_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    max_files: int = 1,
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = False,
    ragged: bool = False,
) -> DataFrame:
    """The CSV files of a folder as a stream of text columns, at most ``max_files`` per batch.

    A line that the parser would cut (more cells than ``columns``) or tear (a quote left open) stops the stream with
    an error, so that no cell is lost unseen. With ``ragged`` such lines pass, marked by ``__overlong``, ``__open`` and
    ``__text``, with ``__file`` and ``__block``: ``run_stream`` sets them aside. ``multiline`` allows line breaks within quotes.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    # with unread columns pruned, the parser would not notice surplus cells
    reader = _reader(spark.readStream, multiline).schema(schema).option("columnPruning", False)
    df = reader.option("maxFilesPerTrigger", max_files).csv(path)
    cells = [F.col(f"`{c}`") for c in columns]
    if ragged:
        file, block, _ = SOURCE_ORDER
        place = [F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block)]
        return missing_as_null(df.select(*cells, *place, *fault_columns(columns)), columns, na_tokens)
    overlong, opened, text = fault_columns(columns)
    told = F.concat(F.lit("line with too many cells or a quote left open: "), text)
    wrong = overlong if multiline else overlong | opened
    # a filter, as a column that nobody reads would check nothing
    checked = df.filter(F.when(wrong, F.raise_error(told).cast("boolean")).otherwise(F.lit(True)))
    return missing_as_null(checked.select(*cells), columns, na_tokens)
