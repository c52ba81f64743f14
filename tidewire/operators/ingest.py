"""Declared-schema checks, typed casts, quarantine and the counts made from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.once import with_once
from tidewire.functions.text import parse_float, parse_integer, strip
from tidewire.spec import Column, check_declared
from tidewire.workspace import small_frame

ERRORS = "severity string, code string, column string, message string"

# Message texts.
MISSING = "Column '{}' declared in config schema_mapping but missing from CSV."
EXTRA = "Ignoring extra CSV column: '{}'"

# Prefix lengths of the status screen.
RAW_VALUE_CHARS, REASON_CHARS, MESSAGE_CHARS = 18, 40, 90

_PARSE = {"string": strip, "integer": parse_integer, "float": parse_float}


def errors_frame(spark: SparkSession, rows: Sequence[tuple] = ()) -> DataFrame:
    return small_frame(spark, list(rows), ERRORS)


def check_columns(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """One FATAL row per declared column the input lacks. Names compare case-sensitively.

    Columns of the input that are not declared are listed as INFO: they are dropped.
    """
    check_declared(columns)
    declared = [c.source_name for c in columns]
    missing = [
        (
            "FATAL",
            "MISSING_COLUMN",
            name,
            MISSING.format(name),
        )
        for name in declared
        if name not in df.columns
    ]
    extra = [
        ("INFO", "EXTRA_COLUMN", name, EXTRA.format(name))
        for name in sorted(set(df.columns) - set(declared))
    ]
    return errors_frame(df.sparkSession, missing + extra)


def select_declared(df: DataFrame, columns: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns in declared order; ``keep`` names helper columns carried along."""
    return df.select(*[df[f"`{c.source_name}`"] for c in columns], *keep)


def rename_internal(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    return df.withColumnsRenamed({c.source_name: c.internal_mapping for c in columns})


def cast_declared(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Add ``<name>__cast`` and ``<name>__ok`` per declared column; the raw text stays.

    NULL fails for every type. Strings are stripped and never fail otherwise.
    """
    casts = {
        f"{c.source_name}__cast": _PARSE[c.data_type](F.col(f"`{c.source_name}`")) for c in columns
    }
    return with_once(df, casts).withColumns(
        {f"{c.source_name}__ok": F.col(f"`{c.source_name}__cast`").isNotNull() for c in columns}
    )


def _ok(c: Column):
    return F.col(f"`{c.source_name}__ok`")


def all_ok(columns: Sequence[Column]):
    return reduce(and_, [_ok(c) for c in columns])


def clean_rows(cast_df: DataFrame, columns: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose every declared cell was cast, as typed columns under their source names."""
    return cast_df.filter(all_ok(columns)).select(
        *[F.col(f"`{c.source_name}__cast`").alias(c.source_name) for c in columns], *keep
    )


def quarantine_rows(
    cast_df: DataFrame, columns: Sequence[Column], row_index: str = "row_index"
) -> DataFrame:
    """One record per bad row, about its first failing column in declared order."""

    first = first_bad_cell(columns)
    return (
        cast_df.filter(~all_ok(columns))
        .select(F.col(row_index).cast("bigint").alias("row_index"), first.alias("bad"))
        .select("row_index", "bad.column", "bad.raw_value", "bad.reason")
    )


def first_bad_cell(columns: Sequence[Column]):
    """The first failing column in declared order, its raw value and the reason; null for a clean row."""

    def record(c: Column):
        raw = F.col(f"`{c.source_name}`")
        return F.struct(
            F.lit(c.source_name).alias("column"),
            raw.alias("raw_value"),
            # fixed value: the message text
            F.concat(
                F.lit("Cannot cast '"),
                F.coalesce(raw, F.lit("nan")),
                F.lit(f"' to {c.data_type}"),
            ).alias("reason"),
        )

    return F.coalesce(*[F.when(~_ok(c), record(c)) for c in columns])


def quarantine_preview(quarantine_df: DataFrame, n: int = 6) -> DataFrame:
    """The first ``n`` bad rows cut to display width, and how many more there are.

    Each task keeps its own first ``n`` only; the count is a second pass over the bad rows.
    """
    head = quarantine_df.orderBy("row_index").limit(n)
    total = quarantine_df.agg(F.count("*").alias("total"))
    return head.select(
        "row_index",
        "column",
        F.substring(F.coalesce("raw_value", F.lit("nan")), 1, RAW_VALUE_CHARS).alias("raw_value"),
        F.substring("reason", 1, REASON_CHARS).alias("reason"),
        F.greatest(total.scalar() - F.lit(n), F.lit(0).cast("bigint")).alias("more"),
    )


def error_preview(errors_df: DataFrame) -> DataFrame:
    """FATAL messages cut to display width."""
    return errors_df.filter("severity = 'FATAL'").select(
        "code", "column", F.substring("message", 1, MESSAGE_CHARS).alias("message")
    )


def ingest_summary(cast_df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Rows loaded, passed and skipped, in one aggregate."""
    good = all_ok(columns)
    return cast_df.agg(
        F.count("*").alias("loaded"),
        F.count_if(good).alias("passed"),
        F.count_if(~good).alias("skipped"),
    )


def as_records(df: DataFrame, json: bool = False) -> DataFrame:
    """Each row as one ``record``: a struct, or its JSON text."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select((F.to_json(record) if json else record).alias("record"))


def dataset_status(errors_df: DataFrame, quarantine_df: DataFrame) -> DataFrame:
    """RED with any FATAL error, else AMBER with any skipped row, else GREEN; RED may not run."""
    flags = errors_df.filter("severity = 'FATAL'").select(F.lit(1).alias("f"), F.lit(0).alias("s"))
    skips = quarantine_df.select(F.lit(0).alias("f"), F.lit(1).alias("s"))
    counted = flags.unionAll(skips).agg(
        F.count_if(F.col("f") == 1).alias("fatal"), F.count_if(F.col("s") == 1).alias("skipped")
    )
    return counted.select(
        F.when(F.col("fatal") > 0, "RED")
        .when(F.col("skipped") > 0, "AMBER")
        .otherwise("GREEN")
        .alias("status"),
        "fatal",
        "skipped",
        (F.col("fatal") == 0).alias("may_run"),
    )
