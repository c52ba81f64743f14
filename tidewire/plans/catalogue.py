"""Every operator as a query over the whole given tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.digest import digest_udf
from tidewire.functions.text import two_decimals
from tidewire.operators import charts, health, ingest
from tidewire.operators.ordering import (
    SOURCE_ORDER,
    add_sequence,
    find_gaps,
    flag_stale,
    gap_ranges,
    reject_stale,
    resequence,
)
from tidewire.operators.rolling import rolling_average, sequence_and_average
from tidewire.operators.verify import verification_summary, verify_signatures
from tidewire.plans import live
from tidewire.plans.views import (
    CHARTS,
    DECLARED,
    FIXTURE_KEY,
    WINDOW,
    epoch_seconds,
    events,
    raw_signals,
    signals,
)
from tidewire.sources.csv import missing_as_null, scan_csv, scan_errors
from tidewire.spec import SEQUENCE, STAGES, Chart
from tidewire.workspace import materialise

# Charts of one type and title: one over time, one over numbers, and the first again.
TWINS = (
    Chart("real_time_line_graph_values", "readings", "time_period", "metric_value"),
    Chart("real_time_line_graph_values", "readings", "priority_index", "metric_value"),
    Chart("real_time_line_graph_values", "readings", "time_period", "metric_value"),
)

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared steps -------------------------------------------------------------------------------

def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All signals with their verification flag, numbered in event order and stored once."""
    flagged = verify_signatures(
        signals(spark, sf_dir), FIXTURE_KEY, 1, keep_flag=True, route="native"
    )
    return add_sequence(flagged, "event_id", unique=True)


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir).filter("verified").drop("verified", "event_id")


def processed(spark: SparkSession, sf_dir: str, window: int = WINDOW) -> DataFrame:
    """Signals numbered in event order, verified and averaged, all on the same stretches of the event's number."""
    flagged = verify_signatures(signals(spark, sf_dir, once=True), FIXTURE_KEY, 1, keep_flag=True, route="native")
    return sequence_and_average(flagged, "event_id", "metric_value", window, "verified").drop("verified", "event_id")


def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = missing_as_null(raw_signals(spark, sf_dir, once=True), [c.source_name for c in DECLARED])
    return ingest.cast_declared(raw, DECLARED)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = missing_as_null(raw_signals(spark, sf_dir), [c.source_name for c in DECLARED])
    rows = add_sequence(raw, "event_id", "row_index", start=0, unique=True)
    return ingest.quarantine_rows(ingest.cast_declared(rows, DECLARED), DECLARED)


# ---- queries ------------------------------------------------------------------------------------

def q_cast_declared(spark, sf_dir):
    clean = ingest.clean_rows(casts(spark, sf_dir), DECLARED, keep=["event_id"])
    return ingest.rename_internal(clean, DECLARED).select(
        "event_id", *[c.internal_mapping for c in DECLARED]
    )


def q_select_rename(spark, sf_dir):
    declared = ingest.select_declared(raw_signals(spark, sf_dir), DECLARED, keep=["event_id"])
    return ingest.rename_internal(declared, DECLARED)


def q_as_records(spark, sf_dir):
    return ingest.as_records(numbered(spark, sf_dir).drop("event_id", "verified")).select("record.*")


def q_as_json_records(spark, sf_dir):
    return ingest.as_records(raw_signals(spark, sf_dir), json=True)


def q_dataset_status(spark, sf_dir):
    errors = ingest.check_columns(raw_signals(spark, sf_dir), DECLARED)
    bad = casts(spark, sf_dir).filter(~ingest.all_ok(DECLARED))
    return ingest.dataset_status(errors, bad)


def q_dataset_status_cases(spark, sf_dir):
    """A declared column that is not there, bad rows, and clean rows only."""
    raw, cast, ok = raw_signals(spark, sf_dir), casts(spark, sf_dir), ingest.all_ok(DECLARED)
    lacking = ingest.check_columns(raw.drop("reading"), DECLARED)
    errors = ingest.check_columns(raw, DECLARED)
    cases = {
        "missing column": (lacking, cast.filter(~ok)),
        "bad rows": (errors, cast.filter(~ok)),
        "clean rows": (errors, cast.filter(ok).filter(~ok)),
    }
    named = [ingest.dataset_status(e, q).select(F.lit(n).alias("case"), "*") for n, (e, q) in cases.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def q_check_columns(spark, sf_dir):
    """What is missing and what is left over, with the number of rows that it concerns."""
    raw = raw_signals(spark, sf_dir).drop("reading")
    rows = raw.agg(F.count("*").alias("rows"))
    return ingest.check_columns(raw, DECLARED).select("*", rows.scalar().alias("rows"))


def q_scan_errors(spark, sf_dir):
    return scan_errors(spark, live.torn_csv(spark, sf_dir))


def q_error_preview(spark, sf_dir):
    return ingest.error_preview(q_scan_errors(spark, sf_dir))


def q_chart_titles(spark, sf_dir):
    return charts.chart_titles(health.pipeline_summary(verified(spark, sf_dir)), TWINS)


def q_chart_feed_twins(spark, sf_dir):
    """Charts of one type and title are told apart by their place in the list."""
    return charts.chart_feed(materialise(processed(spark, sf_dir), "processed"), TWINS)


def q_verify_table(spark, sf_dir):
    """Digests of distinct salts, joined back; two iterations, so Python hashes."""
    return verify_signatures(signed_twice(spark, sf_dir), FIXTURE_KEY, 2)


def signed_twice(spark, sf_dir):
    """Events signed by two iterations, a seventh of them wrongly."""
    digest = digest_udf(FIXTURE_KEY, 2)(two_decimals(F.col("value")))
    return events(spark, sf_dir).select(
        "event_id",
        F.col("value").alias("metric_value"),
        F.when(F.col("event_id") % 7 == 3, F.reverse(digest)).otherwise(digest).alias("security_hash"),
    )


def q_verify_wide(spark, sf_dir):
    """As with more digests than may be broadcast."""
    return verify_signatures(signals(spark, sf_dir), FIXTURE_KEY, 1, broadcast_digests=0)


def q_verification_summary(spark, sf_dir):
    flagged = verify_signatures(
        signals(spark, sf_dir), FIXTURE_KEY, 1, keep_flag=True, route="native"
    )
    return verification_summary(flagged, "entity_name")


def q_resequence(spark, sf_dir):
    shuffled = verified(spark, sf_dir).repartition(F.col("metric_value"))
    ordered = resequence(shuffled, SEQUENCE)
    return add_sequence(ordered, SEQUENCE, "position", unique=True)


def arrivals(spark, sf_dir):
    """Every 13th event reaches us an hour late."""
    delay = F.when(F.col("event_id") % 13 == 0, 3600).otherwise(0)
    return events(spark, sf_dir).select(
        "event_id", (epoch_seconds("ts") + delay).alias("arrival"), "event_type"
    )


def q_reject_stale(spark, sf_dir):
    kept, late = reject_stale(arrivals(spark, sf_dir), "event_id", "arrival")
    return kept


def q_stale_flags(spark, sf_dir):
    return flag_stale(arrivals(spark, sf_dir), "event_id", "arrival", name="late").select(
        "event_id", "late"
    )


def q_rolling_by_entity(spark, sf_dir):
    return rolling_average(
        signals(spark, sf_dir), "event_id", "metric_value", WINDOW, partition_by=["entity_name"]
    ).select("event_id", "entity_name", "computed_metric")


def q_chart_feed(spark, sf_dir):
    return charts.chart_feed(materialise(processed(spark, sf_dir), "processed"), CHARTS)


def q_float_axis_labels(spark, sf_dir):
    """Labels of a chart whose x axis holds fractions: measured values."""
    chart = Chart("real_time_scatter_values", "by value", "metric_value", "metric_value")
    return charts.axis_labels(charts.chart_feed(verified(spark, sf_dir), [chart]))


def q_stage_health(spark, sf_dir):
    return health.stage_health(hourly_samples(spark, sf_dir))


def q_stage_health_hidden(spark, sf_dir):
    return health.stage_health(hourly_samples(spark, sf_dir), {"intermediate": False}, hidden=True)


def hourly_samples(spark, sf_dir):
    """Events per hour as fill levels: all of them raw, clicks in between, errors processed."""
    hour = F.floor(epoch_seconds("ts") / 3600)
    counts = events(spark, sf_dir).groupBy(hour.alias("sample")).agg(
        F.count("*").alias("raw"),
        F.count_if(F.col("event_type") == "click").alias("intermediate"),
        F.count_if(F.col("event_type") == "error").alias("processed"),
    )
    pairs = [F.struct(F.lit(s).alias("stage"), F.col(s).alias("size")) for s in STAGES]
    return counts.select("sample", F.explode(F.array(*pairs)).alias("p")).select(
        "sample", "p.stage", "p.size", F.lit(20).cast("bigint").alias("max")
    )


def q_scan_csv(spark, sf_dir):
    """Write as CSV, scan, cast, and number the clean rows in source order."""
    return scanned(spark, live.raw_csv(spark, sf_dir))


def scanned(spark, path):
    scanned = scan_csv(spark, path, source_order=True)
    cast = ingest.cast_declared(scanned, DECLARED)
    clean = ingest.clean_rows(cast, DECLARED, keep=SOURCE_ORDER)
    return add_sequence(ingest.rename_internal(clean, DECLARED), SOURCE_ORDER)


def queries() -> dict[str, Query]:
    return {
        "flagship": processed,
        "cast_declared": q_cast_declared,
        "quarantine_rows": quarantine,
        "quarantine_preview": lambda s, d: ingest.quarantine_preview(
            materialise(quarantine(s, d), "quarantine")
        ),
        "ingest_summary": lambda s, d: ingest.ingest_summary(casts(s, d), DECLARED),
        "dataset_status": q_dataset_status,
        "dataset_status_cases": q_dataset_status_cases,
        "check_columns": q_check_columns,
        "scan_errors": q_scan_errors,
        "error_preview": q_error_preview,
        "chart_titles": q_chart_titles,
        "chart_feed_twins": q_chart_feed_twins,
        "bar_labels": lambda s, d: charts.axis_labels(q_chart_feed(s, d), "bar"),
        "scatter_extents": lambda s, d: charts.chart_extents(q_chart_feed(s, d), "scatter"),
        "rolling_average_w5000": lambda s, d: processed(s, d, 5000),
        "stream_csv": live.q_stream_csv,
        "stream_no_sequence": live.q_stream_no_sequence,
        "stream_gap_timeout": live.q_stream_gap_timeout,
        "stream_late_rows": live.q_stream_late_rows,
        "stream_repeated": live.q_stream_repeated,
        "stream_release_samples": live.q_stream_release_samples,
        "select_rename": q_select_rename,
        "as_records": q_as_records,
        "as_json_records": q_as_json_records,
        "scan_csv": q_scan_csv,
        "add_sequence": lambda s, d: add_sequence(
            events(s, d).select("ts", "event_id", "value"), ["ts", "event_id"]
        ),
        "verify_signatures": lambda s, d: verify_signatures(
            signals(s, d, once=True), FIXTURE_KEY, 1, route="native"
        ),
        "verify_signatures_table": q_verify_table,
        "verify_signatures_udf": lambda s, d: verify_signatures(
            signals(s, d), FIXTURE_KEY, 1, route="udf"
        ),
        "verify_signatures_wide": q_verify_wide,
        "verification_summary": q_verification_summary,
        "resequence": q_resequence,
        "find_gaps": lambda s, d: find_gaps(verified(s, d), SEQUENCE),
        "gap_ranges": lambda s, d: gap_ranges(verified(s, d), SEQUENCE),
        "reject_stale": q_reject_stale,
        "stale_flags": q_stale_flags,
        "rolling_average_w1": lambda s, d: processed(s, d, 1),
        "rolling_average_w3": lambda s, d: processed(s, d, 3),
        "rolling_average_w10": lambda s, d: processed(s, d, 10),
        "rolling_average_w100": lambda s, d: processed(s, d, 100),
        "rolling_average_by_entity": q_rolling_by_entity,
        "chart_feed": q_chart_feed,
        "chart_extents": lambda s, d: charts.chart_extents(q_chart_feed(s, d)),
        "axis_labels": lambda s, d: charts.axis_labels(q_chart_feed(s, d)),
        "float_axis_labels": q_float_axis_labels,
        "stage_health": q_stage_health,
        "stage_health_hidden": q_stage_health_hidden,
        "processed_summary": lambda s, d: health.pipeline_summary(verified(s, d)),
        "end_to_end": live.q_end_to_end,
        "end_to_end_quarantine": live.q_end_to_end_quarantine,
        "end_to_end_gaps": live.q_end_to_end_gaps,
        "end_to_end_feed": live.q_end_to_end_feed,
        "write_processed": live.q_write_processed,
        "write_feed": live.q_write_feed,
        "stream_verify": live.q_stream_verify,
        "stream_resequence": live.q_stream_resequence,
        "stream_rolling_average": live.q_stream_rolling,
        "stream_drain": live.q_stream_drain,
        "progress_samples": live.q_progress_samples,
        "stream_end_to_end": live.q_stream_end_to_end,
        "stream_end_to_end_quarantine": live.q_stream_end_to_end_quarantine,
        "stream_end_to_end_feed": live.q_stream_end_to_end_feed,
        "stream_add_sequence": live.q_stream_add_sequence,
        "stream_scan_errors": live.q_stream_scan_errors,
        "stream_faults": live.q_stream_faults,
        "stream_by_entity": live.q_stream_by_entity,
        "stream_by_entity_drain": live.q_stream_by_entity_drain,
        "stream_verify_table": live.q_stream_verify_table,
    }
