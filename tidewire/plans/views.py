"""Signal views over the ``events`` table, used by the query catalogue, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.digest import native_digest
from tidewire.functions.once import with_once
from tidewire.spec import CHART_VALUE, Chart, Column

# A public key made up for these views; it protects nothing.
FIXTURE_KEY = "fixture_key"

WINDOW = 10

DECLARED = (
    Column("entity", "entity_name", "string"),
    Column("epoch", "time_period", "integer"),
    Column("reading", "metric_value", "float"),
    Column("signature", "security_hash", "string"),
)

CHARTS = tuple(Chart(t, t.replace("_", " "), "time_period", y) for t, y in CHART_VALUE.items())


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def epoch_seconds(ts: str) -> F.Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session's time zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def signals(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """One signed row per event; the signature is spoilt (reversed) where ``event_id % 7 = 3``.

    With ``once`` the digest is hashed once however often it is referred to, as a filter on it does;
    without, it is left out where it is not needed.
    """
    digest = native_digest(F.col("value"), FIXTURE_KEY)
    rows = events(spark, sf_dir)
    if once:
        rows, digest = with_once(rows, {"digest": digest}), F.col("digest")
    return rows.select(
        "event_id",
        F.col("event_type").alias("entity_name"),
        epoch_seconds("ts").alias("time_period"),
        F.col("value").alias("metric_value"),
        F.when(F.col("event_id") % 7 == 3, F.reverse(digest)).otherwise(digest).alias("security_hash"),
    )


def raw_signals(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """The same rows as texts under their source names, with planted bad cells."""
    text = {
        "entity": F.col("entity_name"),
        "epoch": F.col("time_period").cast("string"),
        "reading": F.col("metric_value").cast("string"),
        "signature": F.col("security_hash"),
    }
    plant = (
        (17, "reading", F.lit("N/A")),
        (19, "reading", F.lit("12x")),
        (23, "epoch", F.lit("12.7")),
        (29, "entity", F.lit("")),
        (31, "reading", F.concat(F.lit("  "), text["reading"], F.lit(" "))),
    )
    first = F.coalesce(*[F.when(F.col("event_id") % m == 0, F.lit(m)) for m, _, _ in plant], F.lit(0))
    cells = dict(text)
    for m, column, planted in plant:
        cells[column] = F.when(F.col("__first") == m, planted).otherwise(cells[column])
    marked = signals(spark, sf_dir, once).withColumn("__first", first)
    if once:
        return with_once(marked, cells).select("event_id", *cells)
    return marked.withColumns(cells).select("event_id", *cells)
