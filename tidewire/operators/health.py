"""Fill level and colour of each stage, and the run's own counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.spec import STAGES

# Bands of the fill ratio, and the labels of the stages.
GREEN_BELOW, YELLOW_BELOW = 0.40, 0.75
STAGE_LABELS = {
    "raw": "Raw Stream (Input → Core)",
    "intermediate": "Intermediate Stream (Core → Aggregator)",
    "processed": "Processed Stream (Aggregator → Output)",
}

SAMPLES = "sample bigint, stage string, size bigint, max bigint"


def fill_ratio(size: Column, most: Column) -> Column:
    return F.when(most > 0, F.least(size / most, F.lit(1.0))).otherwise(0.0)


def band(ratio: Column) -> Column:
    return (
        F.when(ratio < GREEN_BELOW, "green").when(ratio < YELLOW_BELOW, "yellow").otherwise("red")
    )


def stage_health(
    samples_df: DataFrame, show: Mapping[str, bool] | None = None, hidden: bool = False
) -> DataFrame:
    """Fill ratio, percent, colour and label per (sample, stage).

    A stage that is not shown counts as empty and is left out unless ``hidden``.
    """
    shown_stages = [s for s in STAGES if (show or {}).get(s, True)]
    shown = F.col("stage").isin(shown_stages)
    label = F.coalesce(
        *[F.when(F.col("stage") == s, F.lit(text)) for s, text in STAGE_LABELS.items()],
        F.col("stage"),
    )
    health = (
        samples_df.withColumn("shown", shown)
        .withColumn("size", F.when(F.col("shown"), F.col("size")).otherwise(F.lit(0)))
        .withColumn("fill_ratio", fill_ratio(F.col("size"), F.col("max")))
        .select(
            "sample",
            "stage",
            "size",
            "max",
            "fill_ratio",
            F.floor(F.col("fill_ratio") * 100).cast("int").alias("percent"),
            band(F.col("fill_ratio")).alias("color"),
            label.alias("label"),
            "shown",
        )
    )
    return health if hidden else health.filter("shown").drop("shown")


def pipeline_summary(processed_df: DataFrame, complete: bool = True) -> DataFrame:
    """Rows processed, and whether the run is complete."""
    return processed_df.agg(
        F.count("*").alias("processed"), F.lit(complete).alias("complete")
    )
