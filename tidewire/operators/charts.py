"""Tables behind the charts: last points, axis extents, axis labels and titles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.text import shortest_text
from tidewire.spec import CHART_VALUE, SEQUENCE, Chart, whole_number
from tidewire.workspace import small_frame

# Points kept per chart, labels per axis, label length, padding, title ending.
POINTS, LABEL_STEPS, LABEL_CHARS, PADDING, COMPLETE = 120, 6, 4, 0.05, "  ✔ Complete"

POINTS_SCHEMA = "chart string, seq bigint, x double, x_text string, y double"


def chart_points(
    df: DataFrame, charts: Sequence[Chart], n: int = POINTS, seq_col: str = SEQUENCE
) -> DataFrame:
    """The last ``n`` points of each chart, with their sequence numbers.

    A chart whose x or y column is absent gets no points. Charts on the same columns share one
    top-n, in which each task keeps only its own last ``n`` rows. ``df`` is read once per pair of
    columns, so an expensive input should be stored first.
    """
    whole_number("n", n)
    shared: dict[tuple[str, str], list[str]] = {}
    for name, chart in zip(chart_names(charts), charts):
        pair = chart.x_axis, CHART_VALUE[chart.type]
        if set(pair) <= set(df.columns):
            shared.setdefault(pair, []).append(name)
    if not shared:
        return small_frame(df.sparkSession, [], POINTS_SCHEMA)

    def points(pair, members):
        x, y = (F.col(f"`{c}`") for c in pair)
        fraction = dict(df.dtypes)[pair[0]] in ("double", "float")
        last = (
            df.select(F.col(seq_col).cast("bigint").alias("seq"), x.alias("x"), y.alias("y"))
            .filter("x is not null and y is not null")
            .orderBy(F.desc("seq"))
            .limit(n)
        )
        return last.select(
            F.explode(F.array(*map(F.lit, members))).alias("chart"),
            "seq",
            F.col("x").cast("string").try_cast("double").alias("x"),
            (shortest_text(F.col("x")) if fraction else F.col("x").cast("string")).alias("x_text"),
            F.col("y").cast("double").alias("y"),
        )

    return reduce(DataFrame.unionByName, [points(p, m) for p, m in shared.items()])


def newest_points(points_df: DataFrame, n: int = POINTS) -> DataFrame:
    """The last ``n`` of a union of point tables, each of which holds at most ``n`` per chart."""
    newest = Window.partitionBy("chart").orderBy(F.desc("seq"))
    return (
        points_df.withColumn("__rank", F.row_number().over(newest))
        .filter(F.col("__rank") <= n)
        .drop("__rank")
    )


def place_points(points_df: DataFrame) -> DataFrame:
    """Points as a feed: ``position`` counts from 0 within each chart."""
    in_order = Window.partitionBy("chart").orderBy("seq")
    position = (F.row_number().over(in_order) - 1).cast("bigint").alias("position")
    return points_df.select("chart", position, "x", "x_text", "y")


def chart_feed(
    df: DataFrame, charts: Sequence[Chart], n: int = POINTS, seq_col: str = SEQUENCE
) -> DataFrame:
    """The last ``n`` points of each chart in order (see ``chart_points``)."""
    return place_points(chart_points(df, charts, n, seq_col))


def chart_name(chart: Chart) -> str:
    """What the first chart of a type and title is called."""
    return f"{chart.type}: {chart.title}"


def chart_names(charts: Sequence[Chart]) -> list[str]:
    """A name for each chart of the list, by its place: a further one of the same type and title gets a number."""
    names: list[str] = []
    for chart in charts:
        name, number = chart_name(chart), 1
        while name in names:
            number += 1
            name = f"{chart_name(chart)} ({number})"
        names.append(name)
    return names


def _of_kind(feed_df: DataFrame, kind: str | None) -> DataFrame:
    if kind is None:
        return feed_df
    return feed_df.filter(F.substring_index("chart", ":", 1).isin([t for t in CHART_VALUE if kind in t]))


def chart_extents(feed_df: DataFrame, kind: str | None = None) -> DataFrame:
    """Axis limits per chart: the range widened by 5 % of its size, or by 1 if it has no size.

    ``kind="scatter"`` for the charts whose limits are set; the others scale by themselves.
    """

    def pad(c: str):
        size = F.max(c) - F.min(c)
        return F.when(size * PADDING == 0, F.lit(1.0)).otherwise(size * PADDING)

    return _of_kind(feed_df, kind).groupBy("chart").agg(
        *[(F.min(c) - pad(c)).alias(f"{c}_low") for c in ("x", "y")],
        *[(F.max(c) + pad(c)).alias(f"{c}_high") for c in ("x", "y")],
    )


def axis_labels(feed_df: DataFrame, kind: str | None = None) -> DataFrame:
    """Every ``max(1, points // 6)``-th point of a chart, labelled by its x text's last characters.

    The feed holds a bounded number of points per chart. ``kind="bar"`` for the charts that are
    labelled so.
    """
    points = F.count("*").over(Window.partitionBy("chart"))
    step = F.greatest(F.lit(1), F.floor(points / LABEL_STEPS))
    return (
        _of_kind(feed_df, kind).withColumn("__step", step)
        .filter(F.col("position") % F.col("__step") == 0)
        .select("chart", "position", F.right("x_text", F.lit(LABEL_CHARS)).alias("label"))
    )


def chart_titles(summary_df: DataFrame, charts: Sequence[Chart]) -> DataFrame:
    """Each chart's title, with the completion mark once the run is complete."""
    named = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("chart"), F.lit(c.title).alias("t"))
                for name, c in zip(chart_names(charts), charts)
            ]
        )
    )
    return summary_df.select("complete", named.alias("c")).select(
        "c.chart",
        F.concat("c.t", F.when(F.col("complete"), F.lit(COMPLETE)).otherwise(F.lit(""))).alias("title"),
    )
