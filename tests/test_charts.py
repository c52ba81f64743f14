"""Chart tables and stage health."""

from collections import deque

import pytest
from tidewire.operators.charts import (
    axis_labels,
    chart_extents,
    chart_feed,
    chart_name,
    chart_titles,
)
from tidewire.operators.health import pipeline_summary, stage_health
from tidewire.spec import CHART_VALUE, Chart

VALUES = Chart("real_time_line_graph_values", "v", "t", "any label")
AVERAGES = Chart("real_time_bar_chart_average", "a", "t", "any label")
SCHEMA = "priority_index long, t long, metric_value double, computed_metric double"


def rows(spark, n):
    data = [(i, 1773037000 + i, i / 4, i / 8) for i in range(1, n + 1)]
    return spark.createDataFrame(data, SCHEMA).repartition(4)


@pytest.mark.parametrize("n", [1, 119, 120, 121, 700])
def test_last_points(spark, n):
    feed = chart_feed(rows(spark, n), [VALUES, AVERAGES]).orderBy("position").collect()
    for chart, part in ((VALUES, 4), (AVERAGES, 8)):
        last = deque(((i, 1773037000 + i, i / part) for i in range(1, n + 1)), maxlen=120)
        want = [(p, float(x), str(x), y) for p, (_, x, y) in enumerate(last)]
        assert [tuple(r)[1:] for r in feed if r.chart == chart_name(chart)] == want


def test_absent_columns_and_nulls(spark):
    absent = Chart("real_time_scatter_values", "s", "no_such", "y")
    assert chart_feed(rows(spark, 5), [absent]).count() == 0
    data = [(1, 1, None, 1.0), (2, None, 2.0, 2.0), (3, 3, 3.0, None)]
    feed = chart_feed(spark.createDataFrame(data, SCHEMA), [VALUES, AVERAGES, absent])
    assert sorted((r.chart, r.position, r.y) for r in feed.collect()) == [
        (chart_name(AVERAGES), 0, 1.0), (chart_name(VALUES), 0, 3.0),
    ]


def test_text_axis(spark):
    df = spark.createDataFrame([(1, "sensor_x", 2.0)], "priority_index long, t string, metric_value double")
    row = chart_feed(df, [VALUES]).first()
    assert (row.x, row.x_text, row.y) == (None, "sensor_x", 2.0)


@pytest.mark.parametrize("n", [1, 5, 6, 13, 120])
def test_labels(spark, n):
    labels = axis_labels(chart_feed(rows(spark, n), [AVERAGES])).orderBy("position").collect()
    want = [(i, str(1773037001 + i)[-4:]) for i in range(0, n, max(1, n // 6))]
    assert [(r.position, r.label) for r in labels] == want


def test_extents(spark):
    feed = "chart string, position long, x double, x_text string, y double"
    data = [("a", 0, 0.0, "0", 5.0), ("a", 1, 100.0, "100", 5.0), ("b", 0, 7.0, "7", 1.0)]
    got = {r.chart: r for r in chart_extents(spark.createDataFrame(data, feed)).collect()}
    assert (got["a"].x_low, got["a"].x_high, got["a"].y_low, got["a"].y_high) == (-5.0, 105.0, 4.0, 6.0)
    assert (got["b"].x_low, got["b"].x_high) == (6.0, 8.0)


@pytest.mark.parametrize("complete", [True, False])
def test_titles(spark, complete):
    summary = pipeline_summary(rows(spark, 3), complete)
    assert tuple(summary.first()) == (3, complete)
    titles = {r.chart: r.title for r in chart_titles(summary, [VALUES, AVERAGES]).collect()}
    end = "  ✔ Complete" if complete else ""
    assert titles == {chart_name(VALUES): "v" + end, chart_name(AVERAGES): "a" + end}


def test_charts_checked():
    assert set(CHART_VALUE.values()) == {"metric_value", "computed_metric"}
    for args in (("pie", "t", "x", "y"), ("real_time_scatter_values", " ", "x", "y")):
        with pytest.raises(ValueError):
            Chart(*args)


BANDS = [
    (0, 1000, 0.0, "green"), (399, 1000, 0.399, "green"), (400, 1000, 0.4, "yellow"),
    (749, 1000, 0.749, "yellow"), (750, 1000, 0.75, "red"), (1500, 1000, 1.0, "red"),
    (5, 0, 0.0, "green"),
]


def samples(spark, data):
    return spark.createDataFrame(data, "sample long, stage string, size long, max long")


def test_bands(spark):
    df = samples(spark, [(i, "raw", size, most) for i, (size, most, _, _) in enumerate(BANDS)])
    for r in stage_health(df).collect():
        size, most, ratio, color = BANDS[r["sample"]]
        assert (r["size"], r["max"], r.fill_ratio, r.color, r.percent) == (
            size, most, ratio, color, int(ratio * 100),
        )
        assert r.label == "Raw Stream (Input → Core)"


def test_hidden_stages(spark):
    df = samples(spark, [(1, s, 45, 50) for s in ("raw", "intermediate", "processed")])
    show = {"raw": True, "intermediate": False}
    assert {r.stage for r in stage_health(df, show).collect()} == {"raw", "processed"}
    hidden = stage_health(df, show, hidden=True).filter("not shown").first()
    assert (hidden.stage, hidden["size"], hidden.fill_ratio, hidden.color) == ("intermediate", 0, 0.0, "green")
