"""Whole runs over CSV files, against plain Python."""

import csv
import hashlib
import json
import os
import random
import re
from collections import deque
from pathlib import Path

import pytest
from tidewire.plans.run import run_pipeline
from tidewire.spec import Chart, Column, RunSpec

COLUMNS = (
    Column("Sensor", "entity_name", "string"),
    Column("Clock", "time_period", "integer"),
    Column("Reading", "metric_value", "float"),
    Column("Mark", "security_hash", "string"),
)
CHARTS = (
    Chart("real_time_line_graph_values", "values", "time_period", "metric_value"),
    Chart("real_time_scatter_average", "averages", "time_period", "computed_metric"),
)


def sign(value, key, iterations):
    return hashlib.pbkdf2_hmac("sha256", key.encode(), f"{value:.2f}".encode(), iterations).hex()


def spec(path, iterations, key="a key", **kw):
    return RunSpec(path, COLUMNS, key, iterations, kw.pop("window", 10), CHARTS, **kw)


def write(path, rows, header=("Sensor", "Clock", "Extra", "Reading", "Mark")):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


def dataset(n, iterations, key="a key"):
    rnd = random.Random(n)
    rows, bad, clean = [], [], []
    for i in range(n):
        value = rnd.choice([2.675, 0.125]) if i % 50 == 7 else rnd.randrange(2000, 4500) / 100
        mark = sign(value if i % 6 else value + 1, key, iterations)
        clock, reading = 1000 + i, str(value)
        if i % 17 == 3:
            reading = "N/A"
            bad.append((i, "Reading", None, "Cannot cast 'nan' to float"))
        elif i % 17 == 5:
            clock = "12.7"
            bad.append((i, "Clock", "12.7", "Cannot cast '12.7' to integer"))
        else:
            clean.append((clock, value, i % 6 != 0))
        rows.append((" s ", clock, "x", reading, mark))
    last, processed = deque(maxlen=10), []
    for n, (clock, value, ok) in enumerate(clean, 1):
        if ok:
            last.append(value)
            processed.append((n, "s", clock, value, round(sum(last) / len(last), 4)))
    return rows, bad, clean, processed


@pytest.mark.parametrize("n, iterations", [(900, 3), (40, 100_000)])
def test_whole_run(spark, tmp_path, n, iterations):
    rows, bad, clean, processed = dataset(n, iterations)
    run = run_pipeline(spark, spec(write(tmp_path / "in.csv", rows), iterations))
    got = [
        (r.priority_index, r.entity_name, r.time_period, r.metric_value, r.computed_metric)
        for r in run.processed.orderBy("priority_index").collect()
    ]
    assert got == processed
    assert run.processed.columns[0] == "priority_index" and run.processed.columns[-1] == "computed_metric"
    assert [tuple(r) for r in run.quarantine.orderBy("row_index").collect()] == bad
    assert tuple(run.ingest.first()) == (n, len(clean), len(bad))
    assert tuple(run.status.first()) == ("AMBER", 0, len(bad), True)
    assert sorted(r.missing for r in run.gaps.collect()) == [i for i, c in enumerate(clean, 1) if not c[2]]
    assert tuple(run.summary.first()) == (len(processed), True)
    assert tuple(run.verification.first()) == (len(processed), len(clean) - len(processed))
    assert [r.column for r in run.errors.collect()] == ["Extra"]
    feed = run.feed.orderBy("position").collect()
    for chart, at in (("values", 3), ("averages", 4)):
        points = [(r.x, r.y) for r in feed if r.chart.endswith(chart)]
        assert points == [(float(p[2]), p[at]) for p in processed[-120:]]


@pytest.mark.parametrize(
    "header, rows, code",
    [
        (("Sensor", "Clock", "Reading"), [("s", 1, 2.0)], "MISSING_COLUMN"),
        (("Sensor", "Clock", "Reading", "Mark"), [("s", 1, 2.0, "m"), ("s", 1, 2.0, "m", "more")], "RAGGED_ROW"),
        (None, None, "MISSING_FILE"),
    ],
)
def test_fatal_runs_process_nothing(spark, tmp_path, header, rows, code):
    path = write(tmp_path / "in.csv", rows, header) if header else str(tmp_path / "none.csv")
    run = run_pipeline(spark, spec(path, 1))
    assert [r.code for r in run.errors.filter("severity = 'FATAL'").collect()] == [code]
    assert tuple(run.status.first()) == ("RED", 1, 0, False)
    assert tuple(run.summary.first()) == (0, False)
    for table in (run.processed, run.quarantine, run.gaps, run.feed):
        assert table.count() == 0
    assert run.processed.columns == [
        "priority_index", "entity_name", "time_period", "metric_value", "security_hash", "computed_metric",
    ]


def test_nothing_clean(spark, tmp_path):
    path = write(tmp_path / "in.csv", [("s", "x", "", "y", "m")] * 3)
    run = run_pipeline(spark, spec(path, 1))
    assert run.processed.count() == 0 and run.quarantine.count() == 3 and run.feed.count() == 0
    assert tuple(run.status.first()) == ("AMBER", 0, 3, True)


def test_clean_run_is_green(spark, tmp_path):
    rows = [("s", i, "", "1.5", sign(1.5, "a key", 1)) for i in range(5)]
    run = run_pipeline(spark, spec(write(tmp_path / "in.csv", rows), 1))
    assert run.status.first().status == "GREEN" and run.quarantine.count() == 0 and run.gaps.count() == 0


@pytest.mark.parametrize(
    "change",
    [
        {"columns": COLUMNS[:2]},
        {"columns": (*COLUMNS[:2], Column("Reading", "metric_value", "string"), COLUMNS[3])},
        {"iterations": 0},
        {"window": True},
        {"queue_max_size": 0},
        {"show": {"raw": 1}},
        {"show": {"other": True}},
        {"dataset_path": ""},
    ],
)
def test_spec_checked(change):
    good = {
        "dataset_path": "p", "columns": COLUMNS, "secret_key": "k", "iterations": 1, "window": 1,
    }
    RunSpec(**good)
    with pytest.raises(ValueError):
        RunSpec(**{**good, **change})


@pytest.mark.skipif("TIDEWIRE_SAMPLE" not in os.environ, reason="no sample configuration named")
def test_golden_sample(spark):
    """The sample named by ``TIDEWIRE_SAMPLE`` (a configuration file) gives the listed averages."""
    config_file = Path(os.environ["TIDEWIRE_SAMPLE"])
    config = json.loads(config_file.read_text())
    config["dataset_path"] = str(config_file.parent / config["dataset_path"])
    text = (Path(__file__).parent.parent / "FIXTURES.md").read_text().split("## 2.")[1].split("## 3.")[0]
    listed = {int(a): float(b) for a, b in re.findall(r"\b(\d+):([\d.]+)", text.split("```")[1])}
    run = run_pipeline(spark, RunSpec.from_mapping(config))
    got = {r.priority_index: r.computed_metric for r in run.processed.collect()}
    assert got == listed and len(got) == 169
    assert round(sum(got.values()), 4) == 5405.1733
    assert run.status.first().status == "GREEN" and run.gaps.count() == 31
