"""CSV scans, casts, quarantine and status on hand-made files."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from tidewire.functions.text import NA_TOKENS
from tidewire.operators import ingest
from tidewire.operators.ordering import SOURCE_ORDER, add_sequence, number_kept
from tidewire.sources.csv import csv_header, scan_csv, scan_errors
from tidewire.spec import Chart, Column, RunSpec, check_declared

COLUMNS = (
    Column("Name", "entity_name", "string"),
    Column("When", "time_period", "integer"),
    Column("Value", "metric_value", "float"),
)


@pytest.fixture
def csv(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8", newline="")
        return str(path)

    return write


def cast(spark, path, **kw):
    scanned = scan_csv(spark, path, source_order=True, **kw)
    return ingest.cast_declared(ingest.select_declared(scanned, COLUMNS, keep=SOURCE_ORDER), COLUMNS)


def quarantine(spark, path, **kw):
    rows = add_sequence(cast(spark, path, **kw), SOURCE_ORDER, "row_index", start=0)
    return [tuple(r) for r in ingest.quarantine_rows(rows, COLUMNS).orderBy("row_index").collect()]


def test_na_tokens(spark, csv):
    cells = [*NA_TOKENS[1:], " NA", "NA ", "na", "ok"]
    path = csv("Name,When,Value\n" + "".join(f"{c},1,2\n" for c in cells) + ',1,2\n"",1,2\n')
    kept = ingest.clean_rows(cast(spark, path), COLUMNS).collect()
    assert sorted(r.Name for r in kept) == ["NA", "NA", "na", "ok"]
    assert len(quarantine(spark, path)) == len(NA_TOKENS) + 1
    assert quarantine(spark, path)[0] == (0, "Name", None, "Cannot cast 'nan' to string")


def test_scan_equals_pandas(spark, csv):
    path = csv(
        'Name,When,Value\r\na,1,2\r\n\r\n"x ""y"", z",2,3\r\nshort\r\n spaced , 4 ,5\r\n"line\nbreak",6,7\r\n'
    )
    theirs = pd.read_csv(path, dtype=str)
    ours = scan_csv(spark, path, multiline=True).collect()
    assert [tuple(r) for r in ours] == [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)
        for row in theirs.itertuples(index=False)
    ]


def test_first_bad_column_only(spark, csv):
    path = csv("Name,When,Value\na,1,2\nb,x,y\nc,3, 4 \nd,4,oops\n,x,1\n  ,5,6\n")
    assert quarantine(spark, path) == [
        (1, "When", "x", "Cannot cast 'x' to integer"),
        (3, "Value", "oops", "Cannot cast 'oops' to float"),
        (4, "Name", None, "Cannot cast 'nan' to string"),
    ]
    clean = ingest.rename_internal(ingest.clean_rows(cast(spark, path), COLUMNS), COLUMNS)
    assert [tuple(r) for r in clean.collect()] == [("a", 1, 2.0), ("c", 3, 4.0), ("", 5, 6.0)]
    assert ingest.ingest_summary(cast(spark, path), COLUMNS).first().asDict() == {
        "loaded": 6, "passed": 3, "skipped": 3,
    }


def test_overlong_rows_are_fatal(spark, csv):
    good = csv('Name,When,Value\na,1,2\nshort,1\n"a,b",1,2\n', "good.csv")
    assert scan_errors(spark, good).count() == 0
    for line in ("a,1,2,3", "a,1,2,", "a,1,2,3,4", '"a,b",1,2,"c,d"'):
        bad = csv(f"Name,When,Value\na,1,2\n{line}\n", "bad.csv")
        assert [r.code for r in scan_errors(spark, bad).collect()] == ["RAGGED_ROW"], line
    assert [r.code for r in scan_errors(spark, "/no/such/file.csv").collect()] == ["MISSING_FILE"]


def test_header_checks(spark, csv):
    path = csv("name,When,Value,Extra\na,1,2,3\n")
    rows = ingest.check_columns(scan_csv(spark, path), COLUMNS).collect()
    assert [(r.severity, r.column) for r in rows] == [
        ("FATAL", "Name"), ("INFO", "Extra"), ("INFO", "name"),
    ]
    assert rows[0].message == "Column 'Name' declared in config schema_mapping but missing from CSV."
    assert csv_header(spark, path) == ["name", "When", "Value", "Extra"]
    assert ingest.error_preview(ingest.check_columns(scan_csv(spark, path), COLUMNS)).count() == 1


def test_no_clean_rows(spark, csv):
    path = csv("Name,When,Value\na,x,2\nb,y,3\n")
    assert ingest.clean_rows(cast(spark, path), COLUMNS).count() == 0
    assert len(quarantine(spark, path)) == 2
    empty = csv("Name,When,Value\n", "empty.csv")
    numbered = add_sequence(ingest.clean_rows(cast(spark, empty), COLUMNS, SOURCE_ORDER), SOURCE_ORDER)
    assert numbered.count() == 0 and numbered.columns == ["priority_index", "Name", "When", "Value"]


def test_files_of_a_set_must_share_their_header(spark, tmp_path):
    (tmp_path / "set").mkdir()
    (tmp_path / "set" / "a.csv").write_text("Name,When,Value\na,1,2\n")
    (tmp_path / "set" / "b.csv").write_text("When,Name,Value\n3,b,4\n")
    for ragged in (False, True):
        with pytest.raises(Exception, match="header"):
            scan_csv(spark, str(tmp_path / "set"), ragged=ragged).collect()


def _file_set(tmp_path):
    lines = [f"s{i},{'bad' if i % 11 == 4 else i},{i / 7}" for i in range(12000)]
    (tmp_path / "set").mkdir()
    for k, cut in enumerate((slice(0, 2000), slice(2000, 9500), slice(9500, 12000))):
        (tmp_path / "set" / f"p{k}.csv").write_text("Name,When,Value\n" + "\n".join(lines[cut]) + "\n")
    return str(tmp_path / "set")


@pytest.mark.parametrize("split", ["4096", "20000", "134217728"])
def test_source_order_over_files_and_splits(spark, tmp_path, split):
    path = _file_set(tmp_path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = cast(spark, path)
        good = ingest.clean_rows(rows, COLUMNS, keep=SOURCE_ORDER)
        clean = add_sequence(good, SOURCE_ORDER, keep_order=True)
        kept = number_kept(rows, ~ingest.all_ok(COLUMNS), clean, "row_index", start=0)
        names = [r.Name for r in clean.orderBy("priority_index").collect()]
        bad = [(r.row_index, r.Name) for r in kept.orderBy("row_index").collect()]
        shuffled = ingest.clean_rows(rows, COLUMNS, keep=SOURCE_ORDER).repartition(7)
        again = add_sequence(shuffled, SOURCE_ORDER)
        assert [r.Name for r in again.orderBy("priority_index").collect()] == names
        assert names == [f"s{i}" for i in range(12000) if i % 11 != 4]
        # another way of splitting the same files in between does not matter
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        mixed = number_kept(rows, ~ingest.all_ok(COLUMNS), clean, "row_index", start=0)
        assert [(r.row_index, r.Name) for r in mixed.orderBy("row_index").collect()] == bad
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert bad == [(i, f"s{i}") for i in range(12000) if i % 11 == 4]
    numbers = clean.agg(F.min("priority_index"), F.max("priority_index"), F.countDistinct("priority_index"))
    assert tuple(numbers.first()) == (1, len(names), len(names))


def _bad(spark, n):
    rows = [(i, "Value", f"raw value of row number {i}", f"Cannot cast '{'x' * 40}' to float") for i in range(n)]
    return spark.createDataFrame(
        rows[::-1], "row_index bigint, column string, raw_value string, reason string"
    )


@pytest.mark.parametrize("n", [0, 6, 7, 50])
def test_preview(spark, n):
    rows = ingest.quarantine_preview(_bad(spark, n)).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(min(n, 6)))
    assert all(r.more == max(n - 6, 0) and len(r.raw_value) == 18 and len(r.reason) == 40 for r in rows)


@pytest.mark.parametrize(
    "fatal, skipped, status", [(0, 0, "GREEN"), (0, 3, "AMBER"), (2, 0, "RED"), (1, 5, "RED")]
)
def test_status(spark, fatal, skipped, status):
    errors = ingest.errors_frame(
        spark, [("FATAL", "X", None, "m")] * fatal + [("INFO", "EXTRA_COLUMN", "e", "m")]
    )
    row = ingest.dataset_status(errors, _bad(spark, skipped)).first()
    assert tuple(row) == (status, fatal, skipped, status != "RED")


def test_records(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y bigint")
    assert ingest.as_records(df).first().record == ("a", 1)
    assert ingest.as_records(df, json=True).first().record == '{"x":"a","y":1}'


@pytest.mark.parametrize(
    "columns",
    [
        (),
        (Column("a", "x", "string"), Column("a", "y", "string")),
        (Column("a", "x", "string"), Column("b", "x", "string")),
        (Column("a", "priority_index", "integer"),),
        (Column("a", "computed_metric", "float"),),
    ],
)
def test_declarations_refused(columns):
    with pytest.raises(ValueError):
        check_declared(columns)


def _config():
    return {
        "dataset_path": "d.csv",
        "pipeline_dynamics": {"input_delay_seconds": 0.01, "core_parallelism": 4, "stream_queue_max_size": 50},
        "schema_mapping": {
            "columns": [
                {"source_name": "R", "internal_mapping": "metric_value", "data_type": "float"},
                {"source_name": "S", "internal_mapping": "security_hash", "data_type": "string"},
            ]
        },
        "processing": {
            "stateless_tasks": {"operation": "o", "algorithm": "a", "iterations": 5, "secret_key": "hidden"},
            "stateful_tasks": {"operation": "o", "running_average_window_size": 10},
        },
        "visualizations": {
            "telemetry": {f"show_{s}_stream": True for s in ("raw", "intermediate", "processed")},
            "data_charts": [
                {"type": "real_time_bar_chart_values", "title": "t", "x_axis": "x", "y_axis": "y"}
            ],
        },
    }


def test_config_is_read():
    config = _config()
    config["visualizations"]["data_charts"][0]["note"] = "more than needed"
    spec = RunSpec.from_mapping(config)
    assert (spec.window, spec.iterations, spec.queue_max_size) == (10, 5, 50)
    assert spec.charts == [Chart("real_time_bar_chart_values", "t", "x", "y")]
    assert "hidden" not in repr(spec)


@pytest.mark.parametrize(
    "section, key, value",
    [
        ("pipeline_dynamics", "input_delay_seconds", -1),
        ("pipeline_dynamics", "core_parallelism", True),
        ("pipeline_dynamics", "stream_queue_max_size", 0),
        ("processing.stateless_tasks", "iterations", 0),
        ("processing.stateless_tasks", "secret_key", " "),
        ("processing.stateless_tasks", "algorithm", ""),
        ("processing.stateful_tasks", "running_average_window_size", "10"),
        ("visualizations.telemetry", "show_raw_stream", "yes"),
        ("visualizations", "data_charts", []),
        ("schema_mapping", "columns", []),
    ],
)
def test_config_is_checked(section, key, value):
    config = _config()
    part = config
    for name in section.split("."):
        part = part[name]
    part[key] = value
    with pytest.raises(ValueError):
        RunSpec.from_mapping(config)
    del part[key]
    with pytest.raises(ValueError):
        RunSpec.from_mapping(config)


def test_all_problems_are_reported():
    config = _config()
    config["processing"]["stateless_tasks"]["operation"] = ""
    config["visualizations"]["data_charts"][0]["type"] = "pie"
    with pytest.raises(ValueError) as failed:
        RunSpec.from_mapping(config)
    assert "operation" in str(failed.value) and "pie" in str(failed.value)


