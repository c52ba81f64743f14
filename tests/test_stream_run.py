"""The whole run as a stream: numbers, sinks that are committed together, and lines set aside."""

import os

import pytest
from test_run import COLUMNS, dataset, spec, write
from tidewire.operators.ingest import quarantine_preview
from tidewire.plans import stream_run
from tidewire.plans.stream_run import run_stream
from tidewire.sources.csv import stream_csv
from tidewire.sources.sinks import write_processed

HEADER = ("Sensor", "Clock", "Extra", "Reading", "Mark")


def land(tmp_path, rows, parts, name="in"):
    """The rows as files, written one after the other in the order of their names."""
    top = tmp_path / name
    os.makedirs(top)
    size = -(-len(rows) // parts)
    for part in range(parts):
        path = top / f"{part:03}.csv"
        write(path, rows[part * size : (part + 1) * size])
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))
    return str(top)


def started(spark, folder, path, iterations=3, **kw):
    return run_stream(spark, spec(path, iterations, **kw), folder("out"), folder("state"), folder("cp"))


def tuples(df):
    return sorted(map(tuple, df.collect()))


def check_same(spark, run, rows, bad, clean, processed):
    numbers = [(n, clock, value, ok) for n, (clock, value, ok) in enumerate(clean, 1)]
    clean_rows = run.table(spark, "clean").select("priority_index", "time_period", "metric_value", "verified")
    assert tuples(clean_rows) == numbers
    kept = run.table(spark, "processed").drop("security_hash")
    assert tuples(kept) == processed
    assert tuples(run.table(spark, "quarantine")) == bad
    assert tuple(run.counts(spark).first()) == (len(rows), len(clean), len(bad))


def test_same_as_the_batch(spark, folder, tmp_path):
    rows, bad, clean, processed = dataset(900, 3)
    query, run = started(spark, folder, land(tmp_path, rows, 3))
    query.awaitTermination()
    check_same(spark, run, rows, bad, clean, processed)
    feed = run.table(spark, "feed")
    assert feed.filter("chart like '%average%'").count() == 120
    assert run.table(spark, "faults").count() == run.errors(spark).count() == 0
    samples = {(r["sample"], r.stage): r["size"] for r in run.samples(spark).collect()}
    assert [samples[b, "raw"] for b in range(3)] == [300] * 3
    assert sum(samples[b, "processed"] for b in range(3)) == len(processed)
    shown = run.health(spark).filter("stage = 'raw'").first()
    assert shown["max"] == 50 and shown.color == "red"
    assert quarantine_preview(run.table(spark, "quarantine")).count() == 6


def test_costly_digests_are_kept_from_batch_to_batch(spark, folder, tmp_path):
    rows, bad, clean, processed = dataset(120, 1000)
    query, run = started(spark, folder, land(tmp_path, rows, 2), iterations=1000)
    query.awaitTermination()
    check_same(spark, run, rows, bad, clean, processed)
    kept = spark.read.parquet(f"{run.state}/digests/digests")
    assert kept.count() == kept.select("__salt").distinct().count() == len({f"{v:.2f}" for _, v, _ in clean})


def test_a_batch_cut_off_half_way_changes_nothing(spark, folder, tmp_path, monkeypatch):
    """The second batch fails after all its sinks are written, and once more in the middle; then it is run again."""
    rows, bad, clean, processed = dataset(300, 3)
    path, places = land(tmp_path, rows, 3), [folder("out"), folder("state"), folder("cp")]
    broken = {"text": 1, "feed": 1}

    def failing(kind, real):
        def call(*a, **k):
            batch_id = a[-1] if kind == "feed" else int("batch=1.json" in a[1])
            if batch_id == 1 and broken[kind]:
                broken[kind] -= 1
                raise RuntimeError("cut off")
            return real(*a, **k)

        return call

    monkeypatch.setattr(stream_run, "put_text", failing("text", stream_run.put_text))
    monkeypatch.setattr(stream_run.StreamRun, "_merge_feed", failing("feed", stream_run.StreamRun._merge_feed))
    for _ in range(2):
        query, run = run_stream(spark, spec(path, 3), *places)
        with pytest.raises(Exception, match="cut off"):
            query.awaitTermination()
        # the rows of the batch lie there, and nobody reads them
        assert run.table(spark, "clean").count() == sum(1 for i in range(100) if i % 17 not in (3, 5))
    query, run = run_stream(spark, spec(path, 3), *places)
    query.awaitTermination()
    check_same(spark, run, rows, bad, clean, processed)


def test_cut_and_torn_lines_are_set_aside(spark, folder, tmp_path):
    """Surplus cells, a line break within quotes, rows behind it; other files are not touched."""
    rows, _, _, _ = dataset(20, 3)
    top = land(tmp_path, rows, 1)
    lines = open(f"{top}/000.csv").read().splitlines()
    torn = lines[:3] + [lines[3] + ",SURPLUS"] + lines[4:8] + ['"a', 'b",1,2,3.5,x'] + lines[8:10]
    with open(f"{top}/001.csv", "w") as file:
        file.write("\n".join(torn) + "\n")
    os.utime(f"{top}/001.csv", (1_800_000_000, 1_800_000_000))
    query, run = started(spark, folder, top)
    query.awaitTermination()
    faults = [(r.code, r.line) for r in run.table(spark, "faults").collect()]
    assert ("RAGGED_ROW", lines[3] + ",SURPLUS") in faults and ("OPEN_QUOTE", '"a') in faults
    # what follows the open quote is kept as it was read, cell by cell
    after = [line for code, line in faults if code == "AFTER_OPEN_QUOTE"]
    assert len(faults) == 5 and len(after) == 3
    assert {(r.code, r.lines) for r in run.fault_counts(spark).collect()} == {("RAGGED_ROW", 1), ("OPEN_QUOTE", 1), ("AFTER_OPEN_QUOTE", 3)}
    loaded, passed, skipped = run.counts(spark).first()
    assert loaded == 20 + len(torn) - 1 and passed + skipped + len(faults) == loaded
    numbers = [r.priority_index for r in run.table(spark, "clean").orderBy("priority_index").collect()]
    assert numbers == list(range(1, passed + 1))
    assert sorted(r.code for r in run.errors(spark).collect()) == ["OPEN_QUOTE", "RAGGED_ROW"]


def test_line_breaks_within_quotes_if_declared(spark, folder, tmp_path):
    rows, _, _, _ = dataset(12, 3)
    rows = [(f"two\nlines {i}", *row[1:]) for i, row in enumerate(rows)]
    query, run = started(spark, folder, land(tmp_path, rows, 2), multiline=True)
    query.awaitTermination()
    names = {r.entity_name for r in run.table(spark, "clean").collect()}
    assert names and all(n.startswith("two\nlines") for n in names)
    assert run.table(spark, "faults").count() == 0


def test_a_plain_stream_stops_at_a_cut_line(spark, folder, tmp_path):
    for name, line in (("long", "b,2,SURPLUS"), ("open", '"b,2')):
        os.makedirs(tmp_path / name)
        (tmp_path / name / "a.csv").write_text(f"x,y\na,1\n{line}\n")
        stream = stream_csv(spark, str(tmp_path / name), ["x", "y"]).select("y")
        query = write_processed(stream, folder("out"), checkpoint=folder("cp"))
        with pytest.raises(Exception, match="too many cells or a quote left open"):
            query.awaitTermination()


def test_nothing_verified_and_missing_columns(spark, folder, tmp_path):
    rows = [("s", i, "x", "1.5", "no") for i in range(5)]
    query, run = started(spark, folder, land(tmp_path, rows, 2))
    assert run.table(spark, "processed").columns[-1] == "computed_metric"
    query.awaitTermination()
    assert run.table(spark, "processed").count() == 0 and run.table(spark, "clean").count() == 5
    path = tmp_path / "short"
    os.makedirs(path)
    write(path / "a.csv", rows, header=("Sensor", "Clock", "Extra", "Other", "Mark"))
    with pytest.raises(ValueError, match="Reading"):
        started(spark, folder, str(path))
    with pytest.raises(ValueError):
        run.table(spark, "late")
    assert len(COLUMNS) == 4 and HEADER
