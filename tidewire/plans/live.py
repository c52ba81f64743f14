"""Catalogue queries that write files or run a stream to its end before they answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators import ingest
from tidewire.operators.health import stage_health
from tidewire.operators.ordering import add_sequence
from tidewire.operators.rolling import rolling_average
from tidewire.operators.verify import DigestTable, stream_verify, verify_signatures
from tidewire.plans.run import Run, run_pipeline
from tidewire.plans.stream_run import StreamRun, run_stream
from tidewire.plans.views import CHARTS, DECLARED, FIXTURE_KEY, WINDOW, raw_signals, signals
from tidewire.sources.csv import stream_csv
from tidewire.sources.sinks import read_feed, write_feed, write_processed
from tidewire.spec import SEQUENCE, RunSpec
from tidewire.streaming.entities import STATE_STORE, left_in_state, stream_by_entity
from tidewire.streaming.progress import ProgressLog, release_samples
from tidewire.streaming.release import (
    Release,
    drain,
    released_rows,
    start_release,
    stream_resequence,
    stream_rolling_average,
)
from tidewire.workspace import materialise, names_in, new_path

#: Rows that one task writes into a file of a stream's source.
LANDED_AT_ONCE = 1_000_000


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw signals as a set of CSV files in event order, written by Spark."""
    path = new_path(spark, "csv")
    rows = raw_signals(spark, sf_dir).orderBy("event_id").drop("event_id")
    rows.write.option("escape", '"').csv(path, header=True)
    return path


def csv_spec(path: str) -> RunSpec:
    return RunSpec(
        dataset_path=path,
        columns=DECLARED,
        secret_key=FIXTURE_KEY,
        iterations=1,
        window=WINDOW,
        charts=CHARTS,
    )


def csv_run(spark: SparkSession, sf_dir: str, path: str | None = None) -> Run:
    """A run over the raw signals as CSV, written first unless ``path`` has them."""
    return run_pipeline(spark, csv_spec(path or raw_csv(spark, sf_dir)))


def q_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_run(spark, sf_dir).processed


def q_end_to_end_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_run(spark, sf_dir).quarantine


def q_end_to_end_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_run(spark, sf_dir).gaps


def q_end_to_end_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_run(spark, sf_dir).feed


def file_stream(df: DataFrame, files: int = 5) -> DataFrame:
    """Write numbered rows as files and stream those, one per micro-batch.

    Rows are spread over the files by hash, so every file leaves gaps for later ones to fill.
    """
    spark, source = df.sparkSession, new_path(df.sparkSession, "stream-source")
    # more files for more rows, so that no task writes more than some millions
    parts = max(files, df.count() // 4_000_000)
    df.repartition(parts, F.xxhash64(SEQUENCE)).write.parquet(source)
    reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", max(1, parts // files))
    return reader.parquet(source)


def numbered_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_sequence(signals(spark, sf_dir), "event_id", unique=True).drop("event_id")


def ended(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def released_stream(spark: SparkSession, rows: DataFrame) -> tuple[StreamingQuery, Release]:
    """Stream ``rows`` to their end: verified, put in order, averaged."""
    query, release = stream_rolling_average(
        verify_signatures(file_stream(rows), FIXTURE_KEY, 1, keep_flag=True),
        out=new_path(spark, "released"),
        state=new_path(spark, "state"),
        checkpoint=new_path(spark, "stream-checkpoint"),
        seq_col=SEQUENCE,
        value_col="metric_value",
        window=WINDOW,
        accepted_col="verified",
    )
    return ended(query), release


def q_stream_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, release = released_stream(spark, numbered_signals(spark, sf_dir))
    return released_rows(spark, release).drop("verified")


def q_stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some numbers never arrive: what the stream holds back at its end is drained across them."""
    rows = numbered_signals(spark, sf_dir).filter(F.col(SEQUENCE) % 400 != 77)
    query, release = released_stream(spark, rows)
    last = query.lastProgress["batchId"]
    return released_rows(spark, release).unionByName(drain(spark, release, last)).drop("verified")


def q_stream_resequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    query, release = stream_resequence(
        file_stream(numbered_signals(spark, sf_dir)),
        out=new_path(spark, "released"),
        state=new_path(spark, "state"),
        checkpoint=new_path(spark, "stream-checkpoint"),
        seq_col=SEQUENCE,
    )
    ended(query)
    return released_rows(spark, release)


def q_stream_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming filter and the streaming sink for processed rows."""
    stream = verify_signatures(file_stream(numbered_signals(spark, sf_dir)), FIXTURE_KEY, 1)
    out = new_path(spark, "verified")
    ended(write_processed(stream, out, checkpoint=new_path(spark, "stream-checkpoint")))
    return spark.read.schema(stream.schema).parquet(out)


def q_write_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows streamed into a chart feed that every micro-batch merges on."""
    verified = verify_signatures(numbered_signals(spark, sf_dir), FIXTURE_KEY, 1, route="native")
    processed = rolling_average(verified, SEQUENCE, "metric_value", WINDOW)
    out = new_path(spark, "feed")
    query = write_feed(
        file_stream(processed), out, CHARTS, checkpoint=new_path(spark, "stream-checkpoint")
    )
    return read_feed(spark, out, ended(query).lastProgress["batchId"])


def q_write_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = csv_run(spark, sf_dir).processed
    out = new_path(spark, "processed")
    write_processed(processed, out, mode="overwrite")
    return spark.read.schema(processed.schema).parquet(out)


def q_progress_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five micro-batches read and wrote, of a stream that keeps the rows with a right signature."""
    rows = numbered_signals(spark, sf_dir)
    with ProgressLog(spark, new_path(spark, "progress")) as log:
        stream = verify_signatures(landing(spark, rows), FIXTURE_KEY, 1)
        query = ended(write_processed(stream, new_path(spark, "passed"), checkpoint=new_path(spark, "stream-checkpoint")))
        return log.samples(query, capacity=10_000).select("sample", "stage", "size")


def torn_csv(spark: SparkSession, sf_dir: str, folder: bool = False) -> str:
    """CSV files written as plain text: lines with a cell too many behind a stray quote, and quotes left open."""
    path = new_path(spark, "torn-csv")
    row = F.col("event_id")
    surplus = F.when(row % 100 == 7, F.lit(',6" more')).otherwise(F.lit(""))
    opened = F.when(row % 200 == 9, F.lit('"')).otherwise(F.lit(""))
    rows = raw_signals(spark, sf_dir).select(
        F.when(row % 100 == 7, F.lit('5" x')).otherwise(F.lit("x")).alias("entity"),
        "epoch",
        F.concat(opened, F.lit("1.5")).alias("reading"),
        F.concat("signature", surplus).alias("signature"),
    )
    # one column, whose name is the header, parted and quoted by characters that no line has
    lines = rows.select(F.concat_ws(",", *rows.columns).alias(",".join(rows.columns)))
    lines.write.option("sep", "\u0001").option("quote", "\u0002").csv(f"{path}/part=0" if folder else path, header=True)
    return path


def q_stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files streamed two at a time, cast and cleaned on the way."""
    names = [c.source_name for c in DECLARED]
    stream = stream_csv(spark, raw_csv(spark, sf_dir), names, max_files=2)
    clean = ingest.clean_rows(ingest.cast_declared(stream, DECLARED), DECLARED)
    out = new_path(spark, "clean")
    ended(write_processed(clean, out, checkpoint=new_path(spark, "stream-checkpoint")))
    return ingest.rename_internal(spark.read.schema(clean.schema).parquet(out), DECLARED)


# ---- keyed state, and digests kept across batches -----------------------------------------------


def signals_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals with their number among those of their entity, from 1."""
    placed = add_sequence(signals(spark, sf_dir).drop("security_hash"), ["entity_name", "event_id"], "place", unique=True)
    placed = materialise(placed, "placed")
    first = placed.groupBy("entity_name").agg(F.min("place").alias("first"))
    return placed.join(first, "entity_name").withColumn("n", F.col("place") - F.col("first") + 1).drop("place", "first")


def streamed_by_entity(spark: SparkSession, rows: DataFrame) -> tuple[str, str]:
    """Where the ordered rows of a stream by entity are, and its checkpoint. Its three batches are files by hash."""
    name, store = STATE_STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    out, checkpoint = new_path(spark, "by-entity"), new_path(spark, "stream-checkpoint")
    source = new_path(spark, "by-entity-source")
    rows = materialise(rows, "by-entity-rows")
    each = max(1, -(-rows.count() // (3 * LANDED_AT_ONCE)))
    rows.repartition(3 * each, F.xxhash64("event_id")).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(source)
    try:
        ended(stream_by_entity(stream, out, checkpoint, "entity_name", "n", "metric_value", WINDOW))
    finally:
        spark.conf.set(name, before)
    return out, checkpoint


def q_stream_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = streamed_by_entity(spark, signals_by_entity(spark, sf_dir))
    rows = spark.read.parquet(out).filter("kind = 'row'")
    return rows.select("event_id", "entity_name", "computed_metric")


def q_stream_by_entity_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some numbers of each entity never come: what its state holds back at the end is read from it."""
    rows = signals_by_entity(spark, sf_dir).filter("n % 400 <> 77")
    out, checkpoint = streamed_by_entity(spark, rows)
    given = spark.read.parquet(out).filter("kind = 'row'")
    left = left_in_state(spark, checkpoint, "entity_name", "n", "metric_value", WINDOW)
    columns = ["event_id", "entity_name", "computed_metric"]
    return given.select(*columns).unionByName(left.select(*columns))


def q_stream_verify_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five micro-batches verified by a table of digests that grows by the salts not seen before."""
    table = DigestTable(new_path(spark, "digest-table"), FIXTURE_KEY, 1)
    rows, out = numbered_signals(spark, sf_dir), new_path(spark, "verified")
    ended(stream_verify(landing(spark, rows), table, out, new_path(spark, "stream-checkpoint")))
    return spark.read.option("recursiveFileLookup", True).schema(rows.schema).parquet(out)


# ---- the whole run as a stream ------------------------------------------------------------------


def landed_csv(spark: SparkSession, sf_dir: str, files: int = 5, most: int = LANDED_AT_ONCE) -> str:
    """The raw signals as CSV files that were written one after the other, in event order and in the order of paths.

    The files lie in folders, which are written one after the other. Folders of more than ``most`` rows hold several
    files, all of them equally many: a task writes no more than that, and a batch of so many files is a folder."""
    path = new_path(spark, "landed-csv")
    rows = materialise(raw_signals(spark, sf_dir), "raw-signals")
    low, high, n = rows.agg(F.min("event_id"), F.max("event_id"), F.count("*")).first()
    each = -(-n // (files * most))
    ends = [low + ((high - low) // files + 1) * (part + 1) - 1 for part in range(files)]
    if each > 1:
        shares = [(i + 1) / (files * each) for i in range(files * each)]
        found = rows.agg(F.percentile_approx("event_id", shares, 100 * len(shares))).first()[0]
        # each is the number of a row, and numbers are unique, so no file is empty
        ends = [*found[:-1], high]
    for part in range(0, len(ends), each):
        cuts, first = ends[part : part + each], ends[part - 1] + 1 if part else low
        mine = rows.filter(F.col("event_id").between(first, cuts[-1]))
        place = sum((F.col("event_id") > end).cast("int") for end in cuts)
        ordered = mine.repartitionById(each, place).sortWithinPartitions("event_id").drop("event_id")
        ordered.write.option("escape", '"').csv(f"{path}/part={part // each}", header=True)
    return path


def files_at_once(spark: SparkSession, path: str, batches: int = 5) -> int:
    """How many of the CSV files in the folders below ``path`` make a batch, so that there are no more than ``batches``."""
    folders = [f"{path}/{name}" for name in names_in(spark, path)]
    found = sum(name.endswith(".csv") for folder in folders for name in names_in(spark, folder))
    return max(1, -(-found // batches))


def streamed_run(spark: SparkSession, path: str, max_files: int | None = None) -> StreamRun:
    """A whole run over the CSV files in the folders below ``path``, to the stream's end: in five batches, unless the
    number of files in one is given."""
    max_files = max_files or files_at_once(spark, path)
    query, run = run_stream(
        spark, csv_spec(f"{path}/*"), new_path(spark, "run"), new_path(spark, "state"), new_path(spark, "stream-checkpoint"), max_files
    )
    ended(query)
    return run


def q_stream_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed_run(spark, landed_csv(spark, sf_dir)).table(spark, "processed")


def q_stream_end_to_end_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed_run(spark, landed_csv(spark, sf_dir)).table(spark, "quarantine")


def q_stream_end_to_end_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed_run(spark, landed_csv(spark, sf_dir)).table(spark, "feed")


def q_stream_add_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows with the numbers that five micro-batches gave them."""
    return streamed_run(spark, landed_csv(spark, sf_dir)).table(spark, "clean").drop("verified")


def q_stream_scan_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are cut or torn, told by a stream over them."""
    return streamed_run(spark, torn_csv(spark, sf_dir, folder=True)).errors(spark)


def q_stream_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines are accounted for: those with a fault by its kind, and the rest, whether before or after an open quote."""
    run = streamed_run(spark, torn_csv(spark, sf_dir, folder=True))
    faults = run.table(spark, "faults").select(F.when(F.col("code") != "AFTER_OPEN_QUOTE", F.col("code")).alias("code"))
    rest = run.table(spark, "clean").select(F.lit(None).cast("string").alias("code"))
    bad = run.table(spark, "quarantine").select(F.lit(None).cast("string").alias("code"))
    every = faults.unionByName(rest).unionByName(bad).groupBy("code").agg(F.count("*").alias("lines"))
    return every.select(F.coalesce("code", F.lit("NONE")).alias("code"), "lines")


# ---- micro-batches of known content -------------------------------------------------------------


def landing(spark: SparkSession, rows: DataFrame, most: int = LANDED_AT_ONCE) -> DataFrame:
    """A stream in five micro-batches: the rest of the number by five each; no number: the first.

    A batch is one file, or as many as it takes for none to have much more than ``most`` rows, the same for each batch."""
    source = new_path(spark, "landing")
    rest = F.coalesce(F.col(SEQUENCE) % 5, F.lit(0))
    stored = materialise(rows.withColumn("__part", rest), "landing-rows")
    each = max(1, -(-stored.count() // (5 * most)))
    for part in range(5):
        mine = stored.filter(F.col("__part") == part).drop("__part")
        # numbers within a task go up one by one, so no file stays empty that could have a row
        dealt = mine.coalesce(1) if each == 1 else mine.repartitionById(each, (F.monotonically_increasing_id() % each).cast("int"))
        # files are read in the order in which they were written
        dealt.write.mode("append").parquet(source)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(source)


def landed(spark: SparkSession, rows: DataFrame, gap_timeout: float | None = None) -> Release:
    """The stream of ``landing``, released. By the clock of the release its batches are three seconds apart."""
    clock = iter(range(0, 15, 3))
    release = Release(
        new_path(spark, "released"), new_path(spark, "state"), SEQUENCE, gap_timeout=gap_timeout, clock=lambda: float(next(clock))
    )
    ended(start_release(landing(spark, rows), release, new_path(spark, "stream-checkpoint")))
    return release


def q_stream_gap_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the second batch the gaps of the first have timed out."""
    return released_rows(spark, landed(spark, numbered_signals(spark, sf_dir), gap_timeout=2.0))


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return released_rows(spark, landed(spark, numbered_signals(spark, sf_dir), gap_timeout=2.0), "late")


def q_stream_no_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_signals(spark, sf_dir)
    number = F.when(F.col(SEQUENCE) % 50 != 7, F.col(SEQUENCE))
    return released_rows(spark, landed(spark, rows.withColumn(SEQUENCE, number)), "no_sequence")


def q_stream_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh row comes twice: the second is not released."""
    rows = numbered_signals(spark, sf_dir)
    return released_rows(spark, landed(spark, rows.union(rows.filter(F.col(SEQUENCE) % 11 == 3))), "repeated")


def q_stream_release_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    release = landed(spark, numbered_signals(spark, sf_dir), gap_timeout=2.0)
    return stage_health(release_samples(spark, release, capacity=10_000)).select("sample", "stage", "size")
