"""One whole run: scan, check, cast, number, verify, average."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import charts, health, ingest
from tidewire.operators.ordering import SOURCE_ORDER, KeySpread, find_gaps
from tidewire.operators.rolling import rolling_average
from tidewire.operators.staging import QUARANTINE, stage_scan
from tidewire.operators.verify import verify_signatures
from tidewire.sources.csv import line_errors, scan_csv, unreadable
from tidewire.spec import AVERAGE, DATA_TYPES, SEQUENCE, STAGES, RunSpec
from tidewire.workspace import free, materialise, new_path, recorded, small_frame

COUNTS = "loaded bigint, passed bigint, skipped bigint"
# Rows before the last points that are brought together for their windows, at most.
LONG_FEED = 1 << 14


class Run:
    """The tables of one run. ``errors`` has FATAL rows if and only if nothing was processed.

    The numbered, verified rows, the bad rows and the counts are there when a run is made; what follows from them
    (``processed``, ``gaps``, ``feed``) is prepared when it is first asked for."""

    def __init__(self, errors: DataFrame, made: dict[str, Callable[[], DataFrame]], paths: list[str]):
        self.errors = errors
        self._made = made
        self._paths = paths

    def _table(self, name: str) -> DataFrame:
        with recorded() as paths:
            made = self._made[name]()
        self._paths += paths
        return made

    @property
    def paths(self) -> tuple[str, ...]:
        return tuple(self._paths)

    @cached_property
    def processed(self) -> DataFrame:
        """Verified rows in their places, with the rolling mean."""
        return self._table("processed")

    @cached_property
    def quarantine(self) -> DataFrame:
        return self._table("quarantine")

    @cached_property
    def gaps(self) -> DataFrame:
        """Numbers whose row was not verified."""
        return self._table("gaps")

    @cached_property
    def summary(self) -> DataFrame:
        return self._table("summary")

    @cached_property
    def ingest(self) -> DataFrame:
        """Rows loaded, passed and skipped."""
        return self._table("ingest")

    @cached_property
    def status(self) -> DataFrame:
        return self._table("status")

    @cached_property
    def verification(self) -> DataFrame:
        """Rows verified and dropped."""
        return self._table("verification")

    @cached_property
    def feed(self) -> DataFrame:
        """The last points of the charts."""
        return self._table("feed")

    @cached_property
    def health(self) -> DataFrame:
        """How full each shown stage was, against the declared capacity."""
        return self._table("health")

    def free(self) -> None:
        """Delete the stored tables behind this run; its DataFrames cannot be read any more."""
        free(self.errors.sparkSession, self._paths)


def run_pipeline(spark: SparkSession, spec: RunSpec) -> Run:
    """Run ``spec`` over its CSV files, which are parsed once. The numbered, verified rows are stored and shared."""
    with recorded() as paths:
        return _run(spark, spec, paths)


def _run(spark: SparkSession, spec: RunSpec, paths: list[str]) -> Run:
    try:
        scanned = scan_csv(
            spark, spec.dataset_path, multiline=spec.multiline, source_order=True, ragged=True
        )
    except (AnalysisException, ValueError) as wrong:
        return _nothing(spark, spec, unreadable(spark, spec.dataset_path, wrong), paths)
    headers = scanned.drop(*SOURCE_ORDER, "__overlong", "__open", "__text")
    errors = ingest.check_columns(headers, spec.columns)
    missing = {c.source_name for c in spec.columns} - set(headers.columns)
    if missing:
        return _nothing(spark, spec, errors, paths)
    if spec.multiline:
        # a quote may stay open over lines there
        scanned = scanned.withColumn("__open", F.lit(False))
    staged = stage_scan(scanned, spec.columns, new_path(spark, "staged"), new_path(spark, "splits"))
    torn = (staged.counts["overlong"], staged.counts["open"])
    if any(torn):
        counts = small_frame(spark, [torn], "overlong bigint, open bigint")
        return _nothing(spark, spec, errors.unionByName(line_errors(counts)), paths)
    loaded, passed = staged.counts["loaded"], staged.counts["good"]
    flagged, verified_rows = flag_and_store(
        staged.good(), spec, new_path(spark, "verified")
    )
    verified = flagged.filter("verified").drop("verified")
    spread = KeySpread(1, passed, verified_rows) if verified_rows else None
    counts = small_frame(spark, [(loaded, passed, loaded - passed)], COUNTS)
    sizes = dict(zip(STAGES, (loaded, passed, verified_rows)))
    made = {
        "processed": lambda: rolling_average(verified, SEQUENCE, spec.value_col, spec.window, spread=spread),
        "quarantine": staged.quarantine,
        "gaps": lambda: find_gaps(verified, SEQUENCE, passed),
        "summary": lambda: small_frame(spark, [(verified_rows, True)], "processed bigint, complete boolean"),
        "ingest": lambda: counts,
        "status": lambda: _status(counts, 0),
        "verification": lambda: small_frame(
            spark, [(verified_rows, passed - verified_rows)], "verified bigint, dropped bigint"
        ),
        "feed": lambda: _last_points(verified, spec),
        "health": lambda: _health(spark, spec, sizes),
    }
    return Run(errors, made, paths)


def flag_and_store(
    rows: DataFrame, spec: RunSpec, path: str, verify: Callable[..., DataFrame] | None = None
) -> tuple[DataFrame, int]:
    """Store ``rows`` with their flag ``verified``, by ``verify`` or as a batch does it; and how many are."""
    spark, seen = rows.sparkSession, Observation()
    if verify is None:
        flagged = verify_signatures(
            rows, spec.secret_key, spec.iterations, spec.value_col, spec.signature_col, keep_flag=True
        )
    else:
        flagged = verify(rows)
    flagged.observe(seen, F.count_if("verified").alias("verified")).write.mode("overwrite").parquet(path)
    return spark.read.schema(flagged.schema).parquet(path), seen.get["verified"]


def _health(spark: SparkSession, spec: RunSpec, sizes: dict[str, int]) -> DataFrame:
    samples = [(0, stage, size, spec.queue_max_size) for stage, size in sizes.items()]
    return health.stage_health(small_frame(spark, samples, health.SAMPLES), spec.show)


def _last_points(verified: DataFrame, spec: RunSpec, n: int = charts.POINTS) -> DataFrame:
    """The chart feed, worked out from the last rows alone: ``n`` of them and one window before, unless that is long."""
    if spec.window > LONG_FEED:
        averaged = rolling_average(verified, SEQUENCE, spec.value_col, spec.window)
        return charts.chart_feed(materialise(averaged, "averaged"), spec.charts, n)
    last = verified.orderBy(F.desc(SEQUENCE)).limit(n + spec.window - 1)
    averaged = rolling_average(last, SEQUENCE, spec.value_col, spec.window)
    return charts.chart_feed(averaged, spec.charts, n)


def _status(counts: DataFrame, fatal: int) -> DataFrame:
    skipped = F.col("skipped")
    return counts.select(
        F.when(F.lit(fatal) > 0, "RED").when(skipped > 0, "AMBER").otherwise("GREEN").alias("status"),
        F.lit(fatal).cast("bigint").alias("fatal"),
        "skipped",
        F.lit(fatal == 0).alias("may_run"),
    )


def _nothing(spark: SparkSession, spec: RunSpec, errors: DataFrame, paths: list[str]) -> Run:
    """The tables of a run that must not start: all empty but for the errors."""
    processed = small_frame(spark, [], processed_schema(spec))
    counts = small_frame(spark, [(0, 0, 0)], COUNTS)
    made = {
        "processed": lambda: processed,
        "quarantine": lambda: small_frame(spark, [], QUARANTINE),
        "gaps": lambda: small_frame(spark, [], "missing bigint"),
        "summary": lambda: health.pipeline_summary(processed, complete=False),
        "ingest": lambda: counts,
        "status": lambda: _status(counts, errors.filter("severity = 'FATAL'").count()),
        "verification": lambda: small_frame(spark, [(0, 0)], "verified bigint, dropped bigint"),
        "feed": lambda: charts.place_points(small_frame(spark, [], charts.POINTS_SCHEMA)),
        "health": lambda: _health(spark, spec, dict.fromkeys(STAGES, 0)),
    }
    return Run(errors, made, paths)


def processed_schema(spec: RunSpec) -> str:
    declared = [(c.internal_mapping, DATA_TYPES[c.data_type]) for c in spec.columns]
    named = [(SEQUENCE, "bigint"), *declared, (AVERAGE, "double")]
    return ", ".join(f"`{name}` {kind}" for name, kind in named)
