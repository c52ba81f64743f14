"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tidewire.functions.digest import digest_udf
from tidewire.functions.text import two_decimals
from tidewire.operators.verify import verify_signatures
from tidewire.plans import catalogue, live
from tidewire.plans.views import FIXTURE_KEY, events
from tidewire.session import local_session
from tidewire.workspace import materialise

HEADLINES = (
    "flagship",
    "cast_declared",
    "quarantine_rows",
    "ingest_summary",
    "scan_csv",
    "add_sequence",
    "verify_signatures",
    "verify_signatures_table",
    "verification_summary",
    "find_gaps",
    "gap_ranges",
    "reject_stale",
    "rolling_average_w100",
    "rolling_average_w5000",
    "rolling_average_by_entity",
    "chart_feed",
    "stage_health",
    "end_to_end",
    "stream_rolling_average",
    "stream_end_to_end",
)

#: Iterations per digest for the digest rate.
ITERATIONS = 1000


def timed(df) -> float:
    began = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = catalogue.queries()
    # what is read is written before the clock starts
    path = live.raw_csv(spark, sf_dir)
    landed = live.landed_csv(spark, sf_dir)
    signed = materialise(catalogue.signed_twice(spark, sf_dir), "signed")
    queries |= {
        "scan_csv": lambda s, d: catalogue.scanned(s, path),
        "end_to_end": lambda s, d: live.csv_run(s, d, path).processed,
        "stream_end_to_end": lambda s, d: live.streamed_run(s, landed).table(s, "processed"),
        "verify_signatures_table": lambda s, d: verify_signatures(signed, FIXTURE_KEY, 2),
    }
    # start-up of the JVM and of the Python workers is not what is measured
    for name in ("flagship", "verify_signatures_table"):
        timed(lambda: queries[name](spark, sf_dir))
    seconds = {name: timed(lambda: queries[name](spark, sf_dir)) for name in HEADLINES}
    salts = materialise(events(spark, sf_dir).select(two_decimals(F.col("value")).alias("salt")).distinct(), "salts")
    spread = salts.repartition(4 * spark.sparkContext.defaultParallelism)
    hashing = timed(lambda: spread.select(digest_udf(FIXTURE_KEY, ITERATIONS)("salt").alias("digest")))
    rate = round(salts.count() / hashing)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, fixtures written before",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "digests_per_second": rate,
                "digest_iterations": ITERATIONS,
            }
        )
    )


if __name__ == "__main__":
    main()
