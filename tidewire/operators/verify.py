"""Keep the rows whose keyed signature fits their value."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.functions.digest import DIGEST_TEXT, digest_udf, native_digest
from tidewire.functions.text import two_decimals
from tidewire.spec import whole_number
from tidewire.workspace import get_text, materialise, put_text, small_frame

# A digest row takes about 150 bytes in a broadcast relation, so this bounds it at about 75 MB.
BROADCAST_DIGESTS = 500_000
# A salt is hot above this many rows and 1/500,000 of all: at most BROADCAST_DIGESTS are, however large the data,
# and a cold one is a small part of a task.
HOT_ROWS = 100_000
SPREAD = 65_536

ROUTES = ("auto", "native", "udf", "table")


def verify_signatures(
    df: DataFrame,
    key: str,
    iterations: int,
    value_col: str = "metric_value",
    signature_col: str = "security_hash",
    keep_flag: bool = False,
    route: str = "auto",
    broadcast_digests: int = BROADCAST_DIGESTS,
) -> DataFrame:
    """Rows whose signature is the PBKDF2-HMAC-SHA256 of their value's two-decimal text.

    With ``keep_flag`` all rows stay and a boolean ``verified`` is added. Routes:

    * ``table``: hash each distinct salt once, in parallel, store the digests, join them back.
      The choice for batch input, as one digest may take tens of milliseconds.
    * ``udf``: hash within the row stream (one hash per distinct salt of a worker's cache).
      The choice for streaming input.
    * ``native``: one iteration only, as a built-in expression. Its plan shows the key blocks, so
      it is used only when asked for.
    """
    whole_number("iterations", iterations)
    if route not in ROUTES:
        raise ValueError(f"route must be one of {ROUTES}")
    if route == "native" and iterations != 1:
        raise ValueError("the native route computes exactly one iteration")
    if route == "auto":
        route = "udf" if df.isStreaming else "table"
    value, signature = F.col(value_col), F.col(signature_col)
    if route == "native":
        flagged = df.withColumn(
            "verified", F.coalesce(native_digest(value, key) == signature, F.lit(False))
        )
    elif route == "udf":
        # a text that is no digest cannot match: its row skips the hash
        salt = F.when(signature.rlike(DIGEST_TEXT), two_decimals(value))
        digest = digest_udf(key, iterations)(salt)
        flagged = df.withColumn("verified", F.coalesce(digest == signature, F.lit(False)))
    else:
        flagged = _through_table(df, key, iterations, value, signature, broadcast_digests)
    return flagged if keep_flag else flagged.filter("verified").drop("verified")


def _through_table(df, key, iterations, value, signature, broadcast_digests):
    keyed, counted = _salted(df, value, signature)
    return _looked_up(df, keyed, _hashed(counted, key, iterations), signature, broadcast_digests)


def _salted(df: DataFrame, value, signature) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``__salt``, and how many rows have each."""
    keyed = df.withColumn("__salt", F.when(signature.rlike(DIGEST_TEXT), two_decimals(value)))
    # map-side counting first: a salt shared by many rows leaves each task once
    counted = keyed.select("__salt").filter("__salt is not null").groupBy("__salt").agg(F.count("*").alias("__rows"))
    return keyed, counted


def _hashed(counted: DataFrame, key: str, iterations: int) -> DataFrame:
    spark = counted.sparkSession
    # hashing costs CPU, not bytes: spread it over all cores, which size-based coalescing would not
    tasks = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return counted.repartition(tasks, "__salt").withColumn("__digest", digest_udf(key, iterations)(F.col("__salt")))


def _looked_up(df: DataFrame, keyed: DataFrame, digests: DataFrame, signature, broadcast_digests: int) -> DataFrame:
    """``df`` with ``verified``, by ``digests`` (``__salt``, ``__rows``, ``__digest``), which are stored and counted."""
    seen = Observation()
    digests = materialise(
        digests.observe(seen, F.count("*").alias("salts"), F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows")), "digests"
    )
    salts, rows = seen.get["salts"], seen.get["rows"]
    if salts <= broadcast_digests:
        joined = keyed.join(
            F.broadcast(digests.select("__salt", "__digest")), "__salt", "left"
        ).withColumn("__found", F.col("__digest"))
    else:
        joined = _wide_join(keyed, digests, rows)
    return joined.withColumn(
        "verified", F.coalesce(F.col("__found") == signature, F.lit(False))
    ).select(*df.columns, "verified")


@dataclass(frozen=True)
class DigestTable:
    """Digests kept below ``path`` from batch to batch: a salt is hashed once, by one worker, however often it comes.

    Each batch adds its new salts in a folder of its own, so a batch that is run again replaces only those. A table
    belongs to one key and number of iterations; a digest of a fixed text, kept beside it, tells them from others.
    """

    path: str
    key: str = field(repr=False)
    iterations: int

    def verify(
        self,
        batch: DataFrame,
        batch_id: int,
        value_col: str = "metric_value",
        signature_col: str = "security_hash",
        keep_flag: bool = False,
        broadcast_digests: int = BROADCAST_DIGESTS,
    ) -> DataFrame:
        """As ``verify_signatures``, for one micro-batch."""
        spark = batch.sparkSession
        self._own(spark)
        value, signature = F.col(value_col), F.col(signature_col)
        keyed, counted = _salted(batch, value, signature)
        counted = materialise(counted, "salts")
        known = self.digests(spark, batch_id - 1)
        new = counted.join(known, "__salt", "left_anti").select("__salt")
        _hashed(new, self.key, self.iterations).write.mode("overwrite").parquet(self._folder(batch_id))
        # of the table only what the batch needs
        needed = counted.join(self.digests(spark, batch_id), "__salt")
        flagged = _looked_up(batch, keyed, needed, signature, broadcast_digests)
        return flagged if keep_flag else flagged.filter("verified").drop("verified")

    def digests(self, spark: SparkSession, upto: int) -> DataFrame:
        """``__salt`` and ``__digest`` of all batches up to ``upto``."""
        kept = "__salt string, __digest string"
        if upto < 0:
            return small_frame(spark, [], kept)
        stored = spark.read.schema(f"{kept}, __batch int").parquet(f"{self.path}/digests")
        return stored.filter(F.col("__batch") <= upto).drop("__batch")

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/digests/__batch={batch_id}"

    def _own(self, spark: SparkSession) -> None:
        probe = hashlib.pbkdf2_hmac("sha256", self.key.encode(), b"whose table this is", self.iterations).hex()
        kept = get_text(spark, f"{self.path}/owner")
        if kept is None:
            put_text(spark, f"{self.path}/owner", probe)
        elif kept != probe:
            raise ValueError(f"the digests in {self.path} are of another key or number of iterations")


def stream_verify(
    sdf: DataFrame, table: DigestTable, out: str, checkpoint: str, every: str | None = None, **kw
) -> StreamingQuery:
    """Write the rows of a stream whose signature is right, a folder per batch, by a table of digests that grows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # the batch is read for its salts and for its rows
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            table.verify(batch, batch_id, **kw).write.mode("overwrite").parquet(f"{out}/__batch={batch_id}")
        finally:
            batch.unpersist()

    pace = {"processingTime": every} if every else {"availableNow": True}
    return sdf.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**pace).start()


def _wide_join(keyed: DataFrame, digests: DataFrame, rows: int) -> DataFrame:
    """Shuffle join that sends no hot salt to one task.

    Hot salts (at most ``BROADCAST_DIGESTS`` of them) find their digest by broadcast; in the shuffle join
    their rows carry a made-up key that spreads them evenly and meets no digest.
    """
    hot = digests.filter(F.col("__rows") > max(HOT_ROWS, rows // BROADCAST_DIGESTS)).select(
        "__salt", F.col("__digest").alias("__hot")
    )
    spread = F.concat(
        F.lit("hot "),
        F.pmod(F.xxhash64(*keyed.columns, F.spark_partition_id()), F.lit(SPREAD)).cast("string"),
    )
    marked = (
        keyed.join(F.broadcast(hot), "__salt", "left")
        .withColumn("__key", F.when(F.col("__hot").isNull(), F.col("__salt")).otherwise(spread))
        # rows without a salt would meet at the NULL key
        .withColumn("__key", F.coalesce("__key", spread))
    )
    cold = digests.select(F.col("__salt").alias("__key"), "__digest")
    return marked.join(cold, "__key", "left").withColumn(
        "__found", F.coalesce("__hot", "__digest")
    )


def verification_summary(flagged_df: DataFrame, by: str) -> DataFrame:
    """Verified and dropped rows per value of ``by``."""
    return flagged_df.groupBy(by).agg(
        F.count_if("verified").alias("verified"), F.count_if(~F.col("verified")).alias("dropped")
    )
