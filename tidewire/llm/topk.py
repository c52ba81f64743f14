"""Exact top-k search by distributed selection over score histograms.

Every query row meets every candidate row, in blocks. A round counts, per query, how many scores fall into
each bin of the range that holds its k-th greatest score, finds the bin, and takes that for the next
round's range, until a bin is a single score. That score is the query's threshold. A last pass keeps the
scores above it and, of those equal to it, the least candidate ids that are still wanted.

A task need not report bins below its own k-th score: the k-th of all is not lower. So a query costs at
most k bins per task and round, however many candidates share a score. Query blocks are repeated once per
candidate block, and a block pair is all that a task holds.

Components become whole numbers floor(scale * x), scores are whole numbers (beyond 64 bits they are held at
the limits). A row with a null id, a null vector, or a component that is null or not finite takes no part; nor do
vectors of another length than the query's. Rows with the query's id are its own and no candidates of
it. A repeated query row is answered once; a candidate id that is repeated counts once for each row. Fewer
candidates than k give fewer rows. Ties go to the smaller candidate id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import map_batches, with_columns
from tidewire.workspace import materialise

#: Rows in a block of candidates, and of queries.
BLOCK, QUERIES = 2048, 1024
#: Bytes of all queries (of their blocks) that are broadcast.
BROADCAST_BYTES = 64 << 20
#: Bins of a round, as a power of two, at most.
BITS = 11

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


# ---- blocks -------------------------------------------------------------------------------------


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Id and vector of whole numbers (as doubles) for the rows that take part."""
    numbers = F.col(vector_col).cast("array<double>")
    fit = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.filter(F.col(id_col).isNotNull() & numbers.isNotNull() & fit)
    return good.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(numbers, lambda x: _floor(x * F.lit(float(scale)))).alias("v"),
    )


def _floor(x: Column) -> Column:
    """The floor as a double; from 2^52 on every double is whole."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows put together, ``size`` at most: block number, vector length, ids, matrix."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            begins = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                for at in range(0, len(rows), size):
                    some = rows[at : at + size]
                    matrix = flat[begins[some][:, None] + np.arange(length)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "length": pa.array([int(length)], pa.int32()),
                            "greatest": pa.array([float(np.abs(matrix).max(initial=0))]),
                            "ids": pa.array([ids[some].tobytes()], pa.binary()),
                            "matrix": pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary()),
                        }
                    )

    packed = map_batches(vectors, pack, "length int, greatest double, ids binary, matrix binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def score_bits(greatest: float, length: int) -> int:
    """Bits that hold every score of vectors of that greatest component and length, sign included."""
    return min(64, (int(greatest) ** 2 * length).bit_length() + 1)


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held at the limits of 64 bits."""
    top = max(np.abs(queries).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1) * max(rows.shape[1], 1)
    if top < 1 << 53:
        return (queries @ rows.T).astype(np.int64)
    if top < 1 << 62:
        return queries.astype(np.int64) @ rows.T.astype(np.int64)
    exact = np.array([[sum(int(a) * int(b) for a, b in zip(q, r)) for r in rows] for q in queries], object)
    return np.clip(exact, _LOW, _HIGH).astype(np.int64).reshape(len(queries), len(rows))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block pair: its row, the scores, the candidate ids, the mask of the queries' own rows."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: column[at].as_py() for name, column in zip(batch.schema.names, batch.columns)}
            ids, asked = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["query_ids"], np.int64)
            rows = np.frombuffer(row["matrix"]).reshape(len(ids), row["length"])
            queries = np.frombuffer(row["query_matrix"]).reshape(len(asked), row["length"])
            yield row, inner_products(queries, rows), ids, asked[:, None] == ids[None, :]


# ---- rounds -------------------------------------------------------------------------------------


def _bins(pairs: DataFrame, shift: int, width: int, k: int) -> DataFrame:
    """Per query and bin (score >> shift) within the query's range: how many scores, from the highest bin down to
    the task's k-th score. The range is the bin of the round before, ``width`` bits wider."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, scores, _, own in _scored(batches):
            bins = scores >> shift
            inside = ~own
            if row["bounds"] is not None:
                inside &= (bins >> width) == np.frombuffer(row["bounds"], np.int64)[:, None]
            if bins.shape[1] > k:
                held = np.where(inside, bins, _LOW)
                inside &= bins >= np.partition(held, -k, axis=1)[:, -k, None]
            numbers, columns = np.nonzero(inside)
            found = bins[numbers, columns]
            order = np.lexsort((found, numbers))
            numbers, found = numbers[order], found[order]
            new = np.ones(len(found), bool)
            new[1:] = (numbers[1:] != numbers[:-1]) | (found[1:] != found[:-1])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_pydict(
                {
                    "query_block": pa.array(np.full(len(at), row["query_block"], np.int64)),
                    "number": pa.array(numbers[at].astype(np.int32)),
                    "bin": pa.array(found[at]),
                    "n": pa.array(np.diff(np.append(at, len(found)))),
                }
            )

    counted = map_batches(pairs, count, "query_block bigint, number int, bin bigint, n bigint")
    return counted.groupBy("query_block", "number", "bin").agg(F.sum("n").alias("n"))


def _located(bins: DataFrame, wanted: DataFrame | None, k: int) -> DataFrame:
    """Per query the bin with its k-th score and how many are still wanted from it (with too few scores, the last bin)."""
    keys = ["query_block", "number"]
    known = bins.withColumn("want", F.lit(k).cast("bigint")) if wanted is None else bins.join(wanted.drop("bin"), keys)
    # a query has k bins per task at most
    above = Window.partitionBy(*keys).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    lowest = Window.partitionBy(*keys)
    return (
        known.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
        .filter("above < want")
        .withColumn("last", F.min("bin").over(lowest))
        .filter("bin = last")
        .select(*keys, "bin", (F.col("want") - F.col("above")).alias("want"))
    )


def _with_bounds(queries: DataFrame, located: DataFrame) -> DataFrame:
    """Query blocks with the bins of their queries in order, and how many are wanted from each."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, wants = [], []
            for ids, found in zip(batch.column("query_ids").to_pylist(), batch.column("found").to_pylist()):
                bins, want = np.zeros(len(ids) // 8, np.int64), np.zeros(len(ids) // 8, np.int64)
                for x in found or []:
                    bins[x["number"]], want[x["number"]] = x["bin"], x["want"]
                bounds.append(bins.tobytes())
                wants.append(want.tobytes())
            added = {"bounds": pa.array(bounds, pa.binary()), "wants": pa.array(wants, pa.binary())}
            yield with_columns(batch.select(batch.schema.names[:-1]), added)

    # a block has QUERIES rows at most
    lists = located.groupBy("query_block").agg(F.collect_list(F.struct("number", "bin", "want")).alias("found"))
    joined = queries.join(lists, "query_block", "left")
    schema = "length int, query_block bigint, query_ids binary, query_matrix binary, bounds binary, wants binary"
    ordered = joined.select("length", "query_block", "query_ids", "query_matrix", "found")
    return map_batches(ordered, fill, schema)


def _answers(pairs: DataFrame, k: int) -> DataFrame:
    """The rows above each query's threshold, and the least ids at it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, scores, ids, own in _scored(batches):
            limits, wants = (np.frombuffer(row[c], np.int64) for c in ("bounds", "wants"))
            numbers, columns = np.nonzero(~own & (scores >= limits[:, None]) & (wants[:, None] > 0))
            values, names = scores[numbers, columns], ids[columns]
            order = np.lexsort((names, -values, numbers))
            numbers, values, names = numbers[order], values[order], names[order]
            # place among the ties of a query; the scores above the threshold are fewer than k
            tied = values == limits[numbers]
            new = np.ones(len(tied), bool)
            new[1:] = (numbers[1:] != numbers[:-1]) | (tied[1:] != tied[:-1])
            first = np.flatnonzero(new)
            place = np.arange(len(tied)) - np.repeat(first, np.diff(np.append(first, len(tied))))
            some = ~tied | (place < wants[numbers])
            yield pa.RecordBatch.from_pydict(
                {
                    "query_block": pa.array(np.full(int(some.sum()), row["query_block"], np.int64)),
                    "number": pa.array(numbers[some].astype(np.int32)),
                    "query_id": pa.array(np.frombuffer(row["query_ids"], np.int64)[numbers[some]]),
                    "vec_id": pa.array(names[some]),
                    "score": pa.array(values[some]),
                }
            )

    schema = "query_block bigint, number int, query_id bigint, vec_id bigint, score bigint"
    order = Window.partitionBy("query_block", "number").orderBy(F.desc("score"), "vec_id")
    ranked = map_batches(pairs, keep, schema).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``queries`` its ``k`` greatest scores among ``rows``: query_id, rank (from 1), vec_id, score.

    Queries of up to ``broadcast_bytes`` (counted) are sent to every task; more are met by a shuffle."""
    if k < 1:
        raise ValueError("k must be 1 at least")
    candidates = materialise(_blocks(whole_vectors(rows, id_col, vector_col, scale), BLOCK), "topk-rows")
    asked = _blocks(whole_vectors(queries, id_col, vector_col, scale).distinct(), QUERIES)
    names = {"block": "query_block", "ids": "query_ids", "matrix": "query_matrix"}
    asked = materialise(asked.withColumnsRenamed(names).drop("greatest"), "topk-queries")
    seen = candidates.agg(F.count("*"), F.max("greatest"), F.max("length")).first()
    slots, bits = max(seen[0], 1), score_bits(seen[1] or 0.0, seen[2] or 0)
    # a slot holds about one block of candidates
    placed = candidates.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int")).drop("block", "greatest")

    spark = rows.sparkSession
    tasks = 2 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked_bytes = asked.agg(F.sum(F.octet_length("query_matrix").cast("bigint"))).first()[0] or 0

    def pairs(state: DataFrame) -> DataFrame:
        """Each block of queries with every block of candidates of its vector length."""
        if asked_bytes <= broadcast_bytes:
            # all of them to every task, once; a block of candidates meets them there
            return placed.repartition(min(slots, tasks), "slot").drop("slot").join(F.broadcast(state), "length")
        # a copy per slot: never to be broadcast, however small it was before it was copied
        repeated = state.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        return repeated.hint("merge").join(placed.hint("merge"), ["slot", "length"])

    rounds = -(-bits // BITS)
    width = -(-bits // rounds)
    nothing = F.lit(None).cast("binary")
    state, wanted = asked.withColumn("bounds", nothing).withColumn("wants", nothing), None
    for left in reversed(range(rounds)):
        bins = _bins(pairs(state), left * width, width, k)
        wanted = materialise(_located(bins, wanted, k), "topk-bins")
        state = _with_bounds(asked, wanted)
    return _answers(pairs(state), k)
