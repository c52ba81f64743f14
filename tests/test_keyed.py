"""Sequences by entity in keyed state, what is left in it, and digests kept across batches."""

import random
import time
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F
from tidewire.functions.digest import digest_udf
from tidewire.functions.text import two_decimals
from tidewire.operators.verify import DigestTable, stream_verify, verify_signatures
from tidewire.streaming.entities import STATE_STORE, by_entity, left_in_state, stream_by_entity

SCHEMA = "who string, seq long, v double, ok boolean"


@pytest.fixture
def keyed_state(spark):
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    yield
    spark.conf.set(STATE_STORE[0], before)


def streamed(spark, folder, batches):
    source = folder("source")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)


def by_hand(rows, window):
    """(who, seq, mean) of accepted rows, per entity."""
    last, out = defaultdict(lambda: deque(maxlen=window)), []
    for who, seq, v, ok in sorted(rows):
        if ok:
            last[who].append(v)
            out.append((who, seq, round(sum(last[who]) / len(last[who]), 4)))
    return out


def test_order_repeats_and_what_is_left(spark, folder, keyed_state):
    rnd = random.Random(6)
    rows = [(who, n, rnd.randrange(1000) / 4, rnd.random() < 0.8) for who in "abc" for n in range(1, 61)]
    came = [r for r in rows if not (r[0] == "b" and r[1] == 31)]
    mixed = sorted(came, key=lambda r: r[1] + rnd.random() * 25)
    batches = [mixed[i : i + 60] for i in range(0, len(mixed), 60)]
    again, odd = [r for r in batches[0] if r[1] < 20][:5], [("a", None, 1.0, True)]
    waits = [("b", 55, 9.0, True)] * 2
    out, cp = folder("out"), folder("cp")
    query = stream_by_entity(
        streamed(spark, folder, [*batches, again + odd, waits]), out, cp, "who", "seq", "v", 4, accepted_col="ok"
    )
    query.awaitTermination()
    done = spark.read.parquet(out)
    given = sorted((r.who, r.seq, r.computed_metric) for r in done.filter("kind = 'row'").collect())
    want = by_hand(came, 4)
    assert given == [w for w in want if w[0] != "b" or w[1] < 31]
    others = sorted((r.kind, r.who, r.seq or 0) for r in done.filter("kind <> 'row'").collect())
    assert others == sorted(
        [("late", r[0], r[1]) for r in again] + [("no_sequence", "a", 0)] + [("repeated", "b", 55)] * 2
    )
    left = left_in_state(spark, cp, "who", "seq", "v", 4, "ok")
    assert sorted((r.who, r.seq, r.computed_metric) for r in left.collect()) == [w for w in want if w[0] == "b" and w[1] > 31]


def test_a_timer_passes_a_gap_while_nothing_comes(spark, folder, keyed_state):
    rows = [("a", 1, 1.0, True), ("a", 3, 3.0, True), ("a", 4, 5.0, True), ("b", 1, 1.0, True)]
    out, cp = folder("out"), folder("cp")
    query = stream_by_entity(
        streamed(spark, folder, [rows]), out, cp, "who", "seq", "v", 2, gap_timeout=1.0, every="1 second"
    )
    try:
        deadline, found = time.time() + 120, []
        while time.time() < deadline and len(found) < 4:
            time.sleep(1)
            assert query.exception() is None
            if query.recentProgress:
                found = spark.read.parquet(out).collect() if query.lastProgress["batchId"] > 0 else []
    finally:
        query.stop()
    assert sorted((r.who, r.seq, r.computed_metric) for r in found) == [("a", 1, 1.0), ("a", 3, 2.0), ("a", 4, 4.0), ("b", 1, 1.0)]


def test_rows_wait_in_pieces_of_many(spark, folder, keyed_state):
    """Rows that wait take a few entries of the state, not one each; and sequences over several chunks come out whole."""
    rows = [(who, n, n % 50 / 4, n % 3 > 0) for who in "ab" for n in range(1, 9_001) if (who, n) != ("b", 4_200)]
    random.Random(5).shuffle(rows)
    again = [("a", 9_000, 0.0, True), ("b", 9_000, 0.0, True), ("b", 4_199, 0.0, True)]
    out, cp = folder("out"), folder("cp")
    batches = [rows[:6_000], rows[6_000:12_000], rows[12_000:], again]
    stream_by_entity(streamed(spark, folder, batches), out, cp, "who", "seq", "v", 4, accepted_col="ok").awaitTermination()
    done = spark.read.parquet(out)
    want = by_hand(rows, 4)
    given = sorted((r.who, r.seq, r.computed_metric) for r in done.filter("kind = 'row'").collect())
    assert given == [w for w in want if w[0] == "a" or w[1] < 4_200]
    others = sorted((r.kind, r.who, r.seq) for r in done.filter("kind <> 'row'").collect())
    assert others == [("late", "a", 9_000), ("late", "b", 4_199), ("repeated", "b", 9_000)]
    left = left_in_state(spark, cp, "who", "seq", "v", 4, "ok")
    assert sorted((r.who, r.seq, r.computed_metric) for r in left.collect()) == [w for w in want if w[0] == "b" and w[1] > 4_200]
    entries = spark.read.format("statestore").option("path", cp).option("stateVarName", "waiting").load()
    assert 0 < entries.count() <= 12


def test_settings_are_checked(spark, folder, keyed_state):
    stream = streamed(spark, folder, [[("a", 1, 1.0, True)]])
    with pytest.raises(ValueError):
        by_entity(stream, "who", "seq", "v", 0)
    with pytest.raises(ValueError):
        by_entity(stream, "who", "seq", "v", 1, gap_timeout=-1)
    spark.conf.set(STATE_STORE[0], "some.other.Provider")
    with pytest.raises(ValueError, match="RocksDB"):
        by_entity(stream, "who", "seq", "v", 1)


def signed(spark, low, high, iterations=20):
    values = spark.range(low, high).select("id", (F.col("id") % 40 / 8).alias("metric_value"))
    digest = digest_udf("k", iterations)(two_decimals(F.col("metric_value")))
    return values.select("*", F.when(F.col("id") % 5 != 1, digest).otherwise("no").alias("security_hash"))


def test_each_salt_is_hashed_once(spark, folder):
    """Two hundred rows of twenty salts, then more of the same with twenty others, then nothing new."""
    first = signed(spark, 0, 200).filter("id % 40 < 20")
    second = signed(spark, 200, 400)
    table = DigestTable(folder("table"), "k", 20)

    def hashed():
        kept = spark.read.parquet(f"{table.path}/digests")
        return {r["__batch"]: r.n for r in kept.groupBy("__batch").agg(F.count("*").alias("n")).collect()}

    assert table.verify(first, 0).count() == first.filter("security_hash <> 'no'").count()
    known = first.filter("security_hash <> 'no'").select("metric_value").distinct().count()
    assert hashed() == {0: known}
    every = second.filter("security_hash <> 'no'").select("metric_value").distinct().count()
    assert table.verify(second, 1).count() == second.filter("security_hash <> 'no'").count()
    assert hashed() == {0: known, 1: every - known}
    # a batch that is run again, and one that brings nothing new
    assert table.verify(second, 1, keep_flag=True).filter("verified").count() == second.filter("security_hash <> 'no'").count()
    assert table.verify(first, 2, broadcast_digests=0).count() == first.filter("security_hash <> 'no'").count()
    assert hashed() == {0: known, 1: every - known}
    with pytest.raises(ValueError):
        DigestTable(table.path, "other", 20).verify(first, 3)
    assert "key=" not in repr(table)


def test_a_stream_with_a_table_of_digests(spark, folder):
    rows = signed(spark, 0, 300)
    source, out = folder("source"), folder("out")
    rows.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream_verify(stream, DigestTable(folder("table"), "k", 20), out, folder("cp"))
    query.awaitTermination()
    got = spark.read.option("recursiveFileLookup", True).parquet(out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, verify_signatures(rows, "k", 20).collect()))
