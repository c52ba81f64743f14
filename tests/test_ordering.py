"""Numbering, gaps and late rows against brute force, whatever the partitioning."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from tidewire.operators.ordering import (
    add_sequence,
    cut_in_buckets,
    find_gaps,
    first_missing,
    gap_ranges,
    flag_stale,
    reject_stale,
    resequence,
)


def numbers(spark, values, parts=5):
    return spark.createDataFrame([(v,) for v in values], "seq long").repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_dense_numbers(spark, parts):
    values = [i * i for i in range(3000)]
    out = add_sequence(numbers(spark, values, parts), "seq", "n", unique=True)
    assert out.columns == ["n", "seq"]
    assert sorted((r.n, r.seq) for r in out.collect()) == list(enumerate(values, 1))


def test_ties_of_a_hot_key_are_split(spark):
    """A third of the rows share the order key, some of them are exact copies."""
    rows = [(0 if i % 3 else i, i % 50) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, x long").repartition(6)
    out = add_sequence(df, "k", "n", start=0)
    got = out.orderBy("n").collect()
    assert [r.n for r in got] == list(range(6000))
    assert [r.k for r in got] == sorted(k for k, _ in rows)
    assert sorted((r.k, r.x) for r in got) == sorted(rows)


def test_name_taken(spark):
    with pytest.raises(ValueError):
        add_sequence(numbers(spark, [1]), "seq", "seq")


def test_no_rows(spark):
    empty = spark.createDataFrame([], "seq long, arrival double")
    assert add_sequence(empty, "seq").count() == 0
    assert find_gaps(empty, "seq").count() == 0
    assert flag_stale(empty, "seq", "arrival").count() == 0
    assert cut_in_buckets(empty, "seq") is None


def test_rows_without_a_key_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0)], "seq long, arrival double")
    for refused in (
        lambda: add_sequence(df, "seq", "n", unique=True),
        lambda: flag_stale(df, "seq", "arrival"),
        lambda: cut_in_buckets(df, "seq"),
    ):
        with pytest.raises(ValueError, match="NULL"):
            refused()


@pytest.mark.parametrize("unique", [True, False])
def test_extreme_and_negative_keys(spark, unique):
    values = [-(2**63), -5, -1, 0, 7, 2**63 - 1]
    out = add_sequence(numbers(spark, values), "seq", "n", unique=unique)
    assert sorted((r.n, r.seq) for r in out.collect()) == list(enumerate(values, 1))


def test_resequence(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    assert [r.seq for r in resequence(numbers(spark, values), "seq").collect()] == sorted(values)


def missing(df, **kw):
    return sorted(r.missing for r in find_gaps(df, "seq", **kw).collect())


def test_gaps_small(spark):
    assert missing(numbers(spark, [1, 2, 5, 9])) == [3, 4, 6, 7, 8]
    assert missing(numbers(spark, [1, 2]), upto=4) == [3, 4]
    assert missing(numbers(spark, [1, 2, 9]), upto=4) == [3, 4]
    assert missing(numbers(spark, []), upto=2) == [1, 2]


@pytest.mark.parametrize("upto", [63, 64, 65, 128, 1000, 40000])
def test_gaps_brute(spark, upto):
    rnd = random.Random(upto)
    seen = [i for i in range(1, upto + 1) if rnd.random() < 0.8 and not 200 < i < 420]
    assert missing(numbers(spark, seen), upto=upto) == sorted(set(range(1, upto + 1)) - set(seen))


def test_far_apart_numbers_in_seconds(spark):
    """The work does not grow with the numbers, nor with a run of them."""
    began = time.time()
    far = numbers(spark, [1, 10**12])
    assert list(map(tuple, gap_ranges(far, "seq").collect())) == [(2, 10**12 - 1)]
    assert sorted(map(tuple, gap_ranges(far, "seq", 10**12 + 5).collect())) == [(2, 10**12 - 1), (10**12 + 1, 10**12 + 5)]
    assert time.time() - began < 30
    long = spark.range(1, 300_001).filter("id not between 70000 and 170000 and id % 1000 <> 7").toDF("seq")
    ranges = sorted(map(tuple, gap_ranges(long, "seq").collect()))
    single = [i for i in range(7, 300_001, 1000) if not 70_000 <= i <= 170_000]
    assert ranges == sorted([(i, i) for i in single] + [(70_000, 170_000)])
    assert find_gaps(long, "seq").count() == len(single) + 100_001


def test_ranges_brute(spark):
    rnd = random.Random(5)
    for most in (70, 700, 7000):
        seen = sorted(rnd.sample(range(-3, most), most // 2))
        df = numbers(spark, seen + seen[:9]).repartition(5)
        gaps = [i for i in range(1, max(seen)) if i not in set(seen)]
        found = sorted(map(tuple, gap_ranges(df, "seq").collect()))
        assert [i for a, b in found for i in range(a, b + 1)] == gaps
        assert all(b + 1 < c for (_, b), (c, _) in zip(found, found[1:]))


def test_first_missing(spark):
    df = numbers(spark, [*range(5, 300), 400, 10**17])
    assert first_missing(df, "seq", 4, 297) == 300
    assert first_missing(df, "seq", 0, 297) == 1
    assert first_missing(df, "seq", 399, 297) == 401


def late_by_hand(rows, cutoff):
    late, earliest = set(), None
    for seq, arrival in sorted(rows, reverse=True):
        if earliest is not None and arrival - earliest > cutoff:
            late.add(seq)
        earliest = arrival if earliest is None else min(earliest, arrival)
    return late


def test_late_fixture(spark):
    rows = [(1, 0.0), (2, 1.0), (5, 2.0), (3, 3.0), (4, 9.0), (6, 10.0)]
    df = spark.createDataFrame(rows, "seq long, arrival double")
    kept, late = reject_stale(df, "seq", "arrival")
    assert [r.seq for r in late.collect()] == [4]
    assert sorted(r.seq for r in kept.collect()) == [1, 2, 3, 5, 6]
    assert kept.columns == df.columns


@pytest.mark.parametrize("stretch", ["dense", "sparse", "clustered"])
def test_late_brute(spark, stretch):
    rnd = random.Random(3)
    n = 9000
    seqs = {
        "dense": range(n),
        "sparse": [i * 10**9 for i in range(n)],
        "clustered": [i if i < n - 5 else 10**15 + i for i in range(n)],
    }[stretch]
    rows = [(s, i * 0.1 + (rnd.uniform(0, 30) if rnd.random() < 0.1 else 0)) for i, s in enumerate(seqs)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["seq", "arrival"])).repartition(7)
    flagged = flag_stale(df, "seq", "arrival", 2.0, "late")
    assert flagged.count() == n
    assert {r.seq for r in flagged.filter("late").collect()} == late_by_hand(rows, 2.0)


def test_clustered_numbers_do_not_share_a_bucket(spark):
    seqs = [*range(50_000), 10**17]
    cut = cut_in_buckets(numbers(spark, seqs), "seq", carry=3)
    sizes = cut.rows.groupBy(cut.bucket().alias("b")).count().agg(F.max("count")).first()[0]
    assert cut.key != "seq" and sizes <= cut.width < 10_000
