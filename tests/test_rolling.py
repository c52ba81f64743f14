"""Rolling means against a deque, over all ways of cutting the sequence."""

import math
import random
from collections import defaultdict, deque

import pandas as pd
import pytest
from tidewire.operators.rolling import rolling_average, sequence_and_average


def by_hand(rows, window, groups=None):
    last = defaultdict(lambda: deque(maxlen=window))
    out = {}
    for i, (seq, value) in enumerate(rows):
        frame = last[groups[i] if groups else None]
        frame.append(value)
        out[seq] = round(sum(frame) / len(frame), 4)
    return out


def rows_of(kind, n=9000):
    rnd = random.Random(2)
    seqs = {
        "dense": range(1, n + 1),
        "gaps": [i for i in range(1, n + 1) if rnd.random() < 0.85],
        "outages": [i for i in range(1, n + 1) if i % 4096 > 1200],
        "sparse": [i * 10**10 for i in range(n)],
        "clustered": [i if i < n - 20 else 10**16 + i for i in range(n)],
    }[kind]
    return [(s, rnd.randrange(0, 50000) / 100) for s in seqs]


def check(spark, rows, window, parts=6, **kw):
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["seq", "v"])).repartition(parts)
    out = rolling_average(df, "seq", "v", window, **kw)
    got = {r.seq: r.computed_metric for r in out.collect()}
    want = by_hand(rows, window)
    assert len(got) == len(rows) and got.keys() == want.keys()
    assert [s for s in want if got[s] != want[s]] == []


@pytest.mark.parametrize("kind", ["dense", "gaps", "outages", "sparse", "clustered"])
@pytest.mark.parametrize("window", [1, 3, 8, 150])
def test_every_cut(spark, kind, window):
    check(spark, rows_of(kind), window)


@pytest.mark.parametrize("width", [1, 7, 500, 1 << 20])
def test_bucket_width_does_not_matter(spark, width):
    check(spark, rows_of("gaps"), 10, bucket_width=width)


@pytest.mark.parametrize("parts", [1, 13])
def test_partitioning_does_not_matter(spark, parts):
    check(spark, rows_of("gaps", 3000), 10, parts=parts)


def test_warm_up_and_wide_windows(spark):
    rows = [(1, 1.0), (2, 2.0), (3, 4.0)]
    check(spark, rows, 10)
    df = spark.createDataFrame(rows, "seq long, v double")
    assert [r.computed_metric for r in rolling_average(df, "seq", "v", 10).orderBy("seq").collect()] == [
        1.0, 1.5, 2.3333,
    ]
    check(spark, rows_of("dense", 200), 10_000)


def test_ties_round_as_in_python(spark):
    """Eight values whose mean ends in a 5 in the fifth decimal."""
    rows = [(i, 31.0) for i in range(7)] + [(7, 32.85)]
    check(spark, rows, 8)
    df = spark.createDataFrame(rows, "seq long, v double")
    last = rolling_average(df, "seq", "v", 8).orderBy("seq").collect()[-1]
    assert last.computed_metric == round((31.0 * 7 + 32.85) / 8, 4)


def test_special_values(spark):
    inf, nan = float("inf"), float("nan")
    values = [1.0, inf, 2.0, -inf, 1e300, 3.0, nan, 4.0, 5.0]
    df = spark.createDataFrame(list(enumerate(values)), "seq long, v double")
    out = [r.computed_metric for r in rolling_average(df, "seq", "v", 2).orderBy("seq").collect()]
    assert repr(out) == repr([1.0, inf, inf, -inf, -inf, 5e299, nan, nan, 4.5])


@pytest.mark.parametrize("window", [65, 128, 1000, 4096])
@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e6])
def test_long_windows(spark, window, scale):
    """Binary fractions, of which many means are rounding ties, and values without a short text."""
    rnd = random.Random(window)
    rows = [(i, scale * (rnd.randrange(-800, 800) / 8 if i % 3 else rnd.uniform(-9, 9))) for i in range(9000)]
    check(spark, rows, window, bucket_width=500)


@pytest.mark.parametrize("window", [10, 100])
def test_huge_values_are_added_plainly(spark, window):
    """Beyond 2**42 sums are not exact any more, but as good as plain ones."""
    rnd = random.Random(window)
    rows = [(i, 1e14 * rnd.uniform(1, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "seq long, v double")
    want = by_hand(rows, window)
    for r in rolling_average(df, "seq", "v", window).collect():
        assert r.computed_metric == pytest.approx(want[r.seq], rel=1e-13)


def test_long_windows_of_special_values(spark):
    rows = [(i, float(i)) for i in range(300)]
    rows[100] = (100, float("inf"))
    df = spark.createDataFrame(rows, "seq long, v double")
    out = [r.computed_metric for r in rolling_average(df, "seq", "v", 80).orderBy("seq").collect()]
    assert out[99] == round(sum(range(20, 100)) / 80, 4) and out[100] == out[179] == float("inf")
    assert out[180] == round(sum(range(101, 181)) / 80, 4)


def test_missing_values_take_a_place_but_do_not_count(spark):
    rows = [(i, None if i % 4 == 1 else float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, v double")
    for window in (3, 100):
        got = [r.computed_metric for r in rolling_average(df, "seq", "v", window).orderBy("seq").collect()]
        for i in range(400):
            frame = [v for _, v in rows[max(0, i - window + 1) : i + 1] if v is not None]
            assert got[i] == (round(sum(frame) / len(frame), 4) if frame else 0.0)


def test_by_group_with_a_hot_group(spark):
    rnd = random.Random(9)
    n = 12000
    groups = ["hot" if rnd.random() < 0.4 else f"g{rnd.randrange(30)}" for _ in range(n)]
    rows = [(i * 3, rnd.randrange(10000) / 100) for i in range(n)]
    data = pd.DataFrame({"seq": [s for s, _ in rows], "v": [v for _, v in rows], "g": groups})
    out = rolling_average(
        spark.createDataFrame(data).repartition(5), "seq", "v", 10, partition_by=["g"], bucket_width=1000
    )
    got = {r.seq: r.computed_metric for r in out.collect()}
    want = by_hand(rows, 10, groups)
    assert got.keys() == want.keys()
    assert [s for s in want if got[s] != want[s]] == []
    assert out.columns == ["seq", "v", "g", "computed_metric"]


def test_no_rows_and_integers(spark):
    empty = spark.createDataFrame([], "seq long, v double")
    assert rolling_average(empty, "seq", "v", 3).columns == ["seq", "v", "computed_metric"]
    assert rolling_average(empty, "seq", "v", 3).count() == 0
    whole = spark.createDataFrame([(1, 1), (2, 2)], "seq long, v long")
    assert [r.computed_metric for r in rolling_average(whole, "seq", "v", 3).orderBy("seq").collect()] == [1.0, 1.5]
    dec = spark.createDataFrame([(1, 1)], "seq long, v long").selectExpr("seq", "cast(v as decimal(10,2)) v")
    assert rolling_average(dec, "seq", "v", 3).first().computed_metric == 1.0


@pytest.mark.parametrize("window", [0, -1, True, 2.0])
def test_window_checked(spark, window):
    with pytest.raises(ValueError):
        rolling_average(spark.range(1), "id", "id", window)


@pytest.mark.parametrize("window", [40, 1000, 5000, 10**7])
def test_windows_over_many_stretches_of_odd_values(spark, window):
    """Stretches of 64 numbers, whatever the window; values that are missing, infinite or not a number."""
    rnd = random.Random(window)
    rows, odd = [], {700: float("nan"), 1500: float("inf"), 1900: float("-inf"), 2300: None, 2301: None, 2600: 2.0**51}
    for i in range(3000):
        if i % 37:
            rows.append((i * 3 - 50 if i < 2000 else 10**9 + i, odd.get(i, rnd.randrange(10**6) / 1000)))
    df = spark.createDataFrame(rows, "seq long, v double").repartition(7)
    got = {r.seq: r.computed_metric for r in rolling_average(df, "seq", "v", window, bucket_width=64).collect()}
    values = [v for _, v in rows]
    for at, (seq, _) in enumerate(rows):
        known = [v for v in values[max(0, at + 1 - window) : at + 1] if v is not None]
        if any(math.isnan(v) for v in known) or {float("inf"), float("-inf")} <= set(known):
            assert math.isnan(got[seq])
        elif any(map(math.isinf, known)):
            assert math.isinf(got[seq]) and got[seq] in known
        else:
            assert got[seq] == (round(math.fsum(known) / len(known), 4) if known else 0.0)


def test_a_stretch_does_not_grow_with_the_window(spark):
    from tidewire.operators.ordering import key_spread

    df = spark.range(1, 4001).selectExpr("id as seq", "cast(id % 97 as double) as v")
    for window in (1000, 10**7):
        averaged = rolling_average(df, "seq", "v", window, bucket_width=128, spread=key_spread(df, "seq"))
        plan = averaged._jdf.queryExecution().optimizedPlan().toString()
        assert "div 128" in plan and "SinglePartition" not in plan
        assert averaged.count() == 4000


@pytest.mark.parametrize("kind", ["dense", "gaps", "outages", "sparse", "clustered"])
@pytest.mark.parametrize("window, share", [(1, 0.5), (10, 0.9), (10, 0.02), (64, 0.6), (200, 0.9)])
def test_numbering_and_averaging_at_once(spark, kind, window, share):
    """Against numbers and means by hand, with few accepted rows too, and a stretch without any."""
    rnd = random.Random(window)
    rows = [(k, v, rnd.random() < share and not 3000 < at < 5200) for at, (k, v) in enumerate(sorted(rows_of(kind)))]
    df = spark.createDataFrame(rows, "key long, v double, ok boolean").repartition(5)
    got = sequence_and_average(df, "key", "v", window, "ok", bucket_width=500).collect()
    last, want = deque(maxlen=window), []
    for n, (k, v, ok) in enumerate(rows, 1):
        if ok:
            last.append(v)
            want.append((n, k, round(math.fsum(last) / len(last), 4)))
    assert sorted((r.priority_index, r.key, r.computed_metric) for r in got) == want


def test_numbering_nothing(spark):
    df = spark.createDataFrame([], "key long, v double, ok boolean")
    assert sequence_and_average(df, "key", "v", 3, "ok").collect() == []
    with pytest.raises(ValueError):
        sequence_and_average(df, "key", "v", 3, "ok", seq_name="v")
