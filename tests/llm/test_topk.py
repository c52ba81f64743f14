import math

import numpy as np
import pytest

from compare import connect, differences
from tidewire.llm import queries, topk

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, vec string"


def brute(rows, asked, k):
    def whole(v):
        return [math.floor(256 * float(np.float32(x))) for x in v]

    def fit(row):
        return row[0] is not None and row[1] is not None and all(x is not None and math.isfinite(x) for x in row[1])

    out = []
    for q in {(r[0], tuple(r[1])) for r in asked if fit(r)}:
        scored = [
            (-sum(a * b for a, b in zip(whole(q[1]), whole(r[1]))), r[0])
            for r in rows if fit(r) and r[0] != q[0] and len(r[1]) == len(q[1])
        ]
        out += [(q[0], rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def run(spark, rows, asked, k):
    frames = [spark.createDataFrame([(*r, "x") for r in some], SCHEMA) for some in (rows, asked)]
    got = topk.exact_top_k(*frames, k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())


def test_matches_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "BITS", 5)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # one vector many times
    rows += [rows[5], (300, None), (301, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5)]
    rows += [(None, rows[0][1]), (304, [1.0]), (305, [])]
    asked = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + [rows[0], rows[0]]
    assert run(spark, rows, asked, 5) == brute(rows, asked, 5)


def test_fewer_rows_than_k_and_no_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5])]
    assert run(spark, rows, rows, 5) == [(1, 1, 2, 32768), (2, 1, 1, 32768)]
    assert run(spark, [], [], 3) == []
    assert run(spark, rows[:1], rows[:1], 3) == []


def test_large_components_are_exact():
    q = np.array([[2.0**40, 3.0], [2.0**100, 0.0]])
    r = np.array([[2.0**20, 5.0], [-(2.0**20), 1.0]])
    top = (1 << 63) - 1
    assert topk.inner_products(q, r).tolist() == [[2**60 + 15, -(2**60) + 3], [top, -top - 1]]
    assert topk.inner_products(q[:1] / 2**15, r).tolist() == [[2**45, -(2**45)]]


def test_k_must_be_positive(spark):
    with pytest.raises(ValueError):
        topk.exact_top_k(None, None, 0)


def test_query_has_its_twins_rows(spark):
    assert differences(queries.op3_topk(spark, SF), connect(SF), queries.OP3_SQL) == ""


def test_queries_beyond_the_bound_meet_by_a_shuffle(spark):
    """Five hundred blocks of candidates: no copy of the queries is broadcast, and both ways agree."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(1000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    asked = frame.filter("vec_id % 50 = 0")
    block, topk.BLOCK = topk.BLOCK, 2
    try:
        wide = topk.exact_top_k(frame, asked, 3, broadcast_bytes=0)
        plan = wide._jdf.queryExecution().toString()
        assert "SortMergeJoin [slot" in plan and "BroadcastHashJoin [slot" not in plan
        narrow = topk.exact_top_k(frame, asked, 3)
        plan = narrow._jdf.queryExecution().toString()
        # what is broadcast are the blocks themselves, not their copies
        assert "BroadcastHashJoin [length" in plan and "explode" not in plan
        assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, narrow.collect()))
    finally:
        topk.BLOCK = block
