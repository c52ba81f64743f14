"""Periodic runs against a brute force over all periods, on planted, random and odd texts."""

import hashlib
import time
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from conftest import LONG
from tidewire.llm import queries
from tidewire.llm.runs import _without, find_runs, runs_of


def brute(words, min_words=24, min_exponent=3):
    """Maximal stretches of every period that have no smaller one."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            stretch = words[start : start + length]
            smaller = any(all(stretch[j] == stretch[j + p] for j in range(length - p)) for p in range(1, q))
            if length >= max(min_words, min_exponent * q) and not smaller:
                found.append((start, length, q))
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_same_as_brute_force(data):
    parts = data.draw(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 12)), max_size=6))
    words = [w for part, times in parts for w in part * times]
    words = [w.encode() for w in words]
    assert runs_of(words) == brute(words)
    assert runs_of(words, 6, 2) == brute(words, 6, 2)


def test_one_word_over_and_over():
    assert runs_of([b"a"] * 24) == [(0, 24, 1)]
    assert runs_of([b"a"] * 23) == []
    assert runs_of([b"x"] + [b"a", b"b"] * 12 + [b"y"]) == [(1, 24, 2)]


def test_longer_period_than_the_floor():
    block = [b"%d" % i for i in range(500)]
    assert runs_of(block * 3) == [(0, 1500, 500)]
    assert runs_of((block * 3)[:-1]) == []


def test_runs_that_overlap():
    words = list(b"ab" * 15 + b"ba" * 0 + b"bcbc" * 10)
    words = [bytes([w]) for w in words]
    found = runs_of(words)
    assert found == brute(words) and len(found) == 2
    kept = _without(words, found)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    assert kept == [w for i, w in enumerate(words) if i not in dropped]


def test_long_text_in_seconds():
    began = time.time()
    words = LONG.encode().split()
    assert runs_of(words) == [(0, len(words), 9)]
    assert time.time() - began < 60


def planted(key, text):
    words = (text or "").encode().split()
    crc = zlib.crc32(str(key).encode())
    n, g = len(words), crc // 10
    if key is not None and crc % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query(spark, documents):
    """Whole result of the query on the small table, and that it holds planted runs."""
    rows = {r.doc_id: r for r in queries.op11_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(documents)
    seen = 0
    for key, text in documents:
        words, row = planted(key, text), rows[key]
        found = runs_of(words) if len(words) > 3000 else brute(words)
        seen += len(found)
        assert row.n_runs == len(found)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(_without(words, found))).hexdigest()
        if found:
            best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row.start, row.length, row.period) == best
            assert row.exponent_milli == 1000 * best[1] // best[2]
        else:
            assert row.start is None and row.length is None and row.period is None and row.exponent_milli is None
    assert seen > 5


def test_odd_rows(spark, odd_docs):
    clash = odd_docs.withColumn("RUNS", odd_docs.doc_id)
    rows = find_runs(clash).collect()
    assert len(rows) == odd_docs.count() and "RUNS" not in rows[0].asDict() and "spans" in rows[0].asDict()
    by_text = {r.text: r for r in rows}
    for blank in (None, "", " \n\t "):
        assert by_text[blank].runs == [] and by_text[blank].collapsed == ""
    assert by_text[LONG].collapsed == "the quick brown fox jumps over the lazy dog"
    assert [r.period for r in by_text[LONG].runs] == [9]


def test_no_rows(spark, no_docs):
    assert find_runs(no_docs).collect() == []


@pytest.mark.parametrize("bad", [{"min_words": 1}, {"min_exponent": 1}])
def test_bad_bounds(odd_docs, bad):
    with pytest.raises(ValueError):
        find_runs(odd_docs, **bad)
