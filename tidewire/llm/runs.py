"""Periodic runs of words, found by uniting suffix classes in descending order of their common prefixes.

A run is a stretch of words with a smallest period q (words q apart are the same) that cannot be made longer on
either side. The suffixes of a text are sorted, and neighbours are united, longest common prefix (LCP) first. Each
class is the ordered set of the places at which its suffixes begin; the smaller set is put into the larger one.
When two places i < j become neighbours in a set at LCP l, the words from i on are the same as those from j on for
l words and no more, and no place between does as well. So if j - i is not above l and the words before i and j
differ, (i, l + j - i, j - i) is a run, and no smaller period fits it. Every run is met so, once.

Runs asked for have at least ``min_words`` words and ``min_exponent`` periods, hence an l of at least
``_least`` words. Places whose next words of that number are nowhere else in the text are in no class that counts;
they are left out before suffixes are sorted, which leaves most texts with none. Words are compared as they are,
by numbers given within the text: no hash decides a run.

Rows: a null text, and one without words, has no runs, and collapses to an empty text. A text is worked on as a
whole, since a run may span it; that takes some 200 bytes per word and n log n steps, in one task. Repeated rows
give the same. An empty table gives an empty result. Further columns are kept, those named as results replaced.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewire.llm.common import appended, map_batches, texts_of, with_columns

MIN_WORDS, MIN_EXPONENT = 24, 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Bytes of text per batch of results.
BATCH = 4 << 20


def find_runs(
    docs: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    min_words: int = MIN_WORDS,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) in words, by start, then period; and with
    ``collapsed``, the words that are in no run beyond its first period, joined by one space."""
    if min_words < 2 or min_exponent < 2:
        raise ValueError("min_words and min_exponent must be at least 2")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, found, kept = 0, 0, [], []
            texts = texts_of(batch, text).cast(pa.binary())
            for place in range(batch.num_rows):
                words = texts[place].as_py().split()  # bytes part at ASCII white space alone
                of_text = runs_of(words, min_words, min_exponent)
                found.append([dict(zip(("start", "length", "period"), run)) for run in of_text])
                kept.append(b" ".join(_without(words, of_text)))
                held += len(kept[-1]) + 64
                if held > BATCH or place == batch.num_rows - 1:
                    yield with_columns(
                        batch.slice(first, len(kept)),
                        {runs: pa.array(found, pa.list_(_RUN)), collapsed: pa.array(kept, pa.binary()).cast(pa.string())},
                    )
                    first, held, found, kept = place + 1, 0, [], []

    kind = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return map_batches(docs, work, appended(docs, f"`{runs}` {kind}, `{collapsed}` string"))


def _without(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def _least(min_words: int, min_exponent: int) -> int:
    """The least LCP behind a run: the lesser of length - q over all allowed q, where length >= both bounds."""
    return min(max(min_words - q, (min_exponent - 1) * q) for q in range(1, min_words + 1))


def runs_of(words: list, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """The runs of one text, as (start, length, period) by start, then period."""
    n = len(words)
    if n < min_words:
        return []
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    least = _least(min_words, min_exponent)
    places = _repeated(ids, least)
    if len(places) < 2:
        return []
    order, lcp = _suffixes(ids, places)
    return sorted(_unite(ids, order, lcp, least, min_words, min_exponent))


def _repeated(ids: np.ndarray, width: int) -> np.ndarray:
    """Places whose next ``width`` words (by hash: a few places too many do no harm) begin elsewhere too."""
    sums, have, want = ids.astype(np.uint64), 1, width
    out, done = None, 0
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        # hashes of 1, 2, 4 .. words; those that make up the width are put together
        sums = (sums + np.uint64(1)) * factor
        sums ^= sums >> np.uint64(29)
        while want:
            if want & 1:
                tail = sums[done:]
                out = tail if out is None else _joined(out[: len(tail)], tail, done + 1)
                done += have
            want >>= 1
            if want:
                sums = _joined(sums[:-have], sums[have:], have)
                have *= 2
    out = out[: len(ids) - width + 1]
    ordered = np.sort(out)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.isin(out, np.unique(twice)))


def _joined(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    out = left * np.uint64(0xD6E8FEB86659FD93) + right * np.uint64(2 * salt + 0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _suffixes(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``places`` in the order of their suffixes, and the LCP of each with the one before it (first: 0).

    Ranks by the first 1, 2, 4 .. words are kept, so that common prefixes are read off them by halving."""
    n = len(ids)
    levels, width = [ids.astype(np.int32)], 1
    while width < n:
        rank = levels[-1].astype(np.int64)
        # a suffix that ends comes before all that go on
        behind = np.zeros(n, np.int64)
        behind[: n - width] = rank[width:] + 1
        pair = rank * (n + 1) + behind
        by_pair = np.argsort(pair)
        steps = np.zeros(n, np.int32)
        steps[1:] = np.cumsum(pair[by_pair[1:]] != pair[by_pair[:-1]])
        following = np.empty(n, np.int32)
        following[by_pair] = steps
        levels.append(following)
        width *= 2
        if steps[-1] == n - 1:
            break
    order = places[np.argsort(levels[-1][places])]
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(order), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        width = 1 << level
        # equal ranks mean equal words only where both suffixes have that many left
        inside = np.maximum(a, b) + width <= n
        same = inside.copy()
        same[inside] = levels[level][a[inside]] == levels[level][b[inside]]
        lcp[1:][same] += width
        a[same] += width
        b[same] += width
    return order, lcp


def _unite(
    ids: np.ndarray, order: np.ndarray, lcp: np.ndarray, least: int, min_words: int, min_exponent: int
) -> Iterator[tuple[int, int, int]]:
    """Kruskal over the neighbours in suffix order, greatest LCP first, down to ``least``."""
    joins = np.flatnonzero(lcp >= least)
    joins = joins[np.argsort(-lcp[joins], kind="stable")]
    value = ids.tolist()
    # by place in suffix order: the class, and the ordered places of each class
    parent = list(range(len(order)))
    members = [[place] for place in order.tolist()]
    for join, common in zip(joins.tolist(), lcp[joins].tolist()):
        left, right = _root(parent, join - 1), _root(parent, join)
        if len(members[left]) > len(members[right]):
            left, right = right, left
        small, large = members[left], members[right]
        parent[left], members[left] = right, []
        for place in small:
            insort(large, place)
        # looked at when all are in: what still is between two places keeps them apart
        own = set(small)
        for place in small:
            at = bisect_left(large, place)
            for other in (at - 1, at + 1):
                # two of the same set had their turn when they met
                if other < 0 or other == len(large) or large[other] in own:
                    continue
                start, period = min(place, large[other]), abs(place - large[other])
                length = common + period
                if length < min_words or length < min_exponent * period:
                    continue
                if start == 0 or value[start - 1] != value[start - 1 + period]:
                    yield start, length, period


def _root(parent: list[int], at: int) -> int:
    while parent[at] != at:
        parent[at] = parent[parent[at]]
        at = parent[at]
    return at
