import random

import numpy as np
import pytest

from compare import connect, differences
from tidewire.llm import jaccard, queries

SF = "/root/testdata/sf0.001"


def sets_of(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [sets_of(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, len(s), least.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def run(spark, rows, size, percent):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard.jaccard_components(docs, size=size, percent=percent)
    return order((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())


def near_copies(seed, groups=8, copies=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [rng.choice(words) for _ in range(25)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(20, 90))]
        if rng.random() < 0.5:
            base = shared + base
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(0, 2)] = [rng.choice(words)]
            if rng.random() < 0.3:
                text = text[: rng.randrange(len(text) // 2, len(text) + 1)]
            rows.append((rng.randrange(10_000), " ".join(text)))
    return rows


@pytest.mark.parametrize("size, percent, block", [(4, 85, 4), (5, 80, 1024), (2, 60, 6), (3, 100, 1024)])
def test_matches_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(size) + [(90_001, "One two"), (90_002, "one TWO"), (90_003, "one two three four"), (90_004, "")]
    rows += [(90_005, None), (90_006, " \n"), rows[0], rows[0], (None, rows[1][1]), (None, "alone in the world here now")]
    assert run(spark, rows, size, percent) == order(brute(rows, size, percent))


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(140)]
    rows = [(100 - i, " ".join(words[4 * i : 4 * i + 80])) for i in range(15)]
    got = run(spark, rows, 4, 85)
    assert got == order(brute(rows, 4, 85))
    assert {r[2] for r in got} == {86}


def test_odd_rows(spark, odd_docs, no_docs):
    got = jaccard.jaccard_components(odd_docs, size=4, percent=85, keep=["score", "spans"]).collect()
    assert len(got) == 9
    by = {r.doc_id: r for r in got}
    assert by[2].n_shingles == 0 and by[2].component_id == 2 and by[2].component is None
    assert by[5].component_id == 5 and by[5].spans == "z"
    assert by[None].component_id is None
    assert jaccard.jaccard_components(no_docs).count() == 0


def test_short_sequences_differ_from_shingles_of_the_same_words():
    import pyarrow as pa

    tokens, bounds = jaccard.shingles_of(pa.array(["a b c", "a b c d", "a b c d e", "", "A b C"]), 4)
    assert np.diff(bounds).tolist() == [1, 1, 2, 0, 1]
    assert tokens[0] == tokens[4] and len(set(tokens.tolist())) == 3


def test_query_has_its_twins_rows(spark):
    assert differences(queries.op4_jaccard(spark, SF), connect(SF), queries.OP4_SQL) == ""
