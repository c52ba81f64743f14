"""Mixing against exact water-filling in fractions; what each row takes; odd rows."""

from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from tidewire.llm.mixture import mix_sources, mixed_texts, word_count


def poured(sizes, weights, share, most):
    """Targets by clamping and pouring again, in fractions."""
    budget = Fraction(share) * sum(sizes)
    clamped = {i for i, w in enumerate(weights) if w == 0}
    held = {i: Fraction(0) for i in clamped}
    while True:
        free = [i for i in range(len(sizes)) if i not in clamped]
        if not free:
            return [held[i] for i in range(len(sizes))]
        level = (budget - sum(held.values())) / sum(weights[i] for i in free)
        above = [i for i in free if level * weights[i] > most * sizes[i]]
        if not above:
            return [held[i] if i in held else level * weights[i] for i in range(len(sizes))]
        for i in above:
            clamped.add(i)
            held[i] = Fraction(most) * sizes[i]


def corpus(spark, counts, length=lambda s, i: 1 + (i * 7 + len(str(s))) % 40):
    rows, key = [], 0
    for source, n in counts:
        for i in range(n):
            rows.append((key, source, " ".join(f"w{key}" for _ in range(length(source, i)))))
            key += 1
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string")


@pytest.mark.parametrize(
    "counts, weights, share, most",
    [
        ([("a", 30), ("b", 5), ("c", 60), (None, 9)], (3, 1, 2), Fraction(3, 2), 2),
        ([("a", 1), ("b", 200), ("c", 3)], (1, 1, 5), Fraction(1, 3), 1),
        ([("a", 4), ("b", 4), ("c", 4)], (0, 1), Fraction(1, 2), Fraction(5, 2)),
        ([("a", 20), ("b", 20)], (1,), 4, 3),
        ([("only", 50)], (7,), Fraction(7, 5), 2),
    ],
)
def test_targets_and_what_is_taken(spark, counts, weights, share, most):
    docs = corpus(spark, counts)
    rows = mix_sources(docs, weights, share, most).collect()
    names = sorted({s for s, _ in counts}, key=lambda s: (s is None, s or ""))
    sizes = defaultdict(int)
    for r in rows:
        assert r.size == len(r.text.split())
        sizes[r.source] += r.size
    dealt = [weights[i % len(weights)] for i in range(len(names))]
    expected = dict(zip(names, poured([sizes[s] for s in names], dealt, share, most)))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(expected[r.source]), rel=1e-12, abs=1e-12)
        assert 0 <= r.epochs * r.size + r.part <= most * r.size + 1
        taken[r.source] += r.epochs * r.size + r.part
    for source in names:
        assert abs(taken[source] - expected[source]) <= Fraction(1, 2)


def test_runs_agree_and_seeds_differ(spark):
    docs = corpus(spark, [("a", 200), ("b", 300)])
    one = {r.doc_id: (r.epochs, r.part) for r in mix_sources(docs, (1, 3)).collect()}
    again = {r.doc_id: (r.epochs, r.part) for r in mix_sources(docs.repartition(7, "text"), (1, 3)).collect()}
    other = {r.doc_id: (r.epochs, r.part) for r in mix_sources(docs, (1, 3), seed="other").collect()}
    assert one == again and one != other


def test_texts_of_the_mix(spark):
    docs = corpus(spark, [("a", 20), ("b", 90)])
    mixed = mix_sources(docs, (3, 1))
    taken = {r.doc_id: r.epochs * r.size + r.part for r in mixed.collect()}
    words, texts = defaultdict(int), defaultdict(list)
    for r in mixed_texts(mixed).collect():
        words[r.doc_id] += len(r.text.split())
        texts[r.doc_id].append((r.repetition, r.text))
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert all([n for n, _ in sorted(found)] == list(range(1, len(found) + 1)) for found in texts.values())


def test_one_source_with_most_rows_and_one_text_in_most_rows(spark):
    """Rows alike share what falls to them, to the nearest word; the rest is exact."""
    same = [(1, "hot", "a b c d e f g h i j")] * 3000
    rest = [(i, f"s{i % 50}", f"word{i} more") for i in range(2, 1500)]
    docs = spark.createDataFrame(same + rest, "doc_id bigint, source string, text string")
    rows = mix_sources(docs, (3, 1, 2)).collect()
    hot = [r for r in rows if r.source == "hot"]
    target = hot[0].target
    assert len({(r.epochs, r.part) for r in hot}) == 1
    assert abs(sum(r.epochs * r.size + r.part for r in hot) - target) <= 0.5 * len(hot)


def test_weights_as_a_table(spark):
    docs = corpus(spark, [("a", 20), ("b", 20), (None, 20)])
    weights = spark.createDataFrame([("a", 1), (None, 1)], "source string, weight bigint")
    rows = mix_sources(docs, weights, Fraction(1, 2), 2).collect()
    assert all(r.target == 0 and r.epochs == r.part == 0 for r in rows if r.source == "b")
    assert len({r.target for r in rows if r.source != "b"}) == 1


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("lang", "source").withColumns(
        {"target": F.lit("x"), "left": F.lit(1), "rest": F.lit(2), "drawn": F.lit(3), "place": F.lit(4)}
    )
    rows = mix_sources(docs, (3, 1, 2)).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.epochs == 0 and r.part == 0 for r in rows if r.size == 0)
    assert {type(r.target) for r in rows} == {float} and {r.left for r in rows} == {1}
    alike = [(r.epochs, r.part) for r in rows if r.doc_id == 1]
    assert len(alike) == 2 and alike[0] == alike[1]
    empty = no_docs.withColumnRenamed("lang", "source")
    assert mix_sources(empty, (3, 1, 2)).collect() == [] and mixed_texts(mix_sources(empty, (1,))).collect() == []
    blank = docs.filter("doc_id in (2, 3, 4)")
    assert [r.target for r in mix_sources(blank, (1,)).collect()] == [0.0] * 3


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b\t", "\x0bx\x0cy\r\n", "a b c", "\x1cq"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    counted = [r.n for r in df.select("i", word_count(F.col("text")).alias("n")).orderBy("i").collect()]
    assert counted == [0, 0, 0, 1, 2, 2, 2, 1]


def test_bad_settings(spark, no_docs):
    docs = no_docs.withColumnRenamed("lang", "source")
    for bad in ({"weights": ()}, {"weights": (-1,)}, {"weights": (1,), "share": -1}, {"weights": (1,), "max_epochs": -1}):
        with pytest.raises(ValueError):
            mix_sources(docs, **bad)
