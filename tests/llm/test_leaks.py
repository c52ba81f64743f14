import random

import pytest
from pyspark.sql import functions as F

from tidewire.llm import decontaminate, queries
from tidewire.llm.decontaminate import Items, edit_search, folded

SF = "/root/testdata/sf0.001"


def distances(pattern, text):
    """Least edits of the pattern over all stretches of the text that end at each place."""
    row = list(range(len(pattern) + 1))
    ends = []
    for char in text:
        before, row = row, [0]
        for i, p in enumerate(pattern, 1):
            row.append(min(before[i - 1] + (p != char), before[i] + 1, row[-1] + 1))
        ends.append(row[-1])
    return ends


def brute(items, text, percent):
    body, found = folded(text), []
    for name, item in items:
        pattern = folded(item)
        most = len(pattern) * percent // 100
        ends = distances(pattern, body)
        if pattern and ends and min(ends) <= most:
            found.append((name, min(ends)))
    return sorted(found)


def test_bit_parallel_search_is_the_plain_distance():
    rng = random.Random(4)
    for _ in range(500):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 120)))
        if rng.random() < 0.5:
            text = text[:30] + pattern[:-1] + text[30:]
        ends, most = distances(pattern, text), len(pattern) // 4
        least = min(ends, default=most + 1)
        want = (least, ends.index(least) + 1) if least <= most else None
        assert edit_search(pattern, text, most) == want


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        chars[at] = rng.choice(["", "z", chars[at] + "q"])
    return "".join(chars)


def test_no_item_within_its_budget_is_missed():
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "été", "delta", "of", "the", "sum"]
    items = [(str(i), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(25)]
    ready = Items(items, 10)
    for _ in range(150):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))
        for _ in range(rng.randrange(0, 3)):
            item = edited(rng, rng.choice(items)[1], rng.randrange(0, 16))
            at = rng.randrange(len(text) + 1)
            text = text[:at] + item.upper() + text[at:]
        assert [(n, d) for n, d, _, _ in ready.find(text)] == brute(items, text, 10)


def test_places_are_in_code_points():
    item = "Une très longue phrase à répéter dans le texte"
    (leak,) = Items([("1", item)], 10).find("ééé " + item.replace("longue", "lungue") + " fin")
    assert leak == ("1", 1, 4, 4 + len(item))


@pytest.mark.parametrize("bytes_", [60, 1 << 20])
def test_blocks_of_items_find_the_same(spark, monkeypatch, bytes_):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", bytes_)
    items = [(i, f"question number {i} about the great river and its {i * 7} bridges") for i in range(6)]
    odd = [(10, None), (11, ""), (None, "question"), (12, items[0][1])]
    table = spark.createDataFrame(items + odd, "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"so: {items[2][1]}!"), (2, None), (3, ""), (4, items[0][1]), (4, items[0][1])], "doc_id int, text string")
    docs = docs.withColumn("leaks", F.lit("clash"))
    got = sorted((r.doc_id, sorted((x.item, x.distance) for x in r.leaks)) for r in decontaminate.find_leaks(docs, table).collect())
    zero = sorted(x for x in brute([(str(i), t) for i, t in items] + [("12", items[0][1])], items[0][1], 10))
    two = brute([(str(i), t) for i, t in items] + [("12", items[0][1])], f"so: {items[2][1]}!", 10)
    assert got == [(1, two), (2, []), (3, []), (4, zero), (4, zero)]


def test_empty_tables_and_long_texts(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r.leaks == [] for r in decontaminate.find_leaks(odd_docs, none).collect())
    some = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog the quick")], "item_id bigint, text string")
    assert decontaminate.find_leaks(no_docs, some).count() == 0
    hit = {r.doc_id: len(r.leaks) for r in decontaminate.find_leaks(odd_docs, some).collect()}
    assert hit[5] == 1 and sum(hit.values()) == 1


def test_query_against_brute_force(spark, documents):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, str(r.item_id), r.distance) for r in queries.op5_decontaminate(spark, SF).collect()}
    for key, text in documents:
        exact = {(key, name, 0) for name, item in items if folded(item) in folded(text or "")}
        assert exact <= got
    texts, bodies = dict(documents), dict(items)
    for key, name, distance in got:
        assert min(distances(folded(bodies[name]), folded(texts[key]))) == distance <= len(folded(bodies[name])) // 10
