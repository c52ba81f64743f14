import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire.llm import language, ppm, quality, queries

SF = "/root/testdata/sf0.001"


# ---- language -----------------------------------------------------------------------------------


def plain_mixture(likely, allowed, steps):
    shares = [a / sum(allowed) for a in allowed]
    for _ in range(steps):
        sums = [0.0] * len(shares)
        for word in likely:
            total = sum(p * s for p, s in zip(word, shares))
            for at, (p, s) in enumerate(zip(word, shares)):
                sums[at] += p * s / total
        shares = [max(x / len(likely), 1e-9) * a for x, a in zip(sums, allowed)]
        shares = [x / sum(shares) for x in shares]
    return shares


def test_mixture_is_expectation_maximisation():
    rng = np.random.default_rng(3)
    likely = rng.random((30, 3)).astype(np.float32)
    firsts = np.array([0, 7, 8, 30])
    allowed = np.array([[1, 1, 1], [1, 0, 1], [0, 1, 1]], float)
    shares, total = language.mixture(likely, firsts, allowed, 6)
    for row, (a, b) in enumerate(zip(firsts, firsts[1:])):
        want = plain_mixture(likely[a:b].tolist(), allowed[row].tolist(), 6)
        assert shares[row] == pytest.approx(want, abs=1e-5)
        assert total[row] == pytest.approx(sum(math.log(np.dot(w, want)) for w in likely[a:b]), abs=1e-3)


def test_trigrams_stay_within_their_text():
    def all_of(*texts):
        buckets, words, firsts = language.trigrams_of(pa.array(texts))
        return [[buckets[words[w] : words[w + 1]].tolist() for w in range(a, b)] for a, b in zip(firsts, firsts[1:])]

    assert all_of("Été au", "x", "", "1 2") == [*all_of("été au"), *all_of("x"), [], []]
    assert all_of("ab", "cd") == [*all_of("ab"), *all_of("cd")]


def test_language_of_mixed_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn_languages(docs)
    texts = {lang: [r.text for r in docs.filter(F.col("lang") == lang).limit(20).collect()] for lang in ("en", "fr")}
    both = [" ".join(e.split()[:60] + f.split()[:40]) for e, f in zip(texts["en"], texts["fr"]) if len(f.split()) > 60 < len(e.split())]
    shares = language.infer(model, pa.array(both))
    en, fr = model.names.index("en"), model.names.index("fr")
    assert np.abs(shares[:, en] - 0.6).max() < 0.15 and np.abs(shares[:, fr] - 0.4).max() < 0.15
    alone = language.infer(model, pa.array(texts["en"]))
    assert (alone[:, en] > 0.9).mean() > 0.9


def made_up_languages(count):
    """Languages of words over letters of their own, in texts of 300 words each, by name."""
    rng = np.random.default_rng(11)
    alphabets = ["".join(chr(0x400 + 8 * lang + i) for i in range(8)) for lang in range(count)]
    return {
        f"l{at}": " ".join("".join(rng.choice(list(letters), 6)) for _ in range(300)) for at, letters in enumerate(alphabets)
    }


def test_a_text_may_have_all_learned_languages(spark):
    texts = made_up_languages(7)
    model = language.learn_languages(spark.createDataFrame(list(texts.items()), "lang string, text string"))
    for count in (1, 3, 5, 7):
        mixed = " ".join(" ".join(text.split()[:60]) for text in list(texts.values())[:count])
        shares = language.infer(model, pa.array([mixed]))[0]
        assert shares == pytest.approx([1 / count] * count + [0] * (7 - count), abs=0.01)


def test_language_query_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op10_language(spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == 200
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) and 0 <= row.score <= 1
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.95


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language.learn_languages(odd_docs)
    assert model.names == ("en", "fr")
    docs = odd_docs.withColumn("lang_pred", F.lit("clash"))
    got = {r.doc_id: r for r in language.detect_languages(docs, model).collect()}
    assert {k for k, r in got.items() if r.lang_pred == "und"} == {2, 3, 4, 6}
    assert all(got[k].score == 0 and got[k].languages == [] for k in (2, 3, 4, 6))
    assert got[5].lang_pred == "en" and got[None].lang_pred == "fr" and got[5].spans == "z"
    nothing = language.learn_languages(no_docs)
    assert nothing.names == ()
    assert {r.lang_pred for r in language.detect_languages(odd_docs, nothing).collect()} == {"und"}
    assert language.detect_languages(no_docs, model).count() == 0


# ---- quality ------------------------------------------------------------------------------------


def test_word_vectors_sum_their_neighbours(spark):
    texts = ["a b c d", "c c", "", None, "b a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    vectors, counts = quality.word_vectors(docs)
    places, signs = quality.index_vectors()
    bucket = lambda w: int(quality.buckets_of(pa.array([w]))[0][0])
    sums, seen = np.zeros((quality.BUCKETS, quality.LENGTH)), Counter()
    for text in texts:
        words = [bucket(w) for w in (text or "").split()]
        seen.update(words)
        for i, a in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if i != j:
                    np.add.at(sums[a], places[words[j]], signs[words[j]])
    means = {b: sums[b] / n for b, n in seen.items()}
    centre = sum(means[b] * n for b, n in seen.items()) / sum(seen.values())
    for b, n in seen.items():
        assert counts[b] == n
        want = (means[b] - centre) / np.linalg.norm(means[b] - centre)
        assert vectors[b] == pytest.approx(want, abs=1e-5)


def test_training_is_calibrated_and_steady():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4))
    chance = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < chance).astype(float)
    network = quality.train(x, y)
    assert np.abs(network.probabilities(x) - chance).mean() < 0.06
    assert np.array_equal(network.probabilities(x), quality.train(x, y).probabilities(x))
    assert quality.train(x[:5], np.ones(5)).probabilities(x[:2]) == pytest.approx([6 / 7] * 2)
    assert quality.train(x[:0], y[:0]).probabilities(x[:1]) == pytest.approx([0.5])


def test_quality_query_on_held_out_rows(spark):
    rows = queries.op1_quality(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    area = sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad)
    assert area > 0.93


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (5, 0), (6, None), (None, 1), (99, 1)], "doc_id bigint, quality int")
    model = quality.learn_quality(odd_docs, labels)
    rows = quality.score_quality(odd_docs, model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1
    assert quality.score_quality(no_docs, model).count() == 0
    blank = quality.learn_quality(no_docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(odd_docs, blank).collect()} == {0.5}


# ---- partial matching ---------------------------------------------------------------------------


def brute_ppm(rows, order):
    """(id, text, learn) to (id, tokens, known, all, base, score), symbol by symbol."""
    trie, words = [defaultdict(Counter) for _ in range(order + 1)], Counter()

    def tokens(text):
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        return re.findall(r"[^\x20\x09-\x0D]+", small) + [None]

    for _, text, learn in rows:
        if learn:
            data = bytes(order) + (text or "").encode() + b"\0"
            words.update(tokens(text or ""))
            for i in range(order, len(data)):
                for k in range(order + 1):
                    trie[k][data[i - k : i]][data[i]] += 1
    total = sum(words.values())
    out = []
    for key, text, _ in rows:
        data, score = bytes(order) + (text or "").encode() + b"\0", 0.0
        for i in range(order, len(data)):
            gone = set()
            for k in range(order, -1, -1):
                left = {s: n for s, n in trie[k].get(data[i - k : i], {}).items() if s not in gone}
                if not left:
                    continue
                size = sum(left.values()) + len(left)
                if data[i] in left:
                    score += math.log10(left[data[i]] / size)
                    break
                score += math.log10(len(left) / size)
                gone |= set(left)
            else:
                score -= math.log10(256 - len(gone))
        own = tokens(text or "")
        base = sum(math.log10((words[w] + 1) / (total + len(words) + 1)) for w in own)
        out.append((key, len(own), sum(words[w] > 0 for w in own), total, base, score))
    return out


def compare_ppm(got, want):
    assert len(got) == len(want)
    none_last = lambda r: (r[0] is None, r[0] or 0, r[4])
    for a, b in zip(sorted(got, key=none_last), sorted(want, key=none_last)):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9) and a[5] == pytest.approx(b[5], rel=1e-5, abs=1e-4)


@pytest.mark.parametrize("chunk", [200, 1 << 20])
def test_scores_are_those_of_a_plain_trie(spark, monkeypatch, chunk):
    monkeypatch.setattr(ppm, "CHUNK", chunk)
    texts = ["the cat sat", "the Cat sat on the mat", "", None, "été à la mer", "zzz qqq", "abab" * 30, "the cat sat", "\x00\x00 a"]
    rows = [(i, t, i not in (3, 5, 7)) for i, t in enumerate(texts)] + [(0, texts[0], True), (None, "the end", False), (20, "new", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, learn boolean")
    compare_ppm([tuple(r) for r in ppm.score_texts(docs, "learn").collect()], brute_ppm(rows, ppm.ORDER))


def test_scores_with_nothing_to_learn_from(spark, odd_docs, no_docs):
    docs = odd_docs.filter("doc_id <> 5").withColumn("learn", F.lit(False))
    for row in ppm.score_texts(docs, "learn").collect():
        assert row.base_score == 0 and row.n_known == 0 and row.train_tokens == 0 and row.score < 0
    assert ppm.score_texts(no_docs.withColumn("learn", F.lit(True)), "learn").count() == 0


def test_long_text_among_odd_rows(odd_docs):
    rows = ppm.score_texts(odd_docs.withColumn("learn", F.col("doc_id") == 5), "learn").collect()
    long = next(r for r in rows if r.doc_id == 5)
    assert long.n_tokens == long.n_known == 540_001 and 0.1 * long.base_score < long.score < 0


def test_ppm_query_learns_from_its_fold_only(spark, documents):
    rows = queries.op7_ppm(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows)
    some = [(k, t, zlib.crc32(str(k).encode()) % 7 != 2) for k, t in documents]
    want = {r[0]: r for r in brute_ppm(some, ppm.ORDER)[::10]}
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows if r.doc_id in want]
    compare_ppm(got, list(want.values()))


def test_estimation_goes_on_until_it_settles():
    """Close languages need many steps: a thousand more add next to nothing to any document's likelihood."""
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 400, 60)
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    likely = np.exp(-rng.random((firsts[-1], 3)) * np.array([1.0, 1.0, 6.0])).astype(np.float32)
    likely[:, 1] = likely[:, 0] * (1 + 0.05 * rng.standard_normal(firsts[-1])).astype(np.float32).clip(-3, 3)
    allowed = np.ones((60, 3))
    shares, value = language.mixture(likely, firsts, allowed)
    _, eight = language.mixture(likely, firsts, allowed, 8)
    _, long = language.mixture(likely, firsts, allowed, 1000)
    assert (value >= eight - 1e-2).all() and (long - value).max() < 0.5
    assert np.allclose(shares.sum(1), 1)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    docs = spark.createDataFrame([(f"text number {i}", f"l{i}") for i in range(4)], "text string, lang string")
    with pytest.raises(ValueError, match="are they languages"):
        language.learn_languages(docs)
    assert len(language.learn_languages(docs.filter("lang <> 'l0'")).names) == 3
