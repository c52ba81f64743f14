import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_jaccard import brute
from test_leaks import folded
from test_models import made_up_languages
from tokenizers import Tokenizer

from tidewire.llm import secrets
from tidewire.workspace import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it made of it."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = materialise(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, made)
        docs = made
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns_and_run(spark, stages):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for name, (_, made) in list(stages.items())[:-1]:
        assert made.dtypes == documents.dtypes, name
    assert rows(corpus_pipeline.run(spark, SF)) == rows(stages["bpe_encode"][1])


def test_language_keeps_clean_rows(stages):
    before, after = stages["language_id"]
    lost = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert len(lost) <= 0.01 * before.count()
    assert set(rows(after)) <= set(rows(before))


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    pairs = [(r.doc_id, r.text) for r in before.collect()]
    want = {key for key, n, least in brute(pairs, 5, 80) if key == least or n == 0}
    assert {r.doc_id for r in after.collect()} == want and after.count() == len(want)
    assert len(want) < len(pairs)
    assert set(rows(after)) <= set(rows(before))


def test_rows_with_items_go(spark, stages):
    before, after = stages["decontamination"]
    items = [folded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {r.doc_id for r in before.collect() if any(i in folded(r.text) for i in items)}
    lost = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert exact and exact <= lost and len(lost) <= len(exact) + 2


def test_secrets_are_hidden_and_all_rows_stay(spark):
    before = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    after = corpus_pipeline.hide_secrets(spark, before, SF)
    texts = {r.doc_id: r.text for r in before.collect()}
    changed = 0
    for row in after.collect():
        spans = secrets.secret_spans(texts[row.doc_id])
        changed += bool(spans)
        assert (row.text != texts[row.doc_id]) == bool(spans)
        assert not secrets.secret_spans(row.text) and row.n_chars == len(row.text)
    assert changed and after.count() == before.count()


def test_ids_are_the_librarys(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in stages["bpe_encode"][1].collect():
        assert row.ids == library.encode(row.text, add_special_tokens=False).ids and row.n_tokens == len(row.ids)


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, odd_docs, SF)
        if name != "bpe_encode":
            assert made.columns == odd_docs.columns
        got = sorted((r.doc_id is None, r.doc_id or 0) for r in made.collect())
        keys = [None if none else key for none, key in got]
        want = {
            "language_id": [1, 1, 5, 7, None],
            "near_duplicates": [1, 2, 3, 4, 5, 6, 7, None],
        }.get(name, [1, 1, 2, 3, 4, 5, 6, 7, None])
        assert keys == want, name
        assert stage(spark, no_docs, SF).count() == 0


def test_mixed_texts_of_known_languages_stay(spark):
    texts = made_up_languages(5)
    third = " ".join(" ".join(text.split()[:60]) for text in list(texts.values())[:3])
    fifth = " ".join(" ".join(text.split()[:60]) for text in texts.values())
    unknown = " ".join("zq%s xv" % letter for letter in "abcdefghijklmnopqrstuvw" * 5)
    rows = [(at, text, lang) for at, (lang, text) in enumerate(texts.items())]
    rows += [(10, third, None), (11, fifth, None), (12, unknown, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.keep_known_language(spark, docs, SF).collect()}
    assert kept == {*range(5), 10, 11}


def test_labels_are_not_needed_to_pass(spark, odd_docs):
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.keep_known_language(spark, unlabelled, SF).count() == 0


def test_rows_without_words_all_stay(spark):
    """Null ids and texts with other columns that differ, blank repeats; of repeated worded rows one stays."""
    rows = [
        (None, None, "en", "s1", 1), (None, None, "fr", "s1", 1), (None, None, "en", "s2", 1),
        (4, " \n", "en", "s1", 2), (4, " \n", "en", "s1", 2), (5, "", "en", "s1", 0),
        (6, "some words here", "en", "s1", 3), (6, "some words here", "en", "s1", 3),
        (None, "a text of a null id", "en", "s1", 3), (-1, "other text of an id", "en", "s1", 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.keep_one_of_each(spark, materialise(docs, "wordless"), SF)
    expected = [r for i, r in enumerate(rows) if i != 7]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, expected))
