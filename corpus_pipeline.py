"""A corpus made ready for training: five stages over ``documents``, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored as Parquet and read again
as the next one's ``docs``. Each works on all rows that it is given, and all but the last return the columns
that they were given. An empty table passes through all of them. Further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.bpe import encode_texts
from tidewire.llm.common import table
from tidewire.llm.decontaminate import find_leaks
from tidewire.llm.jaccard import jaccard_components
from tidewire.llm.language import UNKNOWN, detect_languages, learn_languages
from tidewire.llm.secrets import redact_secrets
from tidewire.workspace import free, materialise, recorded


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in languages learned from the labelled rows of ``docs``, in one or in many. Texts that are
    null or without letters go, and those that the languages explain no better than even odds over all trigrams.
    With no labelled row nothing is known and all rows go."""
    names = docs.columns
    model = learn_languages(docs, "text", "lang")
    judged = detect_languages(docs.select(F.col("text"), F.struct(*names).alias("row")), model, gain=True)
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("gain") > 0))
    return kept.select(*[F.col("row")[c].alias(c) for c in names])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, a similarity of 0.8) the row with the least ``doc_id``, nulls last;
    of rows that repeat both id and text one. Rows without words are no copies of others, and all stay as they are."""
    names = docs.columns
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # 128 bits of id and text, a null id told from all others: no two rows that differ are taken for one
    marked = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("|"), F.col("text"))
    key = F.unhex(F.md5(marked))
    searched = docs.filter(worded)
    keyed = searched.select("doc_id", "text", key.alias("copy_key"))
    grouped = jaccard_components(keyed, size=5, percent=80, keep=["copy_key"])
    first = grouped.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = first.groupBy("component").agg(F.min("copy_key").alias("copy_key")).select("copy_key")
    rows = searched.select(key.alias("copy_key"), F.struct(*names).alias("row"))
    kept = rows.join(keys, "copy_key").dropDuplicates(["copy_key"])
    return kept.select(*[F.col("row")[c].alias(c) for c in names]).unionByName(docs.filter(~worded))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``, up to a tenth of edits."""
    names = docs.columns
    searched = docs.select(F.col("text"), F.struct(*names).alias("row"))
    found = find_leaks(searched, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(*[F.col("row")[c].alias(c) for c in names])


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; secrets give way to their kind in brackets, and ``n_chars`` follows."""
    return redact_secrets(docs, "text", "n_chars" if "n_chars" in docs.columns else None)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, n_tokens and ids of every row."""
    encoded = encode_texts(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", "text", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_language),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", hide_secrets),
    ("bpe_encode", encode),
]

#: Trained models and edit matching are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``. What a stage has stored is deleted once its result is, and its
    result once the next one is."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with recorded() as paths:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # the last path given out is that of the result
        free(spark, before + paths[:-1])
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
