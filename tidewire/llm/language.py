"""Language of texts by mixture inference.

Each language has a likelihood for byte trigrams of words, learned from labelled texts. A document is a
mixture: every word comes from one language, and expectation-maximisation estimates the share of each. The
set of languages is the one with the greatest likelihood less a penalty for every further language, of the sets that
begin with the greatest shares: the best one, the best two and so on, with every language as the last. (Of all subsets a
better one exists for 0.2 % of the documents of the test tables, and for no mixture made of three of them.) Estimation
goes on until a document's likelihood rises no more.

Counts are kept in a fixed number of trigram buckets per language, added up in each task before anything is
shuffled, so the model's size depends on the number of languages alone (``BUCKETS`` * 4 bytes each).

A null text, or one with no letter, is ``und`` with score 0, as is every text when nothing could be learned.
Texts are read whole, in any length; repeated rows are judged one by one. Result columns replace columns of
the same name; other columns are kept. Equal shares go to the language that comes first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import appended, bytes_of, map_batches, pieces, starts_of, texts_of, with_columns, words_of

#: Trigram buckets per language.
BUCKETS = 1 << 16
#: Expectation-maximisation ends for a document once a step adds no more than this to its log likelihood (and no
#: more than single precision tells: ``NOISE`` per word).
GAIN, NOISE = 1e-3, 1e-7
#: Languages that may be learned: each takes ``BUCKETS`` * 4 bytes in every task.
MOST_LANGUAGES = 1000
#: Likelihoods of a word differ by no more than this, in nats.
SPREAD = np.float32(25)
#: Weight of the penalty, times the log of the number of words, for each further language.
PENALTY = 3.0

UNKNOWN = "und"

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_FOLD = np.where(_LETTERS, np.arange(256), 32).astype(np.uint32)
_FOLD[65:91] += 32


def trigrams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of the trigram around every letter byte, where each word's begin, where each text's words begin."""
    data, offsets = bytes_of(texts)
    starts, ends, firsts = words_of(data, offsets, ~_LETTERS)
    lengths = ends - starts
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), firsts
    folded = _FOLD[data]
    # capitals of Latin-1, the second byte after 0xC3
    capital = np.flatnonzero((data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[:-1] == 0xC3)) + 1
    folded[capital] += 32
    at = np.repeat(starts - starts_of(lengths)[:-1], lengths) + np.arange(lengths.sum())
    before, after = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
    before[1:], after[:-1] = folded[:-1], folded[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = 32, 32
    codes = (before[at] << np.uint32(16)) | (folded[at] << np.uint32(8)) | after[at]
    return ((codes * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), starts_of(lengths), firsts


# ---- learning -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class LanguageModel:
    """Names in order, and the log likelihood of each bucket (rows) in each language (columns)."""

    names: tuple[str, ...]
    table: np.ndarray


def learn_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """The model of all languages that label a text of ``docs``; rows without text or label teach nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "text", 1 << 19):
                buckets, words, firsts = trigrams_of(texts_of(part, "text"))
                bounds = words[firsts]
                for at, lang in enumerate(part.column(part.schema.names.index("lang")).to_pylist()):
                    if lang not in sums:
                        sums[lang] = np.zeros(BUCKETS, np.int64)
                    np.add.at(sums[lang], buckets[bounds[at] : bounds[at + 1]], 1)
        for lang, counts in sums.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(some), pa.string()),
                    "bucket": pa.array(some.astype(np.int32)),
                    "n": pa.array(counts[some]),
                }
            )

    labelled = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = map_batches(labelled.filter("text is not null and lang is not null"), count, "lang string, bucket int, n bigint")
    many = labelled.filter("text is not null and lang is not null").select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if many > MOST_LANGUAGES:
        raise ValueError(f"{lang_col!r} has more than {MOST_LANGUAGES} values: are they languages?")
    # at most BUCKETS rows per language, whatever the corpus
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs, buckets, counts = (rows.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    names = tuple(sorted(set(langs)))
    table = np.full((BUCKETS, len(names)), 0.5, np.float64)
    place = {name: at for at, name in enumerate(names)}
    table[buckets, np.array([place[x] for x in langs], np.int64)] += counts
    return LanguageModel(names, np.log(table / table.sum(0)).astype(np.float32))


# ---- inference ----------------------------------------------------------------------------------


def mixture(
    likely: np.ndarray, firsts: np.ndarray, allowed: np.ndarray, steps: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages per document and the log likelihood under them.

    ``likely``: likelihood of each word in each language, ``firsts``: where each document's words begin (no
    document is without), ``allowed``: the languages each may have. Each document goes on until it has settled, or for
    so many ``steps``.
    """
    shares = allowed / allowed.sum(1, keepdims=True)
    value = np.full(len(shares), -np.inf)
    left, sizes = np.arange(len(shares)), np.diff(firsts)
    done = 0
    while len(left):
        doc = np.repeat(np.arange(len(left)), sizes)
        starts = starts_of(sizes)[:-1]
        parts = likely * shares[left][doc].astype(np.float32)
        total = parts.sum(1)
        now = np.add.reduceat(np.log(total, dtype=np.float64), starts)
        open_ = now - value[left] > GAIN + NOISE * sizes if steps is None else np.full(len(left), done < steps)
        done += 1
        value[left] = np.maximum(now, value[left])
        if not open_.any():
            break
        parts /= total[:, None]
        new = np.add.reduceat(parts, starts, 0, dtype=np.float64) / sizes[:, None]
        new = np.maximum(new, 1e-9) * allowed[left]
        moved = new / new.sum(1, keepdims=True)
        shares[left[open_]] = moved[open_]
        if not open_.all():
            likely, left, sizes = likely[open_[doc]], left[open_], sizes[open_]
    return shares, value


def infer(model: LanguageModel, texts: pa.Array, most: int | None = None, penalty: float = PENALTY) -> np.ndarray:
    """Shares of the languages of each text, zero outside of its set; all zero if it has no word."""
    buckets, words, firsts = trigrams_of(texts)
    shares = np.zeros((len(texts), len(model.names)))
    sizes = np.diff(firsts)
    rows = np.flatnonzero(sizes)
    if not len(rows) or not model.names:
        return shares
    logs = np.add.reduceat(model.table[buckets], words[:-1], 0)
    logs -= logs.max(1, keepdims=True)
    likely = np.exp(np.maximum(logs, -SPREAD))
    bounds = starts_of(sizes[rows])
    count = len(model.names)
    every = np.ones((len(rows), count))
    full, value = mixture(likely, bounds, every)
    # no mixture has a greater likelihood: by concavity from the full one, and as no word's is above 1
    parts = likely / (likely * full[np.repeat(np.arange(len(rows)), sizes[rows])].astype(np.float32)).sum(1, keepdims=True)
    steepest = np.add.reduceat(parts, bounds[:-1], 0, dtype=np.float64).max(1) / sizes[rows]
    limit = np.minimum(value + sizes[rows] * np.log(np.maximum(steepest, 1)) + 1e-3, 0)
    rank = np.argsort(np.argsort(-full, 1, kind="stable"), 1, kind="stable")
    best = np.full(len(rows), -np.inf)
    for size in range(1, min(most or count, count) + 1):
        cost = penalty * (size - 1) * np.log(np.maximum(sizes[rows], 2))
        if size == 1:
            left = np.arange(len(rows))
            alone = np.add.reduceat(np.log(likely), bounds[:-1], 0, dtype=np.float64)
            found, value = np.eye(count)[alone.argmax(1)], alone.max(1)
        else:
            left = np.flatnonzero(limit - cost > best)
            if not len(left):
                break
            chosen = np.zeros(len(rows), bool)
            chosen[left] = True
            words_left = likely[np.repeat(chosen, sizes[rows])]
            found, value = mixture(words_left, starts_of(sizes[rows[left]]), (rank[left] < size).astype(float))
        value = value - cost[left]
        better = value > best[left]
        best[left[better]] = value[better]
        shares[rows[left[better]]] = found[better]
    return shares


def gains(model: LanguageModel, texts: pa.Array) -> np.ndarray:
    """By how many nats per trigram the best language of each word beats even odds over all buckets; 0 without words."""
    buckets, words, firsts = trigrams_of(texts)
    out = np.zeros(len(texts))
    rows = np.flatnonzero(np.diff(firsts))
    if len(rows) and model.names:
        best = np.add.reduceat(model.table[buckets], words[:-1], 0).max(1)
        counts = np.diff(words[firsts])[rows]
        out[rows] = np.add.reduceat(best, firsts[:-1][rows], dtype=np.float64) / counts + np.log(BUCKETS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def detect_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", gain: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its share) and ``languages`` (name and share of the whole set).

    ``gain`` adds a column of this name: see ``gains``.
    """
    # BUCKETS * 4 bytes per language
    shared = docs.sparkSession.sparkContext.broadcast(model)
    size = max(1 << 16, (2 << 20) // max(len(model.names), 4))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in pieces(batch, text_col, size):
                texts = texts_of(part, text_col)
                shares = infer(known, texts)
                names, scores, sets = [], [], []
                for row, text in zip(shares, texts.to_pylist()):
                    order = [i for i in np.argsort(-row, kind="stable") if row[i] > 0] if has_letter(text) else []
                    names.append(known.names[order[0]] if order else UNKNOWN)
                    scores.append(float(min(1.0, row[order[0]])) if order else 0.0)
                    sets.append([{"lang": known.names[i], "share": float(row[i])} for i in order])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                added = {
                    "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(scores, pa.float64()),
                    "languages": pa.array(sets, kind),
                }
                if gain:
                    added["gain"] = pa.array(gains(known, texts), pa.float64())
                yield with_columns(part, added)

    columns = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    columns += ", gain double" if gain else ""
    return map_batches(docs, work, appended(docs, columns))
