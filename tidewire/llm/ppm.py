"""Log probability of texts by partial matching over a byte-context trie learned from the corpus.

The model predicts each byte of a text, and its end, from the bytes before it. It looks at the longest
context (``ORDER`` bytes) first; a symbol seen there has its share of count / (total + kinds), and kinds / (total +
kinds) is the escape to the next shorter context, in which the symbols seen before are excluded. Below the
empty context all symbols left are equally likely. The trie is that of the training texts (pretrained), so a
symbol's probability depends on its context alone and is worked out once per distinct string of ``ORDER`` + 1
bytes, not once per place. A unigram base over words goes with it.

How it is spread: documents are dealt to *chunks* of bounded size by a hash. A chunk sends its distinct
strings and words, sorted and packed, to *buckets* by a hash of the last three context bytes, so that a
bucket has all contexts of order 3 and more of its strings. It adds up the counts of all chunks, works out the
probabilities and sends each chunk its own back; the chunks' rows stay packed meanwhile. Contexts of up to two bytes have 2^24 counts at most and
are broadcast. No table of the whole model is ever in one place, and nothing is cut from it.

Null texts count as empty: one end token, one end symbol. Texts are scored whole. Repeated rows are scored,
and learned, row by row. With nothing to learn from, all symbols are equally likely and the base score is 0.
Words are told apart by 62-bit hashes. Result columns are listed at ``score_texts``; of the input's columns
only the id is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import bytes_of, gather_runs, map_batches, mix, pieces, starts_of, texts_of, word_hashes, words_of
from tidewire.workspace import materialise

#: Bytes of context.
ORDER = 5
#: Bytes of text in a chunk, about.
CHUNK = 48 << 20
#: Buckets, and tasks that chunks are dealt to, at most: a chunk sends a row to every bucket.
BUCKETS, TASKS = 1 << 16, 20_000
#: Keys of a bucket's rows that are unpacked at once, besides its distinct ones.
MERGED_KEYS = 1 << 22
#: The end of a document among the words.
END = -(1 << 62)

_PACKED = "chunk int, bucket int, keys binary, counts binary"


# ---- keys of texts ------------------------------------------------------------------------------


def strings_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every byte and end of each text with its context, packed into a whole number; where each text's begin."""
    data, offsets = bytes_of(texts)
    sizes = np.diff(offsets)
    # ORDER zeros before each text and one after
    begins = starts_of(sizes + ORDER + 1)
    padded = np.zeros(begins[-1], np.int64)
    places = np.arange(len(data)) + np.repeat(begins[:-1] + ORDER - offsets[:-1], sizes)
    padded[places] = data
    keys = padded.copy()
    for step in range(1, ORDER + 1):
        keys[step:] |= padded[:-step] << (8 * step)
    bounds = starts_of(sizes + 1)
    return gather_runs(keys, begins[:-1] + ORDER, sizes + 1), bounds


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text and its end as negative keys; where each text's begin."""
    data, offsets = bytes_of(texts)
    starts, ends, firsts = words_of(data, offsets)
    keys = -1 - (word_hashes(data, starts, ends) >> np.uint64(2)).astype(np.int64)
    return np.insert(keys, firsts[1:], END), firsts + np.arange(len(firsts))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Of strings by their last three context bytes, of words by themselves."""
    own = np.where(keys >= 0, (keys >> 8) & 0xFFFFFF, keys)
    return (mix(own.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted whole numbers as differences, bytes of equal weight together."""
    steps = np.diff(keys, prepend=0)
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _unpack(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def _unpack_sorted(packed: bytes) -> np.ndarray:
    raw = _unpack(packed, np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).reshape(-1))


# ---- counting -----------------------------------------------------------------------------------


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def chunk_counts(dealt: DataFrame, buckets: int) -> DataFrame:
    """Per chunk and bucket the chunk's distinct keys and how often the training texts of the chunk have them."""

    def close(chunk: int, parts: list) -> pa.RecordBatch:
        keys, counts = _merged(parts)
        home = bucket_of(keys, buckets)
        order = np.argsort(home, kind="stable")
        home, keys, counts = home[order], keys[order], counts[order]
        cuts = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]]))
        rows = list(zip(cuts, [*cuts[1:], len(keys)]))
        made = {
            "chunk": pa.array([chunk] * len(rows), pa.int32()),
            "bucket": pa.array(home[cuts]),
            "keys": pa.array([_pack_sorted(keys[a:b]) for a, b in rows], pa.binary()),
            "counts": pa.array([_pack(counts[a:b]) for a, b in rows], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(made)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for some in pieces(batch, "text"):
                for chunk, rows in _by_chunk(some):
                    if chunk != now and parts:
                        yield close(now, parts)
                        parts = []
                    now = chunk
                    learn = rows.column(rows.schema.names.index("learn")).to_numpy(zero_copy_only=False)
                    texts = texts_of(rows, "text")
                    for keys, bounds in (strings_of(texts), tokens_of(texts)):
                        codes, known = pd.factorize(keys)
                        weights = np.repeat(learn, np.diff(bounds)).astype(float)
                        parts.append((known, np.bincount(codes, weights, len(known)).astype(np.int64)))
                    if len(parts) >= 16:
                        parts = [_merged(parts)]
        if parts:
            yield close(now, parts)

    return map_batches(dealt, count, _PACKED)


def _by_chunk(rows: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one chunk."""
    chunks = rows.column(rows.schema.names.index("chunk")).to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]])) if len(chunks) else []
    for a, b in zip(cuts, [*cuts[1:], len(chunks)]):
        yield int(chunks[a]), rows.slice(a, b - a)


# ---- probabilities ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Context:
    """Contexts of one order: sorted keys of (context, symbol) with counts, and sums per context."""

    entries: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Context:
        """From keys and counts in any order; keys that were never seen leave no trace."""
        seen = counts > 0
        if not seen.any():
            none = np.zeros(0, np.int64)
            return cls(none, none, none, none, none)
        entries, sums = _merged([(keys[seen], counts[seen])])
        above = entries >> 8
        first = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
        kinds = np.diff(np.append(first, len(entries)))
        return cls(entries, sums, above[first], np.add.reduceat(sums, first), kinds)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return _looked_up(self.entries, self.counts, keys)

    def sums(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _looked_up(self.contexts, self.totals, contexts), _looked_up(self.contexts, self.kinds, contexts)


def _looked_up(known: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The value of each key, 0 if it is not known."""
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], 0)


def short_contexts(keys: np.ndarray, counts: np.ndarray) -> list[Context]:
    """The contexts of 0, 1 and 2 bytes from counts of three bytes."""
    return [Context.of(keys & ((1 << 8 * (k + 1)) - 1), counts) for k in range(3)]


def log_probabilities(strings: np.ndarray, counts: np.ndarray, short: list[Context]) -> np.ndarray:
    """Natural log of each string's last symbol after its others.

    ``strings`` with ``counts`` must hold all strings that end in the contexts (of three bytes and more) of each.
    """
    low = lambda k: (1 << 8 * (k + 1)) - 1
    orders = [*short, *[Context.of(strings & low(k), counts) for k in range(3, ORDER + 1)]]
    out = np.zeros(len(strings))
    open_ = np.ones(len(strings), bool)
    longer_kinds, longer_here = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
    for k in range(ORDER, -1, -1):
        level = orders[k]
        own = strings & low(k)
        total, kinds = level.sums(own >> 8)
        # what the longer context has seen is out: of this level's counts, those of the longer one's symbols
        rest, fresh = total - longer_here, kinds - longer_kinds
        count = level.count(own)
        coded = open_ & (fresh > 0)
        hit = coded & (count > 0)
        out[hit] += np.log(count[hit] / (rest[hit] + fresh[hit]))
        missed = coded & ~hit
        out[missed] += np.log(fresh[missed] / (rest[missed] + fresh[missed]))
        open_ &= ~hit
        longer_kinds = kinds
        if k:
            # how often the next shorter context has the symbols of this one
            shorter = orders[k - 1].count(level.entries & low(k - 1))
            above = level.entries >> 8
            sums = np.zeros(len(level.contexts), np.int64)
            np.add.at(sums, np.searchsorted(level.contexts, above), shorter)
            longer_here = _looked_up(level.contexts, sums, own >> 8)
    out[open_] -= np.log(256 - longer_kinds[open_])
    return out


def chunk_values(counted: DataFrame, short: list[Context]) -> DataFrame:
    """For each chunk and bucket the chunk's keys and what they are worth: of strings the log probability, of words
    the count in training. Rows of chunk -1 have the number of words known to the bucket."""
    shared = counted.sparkSession.sparkContext.broadcast(short)

    def close(bucket: int, rows: list) -> Iterator[pa.RecordBatch]:
        """The rows stay packed and are gone through twice: added up, then answered. What is unpacked at once are the
        bucket's distinct keys and some rows."""
        merged, some = [], []
        for _, keys, counts in rows:
            some.append((_unpack_sorted(keys), _unpack(counts, np.int64)))
            if sum(len(k) for k, _ in some) >= MERGED_KEYS:
                merged, some = [_merged([*merged, *some])], []
        keys, counts = _merged([*merged, *some])
        words = int(np.searchsorted(keys, 0))
        values = counts.astype(np.float64)
        values[words:] = log_probabilities(keys[words:], counts[words:], shared.value)
        known = np.array([(counts[:words] > 0).sum()], np.int64)
        made: list[tuple] = [(-1, b"", b"", _pack(known))]
        held = 0
        for chunk, packed, _ in rows:
            own = _unpack_sorted(packed)
            # counts of words are whole: float32 would round those beyond 2^24
            whole = _pack(counts[np.searchsorted(keys, own[: np.searchsorted(own, 0)])])
            made.append((chunk, packed, _pack(values[np.searchsorted(keys, own)].astype(np.float32)), whole))
            held += len(own)
            if held >= MERGED_KEYS:
                yield answered(bucket, made)
                made, held = [], 0
        if made:
            yield answered(bucket, made)

    def answered(bucket: int, made: list[tuple]) -> pa.RecordBatch:
        chunks, *packed = zip(*made)
        columns = [pa.array(chunks, pa.int32()), pa.array([bucket] * len(made), pa.int32())]
        columns += [pa.array(c, pa.binary()) for c in packed]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "keys", "worth", "counts"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for chunk, bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now and rows:
                    yield from close(now, rows)
                    rows = []
                now = bucket
                rows.append((chunk, keys, counts))
        if rows:
            yield from close(now, rows)

    gathered = counted.repartition("bucket").sortWithinPartitions("bucket")
    return map_batches(gathered, work, "chunk int, bucket int, keys binary, worth binary, counts binary")


def _short_counts(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts of the last three bytes of all strings (2^24 at most), and the number of training tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for packed, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = _unpack_sorted(packed), _unpack(numbers, np.int64)
                words = int(np.searchsorted(keys, 0))
                parts += [(keys[words:] & 0xFFFFFF, counts[words:]), (np.array([-1]), counts[:words].sum(keepdims=True))]
            if parts:
                keys, counts = _merged(parts)
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys), "n": pa.array(counts)})

    rows = map_batches(counted.select("keys", "counts"), count, "key bigint, n bigint")
    found = rows.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, counts = found.column("key").to_numpy(), found.column("n").to_numpy()
    return keys[keys >= 0], counts[keys >= 0], int(counts[keys < 0].sum())


# ---- the operator -------------------------------------------------------------------------------


def score_texts(docs: DataFrame, learn_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, n_tokens (words and the end), n_known (seen in training), train_tokens,
    base_score and score, both log10 probabilities. Rows where ``learn_col`` is true are learned from."""
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(learn_col), F.lit(False)).alias("learn"),
    )
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    chunks = -(-size // CHUNK) or 1
    buckets = min(max(64, chunks), BUCKETS)
    tasks = min(chunks, TASKS)
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int"))
    # one chunk per task, or as many as there are chunks to a task, in turn
    task = F.pmod(F.col("chunk"), F.lit(tasks))
    sorted_ = dealt.repartitionById(tasks, task).sortWithinPartitions("chunk")
    counted = materialise(chunk_counts(sorted_, buckets), "ppm-counts")
    keys, counts, tokens = _short_counts(counted)
    values = materialise(chunk_values(counted, short_contexts(keys, counts)), "ppm-values")
    kinds = sum(
        int(_unpack(row["counts"], np.int64)[0]) for row in values.filter("chunk = -1").select("counts").collect()
    )  # a number per bucket
    base = np.log10(tokens + kinds + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for batch in batches:
            for chunk, rows in _by_chunk(batch):
                if chunk != now:
                    now, held, ready = chunk, [], None
                packed = rows.column(rows.schema.names.index("keys")).is_valid().to_numpy(zero_copy_only=False)
                for part, of_values in ((rows.filter(pa.array(packed)), True), (rows.filter(pa.array(~packed)), False)):
                    if of_values:
                        held += [tuple(part.column(i)[at].as_py() for i in (4, 5, 6)) for at in range(part.num_rows)]
                        continue
                    if part.num_rows and ready is None:
                        ready, held = _tables(held), []
                    for some in pieces(part, "text"):
                        yield _scores(some, ready, tokens, base)

    nothing = [F.lit(None).cast("binary").alias(c) for c in ("keys", "worth", "counts")]
    docs_ = dealt.select("chunk", F.lit(1).alias("kind"), "id", "text", *nothing)
    kind = dict(texts.dtypes)["id"]
    model = values.filter("chunk >= 0").select(
        "chunk", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("id"), F.lit("").alias("text"), "keys", "worth", "counts"
    )
    met = model.unionByName(docs_).repartitionById(tasks, task).sortWithinPartitions("chunk", "kind")
    columns = f"`{id_col}` {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return map_batches(met, score, columns)


def _tables(held: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, ...]:
    """Sorted words and counts, sorted strings and log probabilities of a chunk."""
    words, counts, strings, worths = [], [], [], []
    for packed, worth, numbers in held:
        keys, values = _unpack_sorted(packed), _unpack(worth, np.float32)
        cut = int(np.searchsorted(keys, 0))
        words.append(keys[:cut])
        counts.append(_unpack(numbers, np.int64))
        strings.append(keys[cut:])
        worths.append(values[cut:])
    out = []
    for keys, values in ((words, counts), (strings, worths)):
        joined, numbers = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(joined)
        out += [joined[order], numbers[order]]
    return tuple(out)


def _scores(rows: pa.RecordBatch, tables: tuple[np.ndarray, ...], tokens: int, base: float) -> pa.RecordBatch:
    texts = texts_of(rows, "text")
    words, counts, strings, worths = tables
    codes, known = pd.factorize(strings_of(texts)[0])
    bounds = starts_of(np.diff(bytes_of(texts)[1]) + 1)
    worth = worths[np.searchsorted(strings, known)].astype(np.float64)[codes]
    keys, firsts = tokens_of(texts)
    codes, known = pd.factorize(keys)
    count = counts[np.searchsorted(words, known)][codes]
    sizes = np.diff(firsts)
    made = {
        "id": rows.column(rows.schema.names.index("id")),
        "n_tokens": pa.array(sizes),
        "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), firsts[:-1])),
        "train_tokens": pa.array(np.full(len(sizes), tokens, np.int64)),
        "base_score": pa.array(np.add.reduceat(np.log10(count + 1.0), firsts[:-1]) - sizes * base),
        "score": pa.array(np.add.reduceat(worth, bounds[:-1]) / np.log(10)),
    }
    return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
