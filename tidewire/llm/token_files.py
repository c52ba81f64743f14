"""Token ids of a corpus in files of compressed bit planes, written and read by Spark.

Texts are encoded with the tokenizers library and ended with one id. Documents are put in ascending order
of their id by range; each range is one *part*, a run of *chunks* of whole documents. A chunk cuts its ids
into blocks of a fixed number of ids (the last one padded with zeros), transposes every block into planes -
plane b holds bit b (or byte b) of all its ids - and compresses each plane with zstandard. Planes of
zeros only take no bytes. Folder layout, all Parquet, so that any store Spark knows will do:

* ``chunks``: part, chunk, at (ids before it in its part), n_ids, doc_ids, doc_sizes, planes;
* ``index``: part, chunk, start (ids before it in all), n_ids, n_docs.

Documents with equal ids come one after the other, by a hash of their text; null ids come first. Null and
empty texts have the end id alone. A text of any length is one document of one chunk. An empty table makes
empty files.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.bpe import _Places, _source
from tidewire.llm.common import bytes_of, gather_runs, map_batches, pieces, starts_of, texts_of
from tidewire.workspace import small_frame

#: Ids in a block; a multiple of 8.
BLOCK = 1 << 15
#: Ids after which a chunk is closed.
CHUNK = 1 << 18
#: Word pieces kept per worker.
STORE = 1_200_000

_CHUNKS = (
    "part int, chunk int, at bigint, n_ids bigint, doc_ids array<bigint>, doc_sizes array<bigint>, planes array<binary>"
)


# ---- planes -------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, unit: int, block: int = BLOCK) -> list[bytes]:
    """The planes of all blocks, block by block; ``unit`` is 1 for bit planes and 8 for byte planes."""
    packer = zstandard.ZstdCompressor(level=1)
    count = -(-len(ids) // block)
    padded = np.zeros(count * block, "<u4")
    padded[: len(ids)] = ids
    out = []
    for rows in padded.reshape(count, block):
        octets = rows.view(np.uint8).reshape(block, 4)
        if unit == 8:
            planes = np.ascontiguousarray(octets.T)
        else:
            bits = np.unpackbits(np.ascontiguousarray(octets.T), axis=1, bitorder="little")
            # byte b of all ids, eight bits each: plane 8 * b + bit
            planes = np.packbits(bits.reshape(4, block, 8).transpose(0, 2, 1).reshape(32, block), axis=1)
        out += [packer.compress(plane.tobytes()) if plane.any() else b"" for plane in planes]
    return out


def from_planes(planes: list[bytes], n_ids: int, unit: int, block: int = BLOCK) -> np.ndarray:
    """The ids that ``to_planes`` was given."""
    unpacker = zstandard.ZstdDecompressor()
    per_block = 32 // unit
    size = block * unit // 8
    ids = np.zeros(-(-n_ids // block) * block, "<u4")
    for at in range(0, len(planes), per_block):
        octets = np.zeros((per_block, size), np.uint8)
        for row, packed in zip(octets, planes[at : at + per_block]):
            if packed:
                row[:] = np.frombuffer(unpacker.decompress(packed), np.uint8)
        if unit == 1:
            bits = np.unpackbits(octets, axis=1).reshape(4, 8, block).transpose(0, 2, 1)
            octets = np.packbits(bits.reshape(4, block * 8), axis=1, bitorder="little")
        first = at // per_block * block
        ids[first : first + block] = np.ascontiguousarray(octets.T).view("<u4").reshape(-1)
    return ids[:n_ids]


# ---- encoding -----------------------------------------------------------------------------------


class PieceEncoder:
    """Ids of texts by the tokenizers library, each piece between white space encoded once.

    The vocabulary drops white space and folds case, so a text's ids are those of its pieces, in any
    ASCII case. A piece of letters and closing signs is cut further. Fresh words of letters go to the
    library many at a time: each is one word there, ended by a token with the end-of-word mark.
    """

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(source)
        self._library.no_truncation()
        self._library.no_padding()
        self._ends = np.zeros(self._library.get_vocab_size() + 1, bool)
        for token, i in self._library.get_vocab().items():
            self._ends[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self._places = _Places()
        self._pool, self._lengths, self._begins = _NONE, _NONE, np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs_of(self, parts: list[str], at_once: int = 2000) -> Iterator[list[int]]:
        """The ids of each part; words of letters go to the library many at a time."""
        for first in range(0, len(parts), at_once):
            some = parts[first : first + at_once]
            if all(map(str.isalpha, some)):
                ids = self.whole([" ".join(some)])[0]
                cuts = (np.flatnonzero(self._ends[ids]) + 1).tolist()
                if len(cuts) == len(some):
                    yield from (ids[a:b] for a, b in zip([0, *cuts], cuts))
                    continue
            yield from self.whole(some)

    def _learn(self) -> None:
        """Places for the parts of the fresh pieces, then ids for all: parts first, pieces out of their parts."""
        place, fresh = self._places.__getitem__, self._places.fresh
        first = len(self._lengths)
        whole: dict[bool, list[int]] = {True: [], False: []}
        texts, halves = [], []
        for at, piece in enumerate(fresh):  # grows meanwhile by the parts, which are not cut again
            text = piece.decode()
            texts.append(text)
            if _SIGNS.search(piece) and len(parts := _LETTERS.split(text, 1)) == 2:
                halves.append((at, place(parts[0].encode()), place(parts[1].encode())))
            else:
                whole[text.isalpha()].append(at)
        runs: list[list[int]] = [[]] * len(fresh)
        for ats in whole.values():
            for at, run in zip(ats, self._runs_of([texts[at] for at in ats])):
                runs[at] = run
        for at, *parts in halves:
            runs[at] = [i for p in parts for i in (runs[p - first] if p >= first else self._run(p))]
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        self._begins = np.concatenate([self._begins, len(self._pool) + starts_of(lengths)[:-1]])
        self._pool = np.concatenate([self._pool, np.fromiter(chain.from_iterable(runs), np.int32, lengths.sum())])
        self._lengths = np.concatenate([self._lengths, lengths.astype(np.int32)])
        self._places.fresh = []

    def _run(self, place: int) -> list[int]:
        begin = self._begins[place]
        return self._pool[begin : begin + self._lengths[place]].tolist()

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, ``end`` after each, and how many each has."""
        if len(self._places) > STORE:
            self._forget()
        place = self._places.__getitem__
        data, offsets = bytes_of(texts)
        raw = data.tobytes()
        codes, counts, plain = [], [], {}
        for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
            text = raw[a:b]
            if b"<|" in text:  # may hold a special token, which is taken as it is written
                plain[row] = self.whole([text.decode()])[0]
                counts.append(0)
                continue
            # a mark that joins its letter may do so in one case only
            marked = b"\xcc" in text or b"\xcd" in text
            found = np.fromiter(map(place, (text if marked else text.lower()).split()), np.int32)
            codes.append(found)
            counts.append(len(found))
        if self._places.fresh:
            self._learn()
        words = np.concatenate([_NONE, *codes])
        runs = self._lengths[words].astype(np.int64)
        ids = gather_runs(self._pool, self._begins[words], runs)
        bounds = starts_of(runs)[starts_of(np.array(counts, np.int64))]
        if not plain:
            return np.insert(ids, bounds[1:], end), np.diff(bounds) + 1
        each = [plain.get(row, ids[a:b]) for row, (a, b) in enumerate(zip(bounds, bounds[1:]))]
        flat = np.concatenate([np.append(np.array(run, np.int32), end) for run in each])
        return flat, np.array([len(run) + 1 for run in each], np.int64)


#: A letter before signs that belong to no contraction always ends a word of the vocabulary.
_LETTERS = re.compile(r"(?<=[^\W\d_])(?=[.,;:!?()|*$%&#]+$)")
_SIGNS = re.compile(rb"[.,;:!?()|*$%&#]$")
_NONE = np.zeros(0, np.int32)

_encoders: dict[int, PieceEncoder] = {}


def _encoder(source: str) -> PieceEncoder:
    if hash(source) not in _encoders:
        _encoders[hash(source)] = PieceEncoder(source)
    return _encoders[hash(source)]


# ---- files --------------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: int = 1,
) -> None:
    """Encode ``docs`` and write the files to ``path`` (see the module); ``unit`` 1 for bit, 8 for byte planes."""
    if unit not in (1, 8):
        raise ValueError("planes hold bits (1) or bytes (8)")
    source = _source(docs.sparkSession, vocabulary_path)
    order = [F.col("id"), F.xxhash64("text")]
    ranged = (
        docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(source.value), TaskContext.get().partitionId()
        chunk, at, ids, keys, sizes = 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            nonlocal chunk, at, ids, keys, sizes
            flat = np.concatenate(ids)
            row = {
                "part": pa.array([part], pa.int32()),
                "chunk": pa.array([chunk], pa.int32()),
                "at": pa.array([at], pa.int64()),
                "n_ids": pa.array([len(flat)], pa.int64()),
                "doc_ids": pa.array([keys], pa.list_(pa.int64())),
                "doc_sizes": pa.array([sizes], pa.list_(pa.int64())),
                "planes": pa.array([to_planes(flat, unit)], pa.list_(pa.binary())),
            }
            chunk, at, ids, keys, sizes = chunk + 1, at + len(flat), [], [], []
            return pa.RecordBatch.from_pydict(row)

        held = 0
        for batch in batches:
            for some in pieces(batch, "text"):
                flat, counts = encoder.encode(texts_of(some, "text"), end_id)
                bounds = starts_of(counts)
                for key, a, b in zip(some.column(0).to_pylist(), bounds, bounds[1:]):
                    if held and held + b - a > CHUNK:
                        yield close()
                        held = 0
                    ids.append(flat[a:b])
                    keys.append(key)
                    sizes.append(int(b - a))
                    held += b - a
        if held:
            yield close()

    chunks = map_batches(ranged, work, _CHUNKS)
    chunks.withColumn("unit", F.lit(unit)).write.option("compression", "uncompressed").parquet(f"{path}/chunks")
    _write_index(docs.sparkSession, path)


def _write_index(spark: SparkSession, path: str) -> None:
    listed = spark.read.parquet(f"{path}/chunks").select(
        "part", "chunk", "at", "n_ids", F.size("doc_ids").cast("bigint").alias("n_docs")
    )
    parts = listed.groupBy("part").agg(F.sum("n_ids").alias("total"))
    # one row per part, that is per task that wrote: the one thing that must be seen as a whole
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    index = listed.join(F.broadcast(offsets), "part").withColumn("start", F.col("start") + F.col("at"))
    index.select("part", "chunk", "start", "n_ids", "n_docs").write.parquet(f"{path}/index")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: id, start (ids of all documents before it), n_ids, ids (little-endian, 4 bytes each)."""
    chunks = spark.read.parquet(f"{path}/chunks")
    # one row per part that was written, so of a bounded size
    parts = spark.read.parquet(f"{path}/index").filter("chunk = 0").select("part", "start")
    placed = chunks.join(F.broadcast(parts), "part").select(
        (F.col("start") + F.col("at")).alias("start"), "n_ids", "doc_ids", "doc_sizes", "planes", "unit"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, n_ids, keys, sizes, planes, unit = (column[row].as_py() for column in batch.columns)
                flat = from_planes(planes, n_ids, unit)
                bounds = starts_of(np.array(sizes, np.int64))
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(keys, pa.int64()),
                        "start": pa.array(start + bounds[:-1], pa.int64()),
                        "n_ids": pa.array(sizes, pa.int64()),
                        "ids": pa.array([flat[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                    }
                )

    return map_batches(placed, work, "id bigint, start bigint, n_ids bigint, ids binary")


def read_id_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Ids ``first`` to before ``last`` of all, by the index: ``start`` and ``ids`` (little-endian, 4 bytes each), a row
    per chunk that holds some of them. Other chunks are not opened, and those of other parts not read."""
    if not 0 <= first <= last:
        raise ValueError("a range of ids begins at 0 or later and does not end before")
    index = spark.read.parquet(f"{path}/index").filter((F.col("start") < last) & (F.col("start") + F.col("n_ids") > first))
    low, high, least, most = index.agg(F.min("part"), F.max("part"), F.min("chunk"), F.max("chunk")).first()
    if low is None or first == last:
        return small_frame(spark, [], "start bigint, ids binary")
    near = F.col("part").between(low, high)
    if low == high:
        near &= F.col("chunk").between(least, most)
    chunks = spark.read.parquet(f"{path}/chunks").filter(near).select("part", "chunk", "planes", "unit")
    hit = chunks.join(index.select("part", "chunk", "start", "n_ids"), ["part", "chunk"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                flat = from_planes(row["planes"], row["n_ids"], row["unit"])
                a, b = max(first - row["start"], 0), min(last - row["start"], row["n_ids"])
                some = {"start": pa.array([row["start"] + a], pa.int64()), "ids": pa.array([flat[a:b].tobytes()], pa.binary())}
                yield pa.RecordBatch.from_pydict(some)

    return map_batches(hit.select("start", "n_ids", "planes", "unit"), work, "start bigint, ids binary")
