"""Helpers shared by the text operators: Arrow batches, word hashes, ragged gathers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.workspace import ship

#: Bytes of text worked on at once; a longer text is one piece of its own.
PIECE = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, work: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with the package at hand on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def appended(df: DataFrame, columns: str) -> T.StructType:
    """The schema of ``df`` followed by ``columns`` (DDL); columns of the same name are replaced."""
    added = T.StructType.fromDDL(columns)
    names = {f.name.lower() for f in added.fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in names] + added.fields)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` followed by ``columns``, in place of columns of the same name."""
    names = {c.lower() for c in columns}
    kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n.lower() not in names]
    every = [*kept, *columns.items()]
    return pa.RecordBatch.from_arrays([a for _, a in every], names=[n for n, _ in every])


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as 0."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus, F.lit(0))


def texts_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The text column with nulls as empty texts."""
    column = batch.column(batch.schema.names.index(name))
    return pc.fill_null(column.cast(pa.string()), "")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and where each begins (one more at the end)."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, name: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows with about ``most`` bytes of text each."""
    _, offsets = bytes_of(texts_of(batch, name))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


# ---- words and their hashes ---------------------------------------------------------------------

_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def letter_codes(lower: bool) -> np.ndarray:
    """A 64-bit code per byte, from a fixed rule; with ``lower`` A-Z have the codes of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, PIECE + 1)
        back = np.uint64(pow(int(_STEP), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for name, step in (("up", _STEP), ("down", back)):
                steps = np.full(n, step, np.uint64)
                steps[0] = 1
                _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def character_marks(characters: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[np.frombuffer(characters, np.uint8)] = True
    return marks


#: The ASCII white space that parts words.
WHITE = character_marks(b" \t\n\v\f\r")


def words_of(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte of every word (``[^\\x20\\x09-\\x0D]+``); and where each text's words begin."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = np.ones(len(data) + 1, bool)
    inside[:-1] = ~between[data]
    inside[-1] = False
    opens = inside[:-1].copy()
    opens[1:] &= ~inside[:-2]
    cuts = offsets[offsets < len(data)]
    opens[cuts] = inside[cuts]
    closes = inside[:-1] & ~inside[1:]
    ends = offsets[offsets > 0] - 1
    closes[ends] = inside[ends]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash per word, from its bytes alone."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(letter_codes(lower)[data] * up[: len(data)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * down[starts]
        found += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(found)


# ---- ragged arrays ------------------------------------------------------------------------------


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each run begins, and the total at the end."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather_runs(pool: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``pool[b : b + n]`` for every pair, on end."""
    at = starts_of(lengths)
    return pool[np.repeat(begins - at[:-1], lengths) + np.arange(at[-1])]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the place where each row begins."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
