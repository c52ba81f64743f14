import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewire.llm import bpe, queries, token_files
from tidewire.workspace import new_path

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def encoder():
    with open(BYTES, encoding="utf-8") as file:
        return bpe._load(file.read())[1]


@pytest.fixture(scope="module")
def piece_encoder():
    with open(WORDS, encoding="utf-8") as file:
        return token_files.PieceEncoder(file.read())


parts = st.sampled_from(
    ["the", "The", "ing", " ", "  ", "\n", "\t", "'s", "'T", "n't", "don't", "tion", "!!", "...", ",", "12", "½", "é", "É", "é",
     "Y̊", "Σ", "ΟΔΟΣ", "你好", "👩‍👩‍👧", "\x1c", "\x85", "\xa0", "　", "​", "<|endoftext|>", "<|ENDOFTEXT|>", "<|",
     "<|startoftext|>", "a" * 40, "_", "x_y", "(a)", "İ", "ǅ", "\x00", "٣", "﻿"]
)
texts = st.lists(parts | st.text(max_size=6), max_size=20).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=4))
def test_bytes_encode_and_decode_as_the_library_does(byte_library, encoder, some):
    ids, offsets = encoder.encode(some)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == [byte_library.encode(t, add_special_tokens=False).ids for t in some]
    decoded = bpe._decoded(encoder._vocabulary, pa.array(got, pa.list_(pa.int32()))).to_pylist()
    assert decoded == [byte_library.decode(i, skip_special_tokens=False) for i in got]


def test_every_character_is_cut_as_the_library_does(byte_library):
    """All of Unicode, each character between two letters, between two digits, and after a space."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    cutter = byte_library.pre_tokenizer
    for first in range(0, len(every), 40_000):
        text = "".join(f"a{c}a1{c}1 {c}" for c in every[first : first + 40_000])
        theirs = [text[a:b] for _, (a, b) in cutter.pre_tokenize_str(text)]
        assert bpe.cut_words(text) == theirs
    assert bpe.newer_characters()


def test_new_letters_encode_as_the_library_does(byte_library, encoder):
    some = [f"word{chr(c)}word 12{chr(c)}3 {chr(c)}{chr(c)}x" for c in (0x558, 0xC5C, 0xA7CE, 0x10940, 0x11DE0, 0x187F8, 0x1DF2B, 0x323B0)]
    ids, offsets = encoder.encode(some)
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == [byte_library.encode(t, add_special_tokens=False).ids for t in some]


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=4))
def test_pieces_encode_as_the_library_does(word_library, piece_encoder, some):
    ids, sizes = piece_encoder.encode(pa.array(some, pa.string()), 1)
    bounds = token_files.starts_of(sizes)
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [word_library.encode(t, add_special_tokens=False).ids + [1] for t in some]


def merged(vocabulary, word):
    """The plain rule: lowest rank first, leftmost among equals."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        ranks = [vocabulary.ranks.get(pair, float("inf")) for pair in zip(parts, parts[1:])]
        if min(ranks) == float("inf"):
            break
        at = ranks.index(min(ranks))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def test_agreement_is_that_of_plain_merging(encoder):
    vocabulary, rng = encoder._vocabulary, np.random.default_rng(2)
    tokens = [t for t in vocabulary.ids if len(t) < 8]
    pairs = [(tokens[i], tokens[j]) for i, j in rng.integers(0, len(tokens), (3000, 2))]
    pairs += [pair for pair in list(vocabulary.ranks)[::17]] + [(t[:1] * 2, t[:1]) for t in tokens[:300] if t[:1] * 2 in vocabulary.ids]
    for a, b in pairs:
        assert vocabulary.agree(a, b) == (merged(vocabulary, a + b) == [a, b])


def test_stores_are_emptied_without_a_trace(byte_library, encoder, piece_encoder, word_library, monkeypatch):
    monkeypatch.setattr(bpe, "STORE", 3)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    monkeypatch.setattr(token_files, "STORE", 3)
    for text in ("one two three", "four five, six", "one six <|endoftext|>", "two"):
        assert encoder.encode([text])[0].tolist() == byte_library.encode(text, add_special_tokens=False).ids
        assert piece_encoder.encode(pa.array([text]), 1)[0].tolist() == word_library.encode(text, add_special_tokens=False).ids + [1]


def test_other_kinds_of_vocabulary_are_refused():
    with open(WORDS, encoding="utf-8") as file, pytest.raises(ValueError):
        bpe.Vocabulary(file.read())


def test_odd_rows_and_broken_ids(spark, odd_docs, no_docs, byte_library):
    encoded = bpe.encode_texts(odd_docs, BYTES, out_col="spans")
    assert sorted(encoded.columns) == sorted(odd_docs.columns)
    for row in bpe.decode_ids(encoded, BYTES, "spans").collect():
        assert row.decoded == (row.text or "")
        assert row.spans == byte_library.encode(row.text or "", add_special_tokens=False).ids
    assert bpe.decode_ids(bpe.encode_texts(no_docs, BYTES), BYTES).count() == 0
    ids = spark.createDataFrame([([72, None, -3, 10**6, 73],), (None,), ([],), ([195],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode_ids(ids, BYTES).collect()] == ["ij", "", "", byte_library.decode([195])]


def test_bpe_query_against_the_library(spark, documents, byte_library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for key, text in documents:
        ids = byte_library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), sha(",".join(map(str, ids))), sha(byte_library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, queries.op9_bpe(spark, SF).collect())) == sorted(want)


# ---- files --------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=100), st.sampled_from([1, 8]))
def test_planes_round_trip(ids, unit):
    given_ = np.array(ids, "<u4")
    planes = token_files.to_planes(given_, unit, block=16)
    assert len(planes) == -(-len(ids) // 16) * 32 // unit
    assert token_files.from_planes(planes, len(ids), unit, block=16).tolist() == ids


def test_a_bit_plane_holds_one_bit_of_every_id():
    planes = token_files.to_planes(np.array([1, 0, 1, 4], "<u4"), 1, block=8)
    zstandard = pytest.importorskip("zstandard")
    kept = [zstandard.ZstdDecompressor().decompress(p)[0] if p else 0 for p in planes]
    assert kept[:3] == [0b10100000, 0, 0b00010000] and not any(kept[3:])


def expected(rows, library, end=1):
    out, at = [], 0
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("unit", [1, 8])
def test_files_round_trip(spark, documents, word_library, monkeypatch, unit):
    monkeypatch.setattr(token_files, "CHUNK", 3000)
    path = new_path(spark, "test-tokens")
    docs = spark.createDataFrame(documents[::-1], "doc_id bigint, text string")
    token_files.write_token_files(docs, path, WORDS, 1, unit=unit)
    rows = token_files.read_token_files(spark, path).collect()
    got = sorted((r.id, r.start, r.n_ids, zlib.crc32(r.ids)) for r in rows)
    assert got == expected(sorted(documents), word_library)
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert sum(r.n_docs for r in index) == len(documents)
    assert [r.start for r in index] == [0, *np.cumsum([r.n_ids for r in index])[:-1]]
    # any stretch of ids, from the chunks that hold it alone
    flat = b"".join(r.ids for r in sorted(rows, key=lambda r: r.start))
    total, middle = len(flat) // 4, index[len(index) // 2]
    for first, last in [(0, total), (0, 1), (total - 5, total + 9), (middle.start, middle.start + middle.n_ids), (7, 7), (1234, 9876), (total, total + 3)]:
        some = sorted(token_files.read_id_range(spark, path, first, last).collect(), key=lambda r: r.start)
        assert b"".join(r.ids for r in some) == flat[4 * first : 4 * last]
        held = [r for r in index if r.start < last and r.start + r.n_ids > first] if last > first else []
        assert [r.start for r in some] == [max(r.start, first) for r in held]
    with pytest.raises(ValueError):
        token_files.read_id_range(spark, path, 5, 4)


def test_files_of_odd_rows(spark, odd_docs, no_docs, word_library):
    path = new_path(spark, "test-tokens")
    token_files.write_token_files(odd_docs, path, WORDS, 1)
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 7]
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert [(r.id, r.start, r.n_ids, zlib.crc32(r.ids)) for r in rows] == expected([(r.id, texts[r.id]) for r in rows], word_library)
    path = new_path(spark, "test-tokens")
    token_files.write_token_files(no_docs, path, WORDS, 1)
    assert token_files.read_token_files(spark, path).count() == 0
    assert token_files.read_id_range(spark, path, 0, 10).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(no_docs, path, WORDS, 1, unit=2)


def test_token_file_query(spark, documents, word_library):
    got = sorted(map(tuple, queries.op8_token_files(spark, SF).collect()))
    assert got == expected(sorted(documents), word_library)
