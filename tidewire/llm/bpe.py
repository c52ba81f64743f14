"""Byte-pair encoding of whole texts over a trie of their distinct words, and decoding.

A byte-pair encoding has a property that makes prefixes shareable: the encoding of a prefix is that of a
shorter prefix and one *last token*, namely the one token that ends the prefix and agrees with the last
token before it (the two, encoded together, stay as they are). So each node of a trie of words needs one
state, its last token, found from its ancestors' states; the encoding of a word is read off from its node
upwards. The distinct words of a batch, sorted by bytes, are their trie in depth-first order: the path to
the current node is a stack, cut back to the prefix that the next word shares. Encodings of words seen
before are kept in a store of bounded size.

The vocabulary file is a parameter; it is read by the driver and broadcast (a few MB, whatever the corpus).
Null texts count as empty and have no ids; texts of any length are encoded whole; repeated rows are encoded
row by row. A result column replaces one of its name; other columns are kept. Ids out of the vocabulary
decode to nothing, as in the common library; null ids too.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.common import appended, gather_runs, list_array, map_batches, pieces, starts_of, texts_of, with_columns

# Fixed value: how a byte-level tokenizer cuts a text into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Letters and digits of a later edition of Unicode, which the common library takes for signs, as ranges for a
    pattern. Only characters that this Python does not know can be among them: the library is asked about those, each
    between two letters and between two digits."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    doubtful = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    from tokenizers.pre_tokenizers import ByteLevel  # on the driver alone, unless a worker is not told the answer

    cutter = ByteLevel(add_prefix_space=False, use_regex=True)
    whole: set[str] = set()
    for side in "a1":
        probe = " ".join(f"{side}{c}{side}" for c in doubtful)
        places = (place for _, place in cutter.pre_tokenize_str(probe))
        # a letter or digit of the library's stays between its like
        whole.update(probe[end - 2] for begin, end in places if end - begin - (probe[begin] == " ") == 3)
    newer = [ord(c) for c in doubtful if c not in whole]
    starts = [c for b, c in zip([-2, *newer], newer) if c != b + 1]
    ends = [c for c, d in zip(newer, [*newer[1:], -2]) if d != c + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


@lru_cache(maxsize=2)
def _cuts(newer: str) -> tuple[Callable, Callable, Callable]:
    """Whether a text has newer characters; the cut of texts without, and of texts with them."""
    plain = regex.compile(WORDS).findall
    if not newer:
        return lambda text: None, plain, plain
    # the newer ones leave both classes and join the signs
    told = WORDS.replace(r"\p{L}+", rf"[\p{{L}}--[{newer}]]+").replace(r"\p{N}+", rf"[\p{{N}}--[{newer}]]+", 1)
    told = told.replace(r"[^\p{White_Space}\p{L}\p{N}]+", rf"(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]|[{newer}])+")
    return re.compile(f"[{newer}]").search, plain, regex.compile(told, regex.V1).findall


def cut_words(text: str, newer: str | None = None) -> list[str]:
    """The words of a text in whatever script; ``newer`` as from ``newer_characters``, which is asked if it is not given."""
    has_newer, plain, told = _cuts(newer_characters() if newer is None else newer)
    return told(text) if has_newer(text) else plain(text)


# The same for texts of Latin letters and common signs, as the faster of the two libraries has it.
PLAIN_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+| ?[\d\xb2\xb3\xb9\xbc-\xbe]+"
    r"| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
_UNCOMMON = re.compile("[^\x00-\x1b\x20-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")

#: Bytes of text encoded at once: the more, the more prefixes are shared.
PIECE = 3 << 20

#: Words, and pairs of tokens, kept per worker.
STORE = 300_000
PAIRS = 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the rest from U+0100."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, the ranks of their merges, and which neighbours agree."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, cutter = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "end_of_word_suffix", "byte_fallback"))
        if model["type"] != "BPE" or not plain or spec["normalizer"] or cutter["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        if cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError("texts must be cut by the usual rule, with no space put before")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be taken as they are")
        letters = byte_letters()
        self.ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        coded = (tuple(bytes(letters[c] for c in part) for part in pair) for pair in pairs)
        self.ranks = {pair: rank for rank, pair in enumerate(coded)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.longest = max(map(len, self.ids))
        table = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        known = [table.get(i, b"") for i in range(max(table) + 1)]
        self.lengths = np.array([len(t) for t in known] + [0], np.int64)  # the last is for unknown ids
        self.begins = starts_of(self.lengths)[:-1]
        self.bytes = np.frombuffer(b"".join(known), np.uint8)
        self.splits: dict[bytes, tuple[bytes, bytes]] = {}
        for left, right in self.ranks:
            self.splits.setdefault(left + right, (left, right))
        self._right: dict[bytes, list] = {}
        self._left: dict[bytes, list] = {}
        self._agree: dict[tuple[bytes, bytes], bool] = {}

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """What the outermost part of a token is while it is put together, and the rank that ends each."""
        known = self._right if side else self._left
        if token not in known:
            steps: list[tuple[bytes, float]] = []
            if token in self.splits:
                pair = self.splits[token]
                steps = self._edge(pair[side], side)[:-1] + [(pair[side], self.ranks[pair])]
            known[token] = [*steps, (token, float("inf"))]
        return known[token]

    def _stays(self, token: bytes) -> bool:
        """Whether a token, encoded alone, is itself."""
        if token not in self.splits:
            return len(token) == 1
        left, right = self.splits[token]
        return self._stays(left) and self._stays(right) and self._meet(left, right) == self.ranks[left, right]

    def _meet(self, before: bytes, token: bytes) -> float:
        """The rank at which two neighbours join across their border, infinite if never.

        Merges are made by rising rank, so the parts at the border grow in known steps; of equal
        ranks the leftmost is made first.
        """
        rights, lefts = iter(self._edge(before, 1)), iter(self._edge(token, 0))
        (right, until), (left, till) = next(rights), next(lefts)
        while True:
            rank = self.ranks.get((right, left), float("inf"))
            if rank < until and rank <= till:
                return rank
            if until == till == float("inf"):
                return until
            if until <= till:
                right, until = next(rights)
            else:
                left, till = next(lefts)

    def agree(self, before: bytes, token: bytes) -> bool:
        """Whether the two tokens stay as they are side by side; no ``before`` at the start of a word."""
        key = (before, token)
        found = self._agree.get(key)
        if found is None:
            if len(self._agree) > PAIRS:
                self._agree.clear()
            found = self._meet(before, token) == float("inf") if before else self._stays(token)
            self._agree[key] = found
        return found

    def encode_words(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of each of the sorted words, states of shared prefixes found once."""
        path: list[bytes] = [b""]  # the last token at each depth
        previous = b""
        for word in words:
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for begin in range(max(0, end - self.longest), end):
                    token = word[begin:end]
                    if token in self.ids and self.agree(path[begin], token):
                        path.append(token)
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
            previous, out, end = word, [], len(word)
            while end:
                out.append(self.ids[path[end]])
                end -= len(path[end])
            yield out[::-1]


class _Places(dict):
    """A place for every word; words met for the first time are noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = place = len(self)
        return place


class Encoder:
    """Texts to ids, through the store of words."""

    def __init__(self, vocabulary: Vocabulary, newer: str | None = None):
        self._vocabulary, self._newer = vocabulary, newer
        self._cut_plain = re.compile(PLAIN_WORDS).findall
        special = sorted(vocabulary.added, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._forget()

    def _forget(self) -> None:
        self._places = _Places()
        self._pool, self._lengths = np.zeros(0, np.int32), np.zeros(0, np.int32)
        for text in self._vocabulary.added:
            self._places[text]
        self._learn()

    def _learn(self) -> None:
        """Encode the fresh words, in the order of their trie."""
        fresh, added = self._places.fresh, self._vocabulary.added
        ids: list[list[int]] = [[added[w]] if w in added else [] for w in fresh]
        coded = sorted((word.encode(), place) for place, word in enumerate(fresh) if word not in added)
        for (_, place), run in zip(coded, self._vocabulary.encode_words(w for w, _ in coded)):
            ids[place] = run
        self._pool = np.concatenate([self._pool, np.array([i for run in ids for i in run], np.int32)])
        self._lengths = np.concatenate([self._lengths, np.array([len(run) for run in ids], np.int32)])
        self._places.fresh = []

    def words(self, text: str) -> list[str]:
        if self._special is not None and any(t in text for t in self._vocabulary.added):
            found: list[str] = []
            for place, part in enumerate(self._special.split(text)):
                found += [part] if place % 2 else cut_words(part, self._newer)
            return found
        return cut_words(text, self._newer) if _UNCOMMON.search(text) else self._cut_plain(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where each text's begin."""
        if len(self._places) > STORE:
            self._forget()
        cut = [self.words(text) for text in texts]
        counts = np.array([len(words) for words in cut], np.int64)
        words = np.fromiter(map(self._places.__getitem__, chain.from_iterable(cut)), np.int32, int(counts.sum()))
        del cut
        if self._places.fresh:
            self._learn()
        runs = self._lengths[words].astype(np.int64)
        ids = gather_runs(self._pool, starts_of(self._lengths)[:-1][words], runs)
        return ids, starts_of(runs)[starts_of(counts)]


_loaded: dict[str, tuple[Vocabulary, Encoder]] = {}


def _load(source: str, newer: str | None = None) -> tuple[Vocabulary, Encoder]:
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _loaded:
        vocabulary = Vocabulary(source)
        _loaded[key] = (vocabulary, Encoder(vocabulary, newer))
    return _loaded[key]


def _source(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_texts(docs: DataFrame, vocabulary_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text."""
    source, newer = _source(docs.sparkSession, vocabulary_path), newer_characters()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _load(source.value, newer)
        for batch in batches:
            for part in pieces(batch, text_col, PIECE):
                ids, offsets = encoder.encode(texts_of(part, text_col).to_pylist())
                yield with_columns(part, {out_col: list_array(ids, offsets, pa.int32())})

    return map_batches(docs, work, appended(docs, f"`{out_col}` array<int>"))


def decode_ids(docs: DataFrame, vocabulary_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each row's ids, special tokens included; broken UTF-8 becomes U+FFFD."""
    source = _source(docs.sparkSession, vocabulary_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = _load(source.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                yield with_columns(part, {out_col: _decoded(vocabulary, part.column(part.schema.names.index(ids_col)))})

    return map_batches(docs, work, appended(docs, f"`{out_col}` string"))


def _decoded(vocabulary: Vocabulary, lists: pa.Array) -> pa.Array:
    flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat[(flat < 0) | (flat >= len(vocabulary.lengths) - 1)] = -1
    lengths = vocabulary.lengths[flat]
    data = gather_runs(vocabulary.bytes, vocabulary.begins[flat], lengths).tobytes()
    offsets = starts_of(lengths)[starts_of(counts)]
    return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])], pa.string())
