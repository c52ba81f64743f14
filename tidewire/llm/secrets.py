"""Secret scans: patterns of known shape, and sliding-window entropy over candidate strings.

The base kinds are patterns. The method adds spans of kind ``entropy``: every candidate string
(a run of key-like characters) is cut into its runs of one character class, and a window slides over
each run. The window's Shannon entropy follows from counts that change by one character in and one
out, so a run of any length costs the same per character. Windows that look like words, paths of words,
names or numbers do not count; letters of one case alone always look so. UUIDs, and keys beside a filler
word whose letters follow the alphabet, are left out. Neither hides what stands beside it.

Null and empty texts have no spans. Repeated rows are scanned one by one. A column of the result's
name is replaced; all other columns are kept. Spans are in code points, end exclusive, by start and
then kind as listed in ``KINDS``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewire.llm.common import map_batches, pieces, with_columns
from tidewire.llm.spans import Span, Taken, find_spans, mask_text

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Candidate strings: runs of key-like characters.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{20,}")
#: Identifiers of no worth, and keys beside a filler word, which are made up if their letters follow the alphabet.
_UUID = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])")
_LABELLED = re.compile(r"(?:example|placeholder|changeme|dummy|sample|lorem)[/._=+-]?([A-Za-z0-9]{20,})", re.I)
_PARTS = re.compile(r"[/._=+-]+")
# letters with a number before or after, and those in one case or capitalised
_NAME = re.compile(r"[0-9]{0,4}[A-Za-z]*[0-9]{0,4}|[0-9]+")
_WORD = re.compile(r"[0-9]*(?:[A-Z]?[a-z]*|[A-Z]*)[0-9]*")


@dataclass(frozen=True)
class Window:
    """A character class, the length of the window over it, and the bits per character that tell a secret."""

    kind: str
    run: re.Pattern
    length: int
    bits: float


# A run of one class may be a run of a wider one too; each class has its own greatest entropy.
WINDOWS = (
    Window("hexadecimal", re.compile(r"[0-9a-fA-F]{20,}"), 20, 3.0),
    Window("base32", re.compile(r"[A-Z2-7]{20,}|[a-z2-7]{20,}"), 20, 3.3),
    Window("alphanumeric", re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.6),
    Window("base64", re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}"), 20, 3.65),
)


def sliding_entropy(run: str, length: int) -> Iterator[float]:
    """Shannon entropy in bits of every window of ``length`` characters, by counts in and out."""
    counts = Counter(run[:length])
    weighed = sum(n * log2(n) for n in counts.values())
    yield log2(length) - weighed / length
    for gone, come in zip(run, run[length:]):
        if gone != come:
            n, m = counts[gone], counts[come]
            weighed -= n * log2(n) - (n - 1) * log2(n - 1 or 1)
            weighed += (m + 1) * log2(m + 1) - m * log2(m or 1)
            counts[gone], counts[come] = n - 1, m + 1
        yield log2(length) - weighed / length


def worthless(candidate: str) -> list[tuple[int, int]]:
    """The stretches of a candidate that no one needs to hide, whatever stands beside them."""
    found = [m.span() for m in _UUID.finditer(candidate)]
    for m in _LABELLED.finditer(candidate):
        letters = [c for c in m[1].lower() if c.isalpha()]
        if len(letters) >= 10 and letters == sorted(letters):
            found.append(m.span())
    return sorted(found)


def wordy(window: str) -> bool:
    """Words, paths of words, names and numbers: every part between signs is a word or a number.

    Words run together have one capital in three letters at most, and vowels among the small ones.
    """
    parts = _PARTS.split(window)
    if not all(map(_NAME.fullmatch, parts)):
        return False
    if all(map(_WORD.fullmatch, parts)):
        return True
    small = [c for c in window if c.islower()]
    return 2 * sum(c.isupper() for c in window) <= len(small) <= 4 * sum(c in "aeiouy" for c in small)


def _secret_like(window: str) -> bool:
    """Secrets mix digits with letters, or capitals with small letters, otherwise than words do.

    Two digits will do in a run without signs; with fewer, or with signs, it must not be words.
    """
    digits = sum(c.isdigit() for c in window)
    if digits >= len(window) - 1:
        return False
    if digits >= 2 and window.isalnum():
        return True
    return not wordy(window)


def _remaining(candidate: str) -> Iterator[tuple[int, str]]:
    """What is left of a candidate beside its worthless stretches, and where it begins."""
    at = 0
    for start, end in [*worthless(candidate), (len(candidate),) * 2]:
        if start - at >= 20:
            yield at, candidate[at:start]
        at = max(at, end)


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Stretches of candidate strings in which some window of some class is above its threshold."""
    found = []
    for candidate in _CANDIDATE.finditer(text):
        marks = []
        for begin, rest in _remaining(candidate[0]):
            for window in WINDOWS:
                for run in window.run.finditer(rest):
                    first = last = None
                    for at, bits in enumerate(sliding_entropy(run[0], window.length)):
                        if bits >= window.bits and _secret_like(run[0][at : at + window.length]):
                            first, last = at if first is None else first, at
                    if first is not None:
                        at = candidate.start() + begin + run.start()
                        marks.append((at + first, at + last + window.length))
        reach = -1
        for start, end in sorted(marks):
            if start < reach:
                reach = max(reach, end)
                found[-1] = (found[-1][0], reach)
            else:
                found.append((start, end))
                reach = end
    return found


def secret_spans(text: str) -> list[Span]:
    """Base spans, and entropy spans that no base span overlaps."""
    spans: list[Span] = [("assign", m.start(), m.end(), True) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end(), True) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end(), True) for m in _HEX.finditer(text)]
    taken = Taken((s, e) for _, s, e, _ in spans)
    for start, end in entropy_spans(text):
        if not taken.meets(start, end):
            spans.append(("entropy", start, end, False))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def scan_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """``docs`` with the secrets of each text as spans (see the module)."""
    return find_spans(docs, text_col, out_col, secret_spans)


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; columns and rows stay.

    Texts without a secret stay as they are, null included. ``chars_col`` is set to the new length where
    a text has changed.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                names = part.schema.names
                texts = part.column(names.index(text_col)).to_pylist()
                sizes = part.column(names.index(chars_col)).to_pylist() if chars_col else []
                for at, text in enumerate(texts):
                    spans = secret_spans(text) if text else []
                    if spans:
                        texts[at] = mask_text(text, [(s, e, k) for k, s, e, _ in spans])
                        if chars_col:
                            sizes[at] = len(texts[at])
                new = {text_col: pa.array(texts, pa.string())}
                if chars_col:
                    new[chars_col] = pa.array(sizes, part.column(names.index(chars_col)).type)
                yield with_columns(part, new).select(names)

    return map_batches(docs, work, docs.schema)
