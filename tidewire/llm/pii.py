"""Personal data in texts, disguised or not, as spans of the source.

The base kinds are patterns over the text as it is. The method then looks through disguises: a chain of
transducers rewrites the text (homoglyphs and invisible characters; spelled digits; words and brackets
for ``@`` and ``.``; letters that stand for digits) and keeps, for every rewritten stretch, where it came
from. Identifiers are detected in the result and their spans mapped back to source characters. A span that
overlaps a base span of its kind is not added, so base spans stay as they are.

Null and empty texts have no spans. Repeated rows are scanned one by one. A column of the result's name
is replaced; all other columns are kept. Spans are in code points, end exclusive, by kind as listed in
``KINDS`` and then start. Very long runs are scanned in linear time.
"""

from __future__ import annotations

import re
import string
import sys
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidewire.llm.common import bytes_of, character_marks, starts_of, word_hashes, words_of
from tidewire.llm.spans import Span, Taken, find_spans

KINDS = ("email", "ip", "card", "phone")

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str):
    """Matches of the e-mail pattern, found from each ``@`` outwards."""
    reach = 0
    at = text.find("@")
    while at >= 0:
        local = text[reach:at]
        size = len(local) - len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if size else None
        if domain:
            yield at - size, domain.end()
        reach = domain.end() if domain else at + 1
        at = text.find("@", reach)


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds: leftmost matches per kind, those that fail their check dropped."""
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in string.digits for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


# ---- transducers --------------------------------------------------------------------------------

# Letters of other scripts that look like ASCII letters.
_LOOKALIKES = dict(
    zip(
        "авекмнорстухіјѕԁԛԝАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορτυ",
        "abekmhopctyxijsdqwABEKMHOPCTYXIJSABEZHIKMNOPTYXaivoptu",
    )
)
# Characters that are not seen.
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"

# Digits as words, in English, French, German and Spanish.
_SPELLED = (
    ("zero", "zéro", "null", "cero", "oh"),
    ("one", "un", "eins", "uno"),
    ("two", "deux", "zwei", "dos"),
    ("three", "trois", "drei", "tres"),
    ("four", "quatre", "vier", "cuatro"),
    ("five", "cinq", "fünf", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sept", "sieben", "siete"),
    ("eight", "huit", "acht", "ocho"),
    ("nine", "neuf", "neun", "nueve"),
)
_VALUE = {word: str(value) for value, words in enumerate(_SPELLED) for word in words}
_NUMBER = "|".join(sorted(_VALUE, key=len, reverse=True))
_POINT = "dot|point|punto|punkt"
_MANY = r"(?:(?:double|triple)\s+)?"
# a run of number words, or a figure or plus beside which one may stand
_CHAIN = re.compile(
    rf"(?P<run>\b(?:plus\s+)?{_MANY}(?:{_NUMBER})\b(?:[\s,-]+(?:(?:{_POINT})[\s,-]+)?{_MANY}(?:{_NUMBER})\b)*)|\+?[0-9]+|\+",
    re.I,
)
_GAP = re.compile(rf"[\s,().-]*(?:(?:(?<=[\s,().-])({_POINT}))[\s,().-]+)?", re.I)
_GAP_SIGN = re.compile(r"[\s,]+")
_CHAIN_PART = re.compile(rf"\b(?:(plus)|(double|triple)\s+({_NUMBER})|({_NUMBER})|({_POINT}))\b", re.I)

_OPEN, _CLOSE = r"\s*[\[({<]\s*", r"\s*[\])}>]\s*"
_LABEL = r"[A-Za-z0-9-]+"
_DOT_SIGN = rf"{_OPEN}(?:{_POINT}|\.){_CLOSE}|(?<=[A-Za-z0-9])\s+(?:dot|punto)\s+(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])\s\.\s(?=[a-z0-9])"
# Ends of host names that are told from words of a sentence.
_ENDS = "com|net|org|edu|gov|mil|info|biz|io|co|ai|app|dev|uk|de|fr|es|eu|nl|ch|ca|au|jp|cn|br|ru|pl|se|test|example|invalid"
# Words that begin or end no host name, and ends that are words too, which "point" alone doesn't tell.
_NO_HOST = "the|a|an|this|that|these|those|some|any|every|each|one|no|what|which|another|my|your|his|her|its|our|their"
_NO_END = (
    "the|of|on|and|or|for|with|from|by|but|if|we|he|she|they|you|an|that|this|these|those|there|then|than|when|where|which|who"
    "|was|were|are|has|have|had|will|would|can|could|should|not|only|two|three|four|five|six|seven|eight|nine|ten"
)
_WORD_END = "in|it|is|at|to|so|no|be|my|us|am|as|me|do"
_WORD_DOT = rf"{_OPEN}(?:{_POINT}|\.){_CLOSE}|(?<=[A-Za-z0-9])\s+(?:{_POINT})\s+(?=[A-Za-z0-9])"
_SPACED_DOT = r"(?<=[A-Za-z0-9])\s\.\s(?=[a-z0-9])"
_BARE_POINT = re.compile(r"(?<=[A-Za-z0-9])\s+(?:point|punkt)\s+(?=[A-Za-z0-9])", re.I)
_POINT_WORD_END = re.compile(rf"\spoint\s+(?:{_WORD_END})\Z", re.I)
_SIGN = re.compile(
    rf"(?P<at>{_OPEN}(?:at|arroba|@){_CLOSE}"  # in brackets
    rf"|(?<=[A-Za-z0-9])\s+@\s*(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@\s+(?=[a-z0-9])"  # spaced out
    rf"|(?<=[A-Za-z0-9])\s+(?:at|arroba)\s+"  # words for both signs
    rf"(?=(?P<host>(?!(?:{_NO_HOST})\b(?!-)){_LABEL}(?:(?:\.|{_WORD_DOT}|{_SPACED_DOT}){_LABEL})*"
    rf"(?:(?:{_WORD_DOT})(?!(?:{_NO_END})\b)[A-Za-z]{{2,}}|(?:{_SPACED_DOT})(?:{_ENDS})))\b))"
    rf"|(?P<named>(?<=[A-Za-z0-9])\s+at\s+(?=(?:{_LABEL}\.)+(?:{_ENDS})\b))"  # after an odd name
    rf"|(?P<dot>{_DOT_SIGN})",
    re.I,
)
# what every match of the above has, told fast
_SIGN_HINT = re.compile(
    rf"[\s@\[({{<](?:\s*(?:at|arroba|@|{_POINT}|\.)\s*[\])}}>]|(?:dot|punto|\.)\s|@|\s+@"
    rf"|(?<=@)\s|(?:{_POINT})\s|at\s+(?:{_LABEL}\.)+(?:{_ENDS})\b)",
    re.I,
)
_LETTER_DIGIT = re.compile(r"([0-9]\.?)[OoIl]+(?=[0-9.])")
_LETTER_VALUE = str.maketrans("OoIl", "0011")

# between digits: spaces, dashes and dots of other kinds, entities for the signs
_PARTED = re.compile(
    "([0-9)])([\u00a0\u2000-\u200a\u202f\u205f\u3000])(?=[0-9(])|([0-9)])([\u2010-\u2015\u2212])(?=[0-9(])"
    "|([0-9])([\u00b7\u2022\u3002])(?=[0-9])"
)
_ENTITY = re.compile(r"&(?:#0*64|#x0*40|commat);|&(?:#0*46|#x0*2e|period);", re.I)

Edit = tuple[int, int, str]


@lru_cache(maxsize=1)
def _folding() -> tuple[re.Pattern, dict[str, str]]:
    """Characters with an ASCII reading: look-alikes, compatibility forms and digits of any script.

    The pattern takes all of them, and any other character beyond the basic plane, as one range is quicker there.
    """
    folds = dict(_LOOKALIKES) | dict.fromkeys(_INVISIBLE, "")
    for code in range(0x370, sys.maxunicode + 1):
        char = chr(code)
        if char in folds:
            continue
        digit = unicodedata.digit(char, None)
        plain = unicodedata.normalize("NFKC", char) if digit is None else str(digit)
        if len(plain) == 1 and plain != char and 33 <= ord(plain) < 127:
            folds[char] = plain
    plane = "".join(c for c in folds if ord(c) < 0x10000)
    return re.compile("[" + re.escape(plane) + "\U00010000-\U0010ffff]"), folds


def _fold_edits(text: str) -> list[Edit]:
    if text.isascii():
        return []
    pattern, folds = _folding()
    return [(m.start(), m.end(), folds[m[0]]) for m in pattern.finditer(text) if m[0] in folds]


def _parted_edits(text: str) -> list[Edit]:
    edits = []
    if not text.isascii():
        for m in _PARTED.finditer(text):
            kind = next(k for k in (2, 4, 6) if m[k])
            edits.append((m.start(kind), m.end(kind), {2: " ", 4: "-", 6: "."}[kind]))
    return edits


def _entity_edits(text: str) -> list[Edit]:
    if "&" not in text:
        return []
    return [(m.start(), m.end(), "@" if re.search("64|40|comm", m[0], re.I) else ".") for m in _ENTITY.finditer(text)]


def _chain_edits(text: str) -> list[Edit]:
    """Number words as figures, where another number word, a figure or a plus is next to them."""
    items = list(_CHAIN.finditer(text))
    gaps: list[re.Match | None] = [None]  # before each item, if only signs are there; and after the last
    for before, item in zip(items, items[1:]):
        gaps.append(_GAP.fullmatch(text, before.end(), item.start()) if before["run"] or item["run"] else None)
    gaps.append(None)
    edits = []
    for at, item in enumerate(items):
        if gap := gaps[at]:
            new = "." if gap[1] else _GAP_SIGN.sub(" ", gap[0])
            new = new if new.strip(" -") else new[:1] if " " not in new else " "
            if new != gap[0]:
                edits.append((gap.start(), gap.end(), new))
        if not item["run"]:
            continue
        out, words = [], 0
        for plus, times, many, one, point in _CHAIN_PART.findall(item[0]):
            if plus or point:
                out.append("+" if plus else ".")
                words += bool(plus)
            else:
                out.append(_VALUE[(many or one).lower()] * {"": 1, "double": 2, "triple": 3}[times.lower()])
                words += 1
        if words > 1 or gaps[at] or gaps[at + 1]:
            edits.append((item.start(), item.end(), "".join(out)))
    return edits


def _name_start(text: str, end: int) -> int:
    while end and text[end - 1] in _LOCAL:
        end -= 1
    return end


def _odd_name(text: str, end: int) -> bool:
    """The name that ends there isn't a word: it has a digit, ``.``, ``_`` or ``+``, or two or four letters after ``-``."""
    name = text[_name_start(text, end) : end]
    return bool(re.search(r"[0-9._+]", name.lstrip(".")) or re.search(r"-(?:[A-Za-z]{2}|[A-Za-z]{4})\Z", name))


def _points_before(text: str, end: int) -> list[tuple[int, int]]:
    """Bare ``point`` and ``punkt`` within the name that ends there."""
    found = []
    while True:
        start = _name_start(text, end)
        gap = start
        while gap and text[gap - 1].isspace():
            gap -= 1
        word = gap - 5
        if gap == start or word < 1 or text[word:gap].lower() not in ("point", "punkt") or not text[word - 1].isspace():
            return found[::-1]
        end = word
        while end and text[end - 1].isspace():
            end -= 1
        if not end or text[end - 1] not in _LOCAL:
            return found[::-1]
        found.append((end, start))


def _sign_edits(text: str) -> list[Edit]:
    if not _SIGN_HINT.search(text):
        return []
    edits = []
    for m in _SIGN.finditer(text):
        if m["named"] and not _odd_name(text, m.start()):
            continue
        if m["host"]:
            if _POINT_WORD_END.search(m["host"]) and not _odd_name(text, m.start()):
                continue
            edits += [(s, e, ".") for s, e in _points_before(text, m.start())]
        edits.append((m.start(), m.end(), "." if m["dot"] else "@"))
        if m["host"]:
            edits += [(x.start() + m.start("host"), x.end() + m.start("host"), ".") for x in _BARE_POINT.finditer(m["host"])]
    return edits


def _letter_edits(text: str) -> list[Edit]:
    return [(m.end(1), m.end(), text[m.end(1) : m.end()].translate(_LETTER_VALUE)) for m in _LETTER_DIGIT.finditer(text)]


TRANSDUCERS = (_fold_edits, _entity_edits, _parted_edits, _chain_edits, _sign_edits, _letter_edits)


class Rewritten:
    """A text after a transducer, with the way back to the source."""

    def __init__(self, text: str, edits: list[Edit]):
        self._edits, out, at, shift = edits, [], 0, 0
        self._begins: list[int] = []  # of each edit, in the result
        for start, end, new in edits:
            out += [text[at:start], new]
            self._begins.append(start + shift)
            shift += len(new) - (end - start)
            at = end
        self.text = "".join(out) + text[at:]

    def source(self, place: int, last: bool) -> int:
        """The source character of the result's character at ``place``: of an edit, its first or last."""
        at = bisect_right(self._begins, place) - 1
        while at >= 0:
            start, end, new = self._edits[at]
            begin = self._begins[at]
            if place >= begin + len(new):
                return end + place - (begin + len(new))
            if len(new) == end - start == 1:
                return start
            return end - 1 if last else start
        return place


@lru_cache(maxsize=1)
def _number_hashes() -> np.ndarray:
    forms = sorted({form for word in _VALUE for form in (word, word.upper(), word.title())})
    data, offsets = bytes_of(pa.array(forms))
    return np.unique(word_hashes(data, offsets[:-1], offsets[1:]))


#: What may stand beside spelled digits: all signs, ASCII and others, and white space of any kind.
_BETWEEN = character_marks(bytes(c for c in range(128) if not chr(c).isalnum()))
_BEYOND_WORDS = r"[^\x00-\x7f\pL\pN]+"
_FIGURES = character_marks(string.digits.encode() + b"+")


def spells_numbers(texts: pa.Array) -> np.ndarray:
    """Texts with two digits as words at least, or one and a figure or plus; only they can hold a chain.

    Folding may make digit words.
    """
    odd = pc.invert(pc.string_is_ascii(texts))
    if pc.any(odd).as_py():
        parted = pc.utf8_lower(pc.replace_substring_regex(texts.filter(odd), _BEYOND_WORDS, " "))
        texts = pc.replace_with_mask(texts, odd, parted)
    data, offsets = bytes_of(texts)
    starts, ends, firsts = words_of(data, offsets, _BETWEEN)
    numbers, hashes = _number_hashes(), word_hashes(data, starts, ends)
    known = numbers[np.minimum(np.searchsorted(numbers, hashes), len(numbers) - 1)] == hashes
    words, figures = starts_of(known), starts_of(_FIGURES[data])
    words = words[firsts[1:]] - words[firsts[:-1]]
    return (words > 1) | (words == 1) & (figures[offsets[1:]] > figures[offsets[:-1]])


def disguised_spans(text: str, spells: bool = True) -> list[tuple[str, int, int]]:
    """Identifiers of the rewritten text, as spans of the source; ``spells``: see ``spells_numbers``."""
    steps, now, spelled = [], text, []
    for transducer in TRANSDUCERS:
        if transducer is _chain_edits and not (spells or steps):
            continue
        if edits := transducer(now):
            if transducer is _chain_edits:
                spelled.append((len(steps), edits))
            steps.append(Rewritten(now, edits))
            now = steps[-1].text

    def back(start: int, end: int, count: int) -> tuple[int, int]:
        last = end - 1
        for step in reversed(steps[:count]):
            start, last = step.source(start, False), step.source(last, True)
        return start, last + 1

    if not steps:
        return []
    found = [(kind, *back(start, end, len(steps))) for kind, start, end in plain_spans(now)]
    # ten digits spelled out in a row are a number to call even without a plus
    for count, edits in spelled:
        for start, end, new in edits:
            if new.isdigit() and 10 <= len(new) <= 15:
                found.append(("phone", *back(start, end, count)))
    return found


def private_spans(text: str, spells: bool = True) -> list[Span]:
    """Base spans, and spans behind disguises that overlap no base span of their kind."""
    base = plain_spans(text)
    spans: list[Span] = [(*x, True) for x in base]
    taken = {kind: Taken((s, e) for k, s, e in base if k == kind) for kind in KINDS}
    for kind, start, end in dict.fromkeys(disguised_spans(text, spells)):
        if not taken[kind].meets(start, end):
            spans.append((kind, start, end, False))
    return sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def find_private(docs: DataFrame, text_col: str = "text", out_col: str = "private") -> DataFrame:
    """``docs`` with the personal data of each text as spans (see the module)."""
    return find_spans(docs, text_col, out_col, private_spans, spells_numbers)
