"""Benchmark items within documents, up to a number of edits, by the pigeonhole principle.

An item of m bytes may differ by k = m * ``percent`` // 100 edits. Cut into k + 1 pieces, at least one piece is in
the document as it is. All pieces of all items are found in one pass by an automaton; around each hit the
item is looked for by Myers' bit-parallel distance, after a count of shared 4-byte strings that no match can
fail (each edit spoils four of them at most). Letters are compared without ASCII case, each
white space as a blank; distances are in bytes of UTF-8.

Items go to the workers in blocks of about ``ITEM_BYTES``, each of them a pass, so a large benchmark needs more
passes, not more memory. Null texts have no match; null or empty items match nothing. Repeated rows are judged one by
one; items with equal texts each match. A result column replaces one of its name; other columns stay.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import appended, map_batches, pieces, texts_of, with_columns

#: Bytes of items that are looked for in one pass.
ITEM_BYTES = 1 << 20
#: Length of the strings counted before a distance is worked out.
GRAM = 4

LEAKS = "array<struct<item:string,distance:int,start:int,end:int>>"

_FOLD = bytes([32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256)])

Leak = tuple[str, int, int, int]


def folded(text: str) -> str:
    """One character per UTF-8 byte, ASCII letters small, white space blank."""
    return text.encode().translate(_FOLD).decode("latin-1")


def edit_search(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Distance and end of the best place of ``pattern`` in ``text`` with ``most`` edits, leftmost among equals."""
    size = len(pattern)
    places: dict[str, int] = defaultdict(int)
    for at, char in enumerate(pattern):
        places[char] |= 1 << at
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best = full, 0, size, None
    for at, char in enumerate(text):
        equal = places.get(char, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(across | plus), plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
        if score <= most and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Items:
    """The items of a block, ready to be looked for."""

    def __init__(self, items: Iterable[tuple[str, str]], percent: int):
        self._items = [(name, body, len(body) * percent // 100) for name, text in items if (body := folded(text))]
        pieces_of: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at, (_, body, most) in enumerate(self._items):
            cuts = [len(body) * j // (most + 1) for j in range(most + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces_of[body[a:b]].append((at, a))
        self._automaton = ahocorasick.Automaton()
        for piece, places in pieces_of.items():
            self._automaton.add_word(piece, (len(piece), places))
        if pieces_of:
            self._automaton.make_automaton()
        self._grams: dict[int, list[str]] = {}

    def find(self, text: str) -> list[Leak]:
        """The best place of every item in the text: item, distance, start and end in code points."""
        if not text or not self._items:
            return []
        body = folded(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self._automaton.iter(body):
            for item, offset in places:
                _, pattern, most = self._items[item]
                begin = end + 1 - size - offset - most
                reach = begin + len(pattern) + 2 * most
                if item not in windows:
                    windows[item] = [[begin, reach]]
                elif begin <= windows[item][-1][1] and begin >= windows[item][-1][0]:
                    windows[item][-1][1] = max(windows[item][-1][1], reach)
                else:
                    windows[item].append([begin, reach])
        raw = text.encode() if windows else b""
        found = []
        for item, places in sorted(windows.items()):
            if best := self._best(item, body, places):
                distance, start, end = best
                points = [len(raw[:at].decode("utf-8", "ignore")) for at in (start, end)]
                found.append((self._items[item][0], distance, *points))
        return sorted(found)

    def _best(self, item: int, body: str, windows: list[list[int]]) -> tuple[int, int, int] | None:
        _, pattern, most = self._items[item]
        if item not in self._grams:
            self._grams[item] = [pattern[i : i + GRAM] for i in range(len(pattern) - GRAM + 1)]
        grams, best = self._grams[item], None
        for begin, reach in windows:
            begin = max(0, begin)
            window = body[begin:reach]
            if (at := window.find(pattern)) >= 0:
                return 0, begin + at, begin + at + len(pattern)
            here = {window[i : i + GRAM] for i in range(len(window) - GRAM + 1)}
            if sum(g in here for g in grams) < len(grams) - GRAM * most:
                continue
            limit = most if best is None else best[0] - 1
            if hit := edit_search(pattern, window, limit):
                distance, end = hit
                # the same from the end: where the match begins
                _, size = edit_search(pattern[::-1], window[max(0, end - len(pattern) - most) : end][::-1], distance)
                best = (distance, begin + end - size, begin + end)
        return best


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    percent: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    out_col: str = "leaks",
) -> DataFrame:
    """``docs`` with the items found in each whole text, by item (as text), each at its best place."""
    named = items.select(F.col(item_id_col).cast("string").alias("item"), F.col(item_text_col).alias("body"))
    named = named.filter("item is not null and length(body) > 0")
    total = named.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-total // ITEM_BYTES)
    block = F.pmod(F.xxhash64("item", "body"), F.lit(max(blocks, 1)))
    found = docs.withColumn(out_col, F.array().cast(LEAKS))
    for number in range(blocks):
        found = _add_leaks(found, named.filter(block == number), percent, text_col, out_col)
    return found


def _add_leaks(docs: DataFrame, items: DataFrame, percent: int, text_col: str, out_col: str) -> DataFrame:
    # a block of items, ITEM_BYTES or so
    rows = [(row["item"], row["body"]) for row in items.orderBy("item", "body").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Items(shared.value, percent)
        kind = pa.list_(pa.struct([("item", pa.string()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in pieces(batch, text_col):
                before = part.column(part.schema.names.index(out_col)).to_pylist()
                texts = texts_of(part, text_col).to_pylist()
                rows = [
                    (old or []) + [dict(zip(("item", "distance", "start", "end"), leak)) for leak in ready.find(text)]
                    for old, text in zip(before, texts)
                ]
                yield with_columns(part, {out_col: pa.array(rows, kind)})

    return map_batches(docs, work, appended(docs, f"`{out_col}` {LEAKS}"))
