"""Spans found in texts: one column type, its digests, and the cut or masked text."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import appended, map_batches, pieces, texts_of, with_columns

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
)

Span = tuple[str, int, int, bool]


def find_spans(
    docs: DataFrame,
    text_col: str,
    out_col: str,
    finder: Callable[..., Sequence[Span]],
    hints: Callable[[pa.Array], Sequence] | None = None,
) -> DataFrame:
    """``docs`` with the spans that ``finder`` gives for each whole text, in its order.

    ``hints`` looks at many texts at once; what it gives for a text goes to ``finder`` too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text_col):
                texts = texts_of(part, text_col)
                more = zip(hints(texts)) if hints else [()] * len(texts)
                rows = [
                    [{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in finder(text, *hint)]
                    for text, hint in zip(texts.to_pylist(), more)
                ]
                yield with_columns(part, {out_col: pa.array(rows, _ARROW)})

    return map_batches(docs, work, appended(docs, f"`{out_col}` {SPANS}"))


class Taken:
    """Stretches of a text that are taken: spans put together where they overlap, looked up by halving."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self._starts: list[int] = []
        self._ends: list[int] = []
        for start, end in sorted(spans):
            if self._ends and start < self._ends[-1]:
                self._ends[-1] = max(self._ends[-1], end)
            else:
                self._starts.append(start)
                self._ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        """Whether a span overlaps any of them."""
        last = bisect_left(self._starts, end) - 1
        return last >= 0 and self._ends[last] > start


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["base"])


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == kind))).cast("bigint")


def mask_text(text: str, spans: Sequence[tuple[int, int, str]]) -> str:
    """``text`` with each stretch of overlapping spans replaced by ``[KIND]`` of its first span."""
    stretches: list[list] = []
    for start, end, kind in sorted(spans):
        if stretches and start < stretches[-1][1]:
            stretches[-1][1] = max(stretches[-1][1], end)
        else:
            stretches.append([start, end, kind])
    out, at = [], 0
    for start, end, kind in stretches:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]
