"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Every source has a weight and a limit, ``max_epochs`` times its size. A budget is poured out in proportion to the
weights; sources above their limit are clamped to it, and what they leave is poured over the others again, until
none is above. With a level L (budget per weight) a source gets the lesser of its limit and L times its weight, so
the clamped sources follow from L alone, and each round is one small aggregate over the table of sources. All of it
is done in whole numbers and fractions; nothing depends on the order of additions.

A source whose target is 1.4 times its size takes each text once, and four tenths of its words once more: whole
texts in the order of a seeded hash, and of the text at the border its first words. The border is found as a k-th
value is: words are counted in 65,536 bins of the hash per source, and only the bin that holds the border is opened
and put in order. So no source is ever sorted or gathered, however many rows it has.

Rows: a null text has size 0, as has one without words; such rows are returned, and take nothing. A null source is
a source, the last one. Rows that are alike in id and text share what falls to them evenly, to the nearest word. An
empty table gives an empty result. Further columns are kept, columns named as the results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.ordering import add_sequence
from tidewire.workspace import materialise

_WHITE = r"[\x20\x09-\x0D]"
_BLACK = r"[^\x20\x09-\x0D]"
#: Hexadecimal digits of a hash that tell its bin, and that are kept of it.
BIN_DIGITS, ALL_DIGITS = 4, 16
#: Sources are broadcast up to this number, at some 100 bytes each.
BROADCAST_SOURCES = 200_000


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    marks = F.length(F.regexp_replace(text, f"{_WHITE}*{_BLACK}+{_WHITE}*", "x"))
    return F.when(text.rlike(_BLACK), marks).otherwise(0).cast("bigint")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] | DataFrame,
    share: Fraction | float = Fraction(3, 2),
    max_epochs: Fraction | float = 2,
    seed: str = "mix",
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (words of its source in the mix), ``epochs`` (how
    often the mix has the whole text) and ``part`` (words that it has of it once more).

    ``weights`` are whole numbers, dealt in turn to the sources in code point order, or a table of ``source`` and
    ``weight`` (a source that is not in it weighs nothing). ``share`` is the size of the mix, as a multiple of
    all words. If all limits together are less, every source is taken to its limit.
    """
    share, most = Fraction(share).limit_denominator(10**6), Fraction(max_epochs).limit_denominator(10**6)
    if share < 0 or most < 0:
        raise ValueError("share and max_epochs must not be negative")
    sized = docs.withColumn("size", word_count(F.col(text)))
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    # the texts are read once; what the border is sought in has no text
    rows = materialise(
        sized.select(
            F.col(source).alias("source"), "size", F.substring(drawn, 1, ALL_DIGITS).alias("drawn")
        ).filter("size > 0"),
        "mix-sizes",
    )
    sources = materialise(_weighted(docs, rows, weights, source), "mix-sources")
    level = _fill(sources, share, most)
    targets = _targets(sources, level, most)
    borders = _broadcast(materialise(_borders(rows, targets), "mix-borders"))
    return _taken(sized.withColumn("__drawn", F.substring(drawn, 1, ALL_DIGITS)), borders, source, docs.columns)


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: each row of ``mix_sources`` as often as it is taken, numbered by ``repetition`` from 1; the
    last may be the first ``part`` words of the text, joined by one space."""
    part = F.col("part") > 0
    times = (F.col("epochs") + part.cast("bigint")).cast("int")
    rows = mixed.filter(times > 0).withColumn("repetition", F.explode(F.sequence(F.lit(1), times)))
    words = F.split(F.regexp_replace(F.col(text), f"^{_WHITE}+", ""), f"{_WHITE}+")
    cut = F.array_join(F.slice(words, 1, F.col("part").cast("int")), " ")
    return rows.withColumn(text, F.when(F.col("repetition") > F.col("epochs"), cut).otherwise(F.col(text)))


def _weighted(docs: DataFrame, rows: DataFrame, weights, source: str) -> DataFrame:
    """source, place (of sources in code point order, null last), weight, source_size; sources without words too."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # of all sources, of those without words too
    named = docs.select(F.col(source).alias("source")).groupBy("source").agg(F.lit(0).cast("bigint").alias("source_size"))
    sizes = sizes.unionByName(named).groupBy("source").agg(F.sum("source_size").alias("source_size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("__s"), F.col("weight").cast("bigint").alias("weight"))
        joined = sizes.join(given, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        return joined.withColumn("weight", F.coalesce("weight", F.lit(0)))
    if any(w < 0 or w != int(w) for w in weights) or not weights:
        raise ValueError("weights must be whole numbers of at least 0")
    ordered = sizes.withColumn("__last", F.col("source").isNull())
    placed = add_sequence(ordered, ["__last", "source"], "place", start=0, unique=True).drop("__last")
    dealt = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return placed.withColumn("weight", dealt.cast("bigint"))


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(38,0)")


def _clamped(level: Fraction, most: Fraction) -> Column:
    """Whether a source's limit is below what the level gives it: most * size < level * weight, in whole numbers."""
    limit = _exact(F.col("source_size")) * _whole(most.numerator * level.denominator)
    return limit < _exact(F.col("weight")) * _whole(level.numerator * most.denominator)


def _fill(sources: DataFrame, share: Fraction, most: Fraction) -> Fraction | None:
    """The level at which the budget is used up; ``None`` if every source is at its limit before."""
    size, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * int(size or 0)
    level = budget / int(weight) if weight else None
    while level is not None:
        above = _clamped(level, most)
        held, free = sources.agg(
            F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        risen = (budget - most * int(held or 0)) / int(free) if free else None
        if risen == level:
            return level
        level = risen
    return level


def _targets(sources: DataFrame, level: Fraction | None, most: Fraction) -> DataFrame:
    """source, source_size, target, epochs and rest: whole repetitions, and words to be taken once more."""

    def by(column: str, factor: Fraction) -> tuple[Column, Column]:
        top = _exact(F.col(column)) * _whole(factor.numerator)
        below = _whole(factor.denominator)
        words = F.call_function("div", top * 2 + below, below * 2)
        return top.cast("double") / F.lit(float(factor.denominator)), words

    limit, limit_words = by("source_size", most)
    if level is None:
        # sources that weigh nothing stay at nothing
        weighs = F.col("weight") > 0
        target, words = F.when(weighs, limit).otherwise(0.0), F.when(weighs, limit_words).otherwise(0)
    else:
        poured, poured_words = by("weight", level)
        above = _clamped(level, most)
        target, words = F.when(above, limit).otherwise(poured), F.when(above, limit_words).otherwise(poured_words)
    size = F.when(F.col("source_size") > 0, F.col("source_size"))
    return sources.select(
        "source",
        "source_size",
        target.alias("target"),
        F.coalesce(F.call_function("div", words, size), F.lit(0)).cast("bigint").alias("epochs"),
        F.coalesce(words % size, F.lit(0)).cast("bigint").alias("rest"),
    )


def _broadcast(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if small.count() <= BROADCAST_SOURCES else small


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _borders(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``border``, the hash at which the rest is used up, ``left`` (words that rows of that hash
    take together) and ``held`` (words that they have together). Hashes below the border are taken whole."""
    # rows with one hash count as one, so that a text that very many rows have is one row here
    hashes = rows.groupBy("source", "drawn").agg(F.sum("size").alias("words"))
    wanted = targets.filter("rest > 0").select(F.col("source").alias("__s"), F.col("rest").alias("goal"))
    bins = (
        rows.groupBy("source", F.substring("drawn", 1, BIN_DIGITS).alias("at")).agg(F.sum("size").alias("words"))
        .join(wanted, _same("source", "__s")).drop("__s")
    )
    opened = _reached(bins).select(F.col("source").alias("__s"), F.col("at").alias("bin"), F.col("over").alias("goal"))
    inside = hashes.withColumn("bin", F.substring("drawn", 1, BIN_DIGITS)).join(
        opened.withColumnRenamed("bin", "__bin"), _same("source", "__s") & (F.col("bin") == F.col("__bin"))
    )
    border = _reached(inside.select("source", F.col("drawn").alias("at"), "words", "goal"))
    named = border.select(F.col("source").alias("__s"), F.col("at").alias("border"), F.col("over").alias("left"), F.col("words").alias("held"))
    return targets.join(named, _same("source", "__s"), "left").drop("__s")


def _reached(parts: DataFrame) -> DataFrame:
    """Of each source's parts, in the order of ``at``, the one in which the words of all before and of itself first
    go beyond the goal; ``over`` is what the goal leaves for it. The goal is less than all words, so there is one."""
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("at"))
    before = F.col("upto") - F.col("words")
    return (
        parts.withColumn("upto", upto).filter((F.col("upto") > F.col("goal")) & (before <= F.col("goal")))
        .select("source", "at", "words", (F.col("goal") - before).alias("over"))
    )


def _taken(sized: DataFrame, borders: DataFrame, source: str, names: Sequence[str]) -> DataFrame:
    # the columns of the borders have names that no document has
    own = borders.select(*[F.col(c).alias(f"__{c}") for c in borders.columns])
    joined = sized.join(own, F.col(f"`{source}`").eqNullSafe(F.col("__source")), "left")
    # of the words that the rows at the border take together each takes its share, to the nearest word
    top = _exact(F.col("size")) * _exact(F.col("__left")) * 2 + _exact(F.col("__held"))
    shared = F.call_function("div", top, F.when(F.col("__held") > 0, _exact(F.col("__held")) * 2))
    part = (
        F.when((F.col("__rest") == 0) | (F.col("size") == 0), 0)
        .when(F.col("__drawn") < F.col("__border"), F.col("size"))
        .when(F.col("__drawn") == F.col("__border"), shared)
        .otherwise(0)
    )
    added = {"size", "source_size", "target", "epochs", "part"}
    return joined.select(
        *[F.col(f"`{c}`") for c in names if c.lower() not in added],
        "size",
        *[F.col(f"__{c}").alias(c) for c in ("source_size", "target")],
        F.when(F.col("size") > 0, F.col("__epochs")).otherwise(0).cast("bigint").alias("epochs"),
        part.cast("bigint").alias("part"),
    )
