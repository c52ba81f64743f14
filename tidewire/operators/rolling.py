"""Rolling mean over the last accepted rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.text import round_half_even
from tidewire.operators.ordering import (
    BUCKET_WIDTH,
    Buckets,
    KeySpread,
    _fit,
    _zones_hold,
    add_sequence,
    cut_in_buckets,
    key_spread,
)
from tidewire.spec import AVERAGE, SEQUENCE, whole_number


# Windows from here on are worked out from running sums.
LONG_WINDOW = 64


def _exact_parts(value: Column) -> tuple[Column, Column]:
    """``value`` as a part on a grid of 1/1024, where sums of usual sizes are exact, and the rest.

    The rests are so small that adding them up loses nothing that counts. Both sums together are
    thus the exact sum, rounded once, as from a compensated summation: means that lie on a rounding
    tie fall to the right side.
    """
    usual = F.abs(value) < 2.0**42
    coarse = F.rint(value * 1024.0) / 1024.0
    return F.when(usual, coarse).otherwise(value), F.when(usual, value - coarse).otherwise(0.0)


def rolling_average(
    df: DataFrame,
    seq_col: str,
    value_col: str,
    window: int,
    partition_by: Sequence[str] | None = None,
    digits: int = 4,
    name: str = AVERAGE,
    bucket_width: int = BUCKET_WIDTH,
    spread: KeySpread | None = None,
) -> DataFrame:
    """Add the mean of the last ``window`` values in sequence order, the row's own included.

    The sequence is global: rows of all entities share one window, and only rows of ``df`` take a
    place in it, so filter before. With ``partition_by`` each group has its own window. The mean is
    rounded on output only; the first rows have shorter windows.

    Rows are cut into bounded stretches of the sequence, and the end of each stretch is copied into
    the next one, which gives every window its full frame within one task: one shuffle, no
    one-partition window, and no task holds a whole group. A window that is long against a stretch is
    the difference of two sums over all rows before, which are brought together ``window`` rows apart: stretches
    stay as they are, however long it is (values below 2**52, no groups). ``df`` is read up to four times, so an
    expensive input should be stored first. Who knows how far the sequence reaches says so by ``spread``, which
    saves a pass (without groups).
    """
    whole_number("window", window)
    carry = window - 1
    groups = list(partition_by or ())
    if not groups and carry > bucket_width // 8:
        far = _mean_by_prefix(df, seq_col, value_col, window, name, bucket_width, spread)
        if far is not None:
            return far.withColumn(name, round_half_even(F.coalesce(name, F.lit(0.0)), digits)).select(*df.columns, name)
    if groups:
        missing = df.filter(F.col(seq_col).isNull()).count()
        if missing:
            raise ValueError(f"{seq_col!r} is NULL in {missing} rows, which thus have no place in order")
        # numbered by group first, a group of any size lies in as many stretches as it needs
        dense = add_sequence(df, [*groups, seq_col], "__dense", start=0, unique=True)
        rows = dense.count()
        width = _fit(df, rows, carry, bucket_width)
        cut = Buckets(dense, "__dense", 0, width, carry, max(rows - 1, 0) // width)
    else:
        cut = cut_in_buckets(df, seq_col, carry, bucket_width, spread)
    if cut is None:
        return df.withColumn(name, F.lit(0.0))
    # a sequence of one stretch has no ends to copy
    home = cut.bucket()
    copies = F.when(cut.in_zone(), F.array(home, home + 1)).otherwise(F.array(home))
    rows = cut.rows.withColumn("__bucket", F.explode(copies) if cut.last else home)
    order = Window.partitionBy("__bucket", *groups).orderBy(cut.key)
    value = F.col(value_col).cast("double")
    averaged = _averaged(rows, order, value, window, name, cut.width + cut.zone)
    return (
        averaged.filter(F.col("__bucket") == home)
        .withColumn(name, round_half_even(F.coalesce(name, F.lit(0.0)), digits))
        .select(*df.columns, name)
    )


def sequence_and_average(
    df: DataFrame,
    key: str,
    value_col: str,
    window: int,
    accepted_col: str,
    seq_name: str = SEQUENCE,
    digits: int = 4,
    name: str = AVERAGE,
    bucket_width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Number all rows by a unique integer ``key``, keep the accepted ones and add their rolling mean: one shuffle.

    The same as ``add_sequence``, a filter and ``rolling_average``, which shuffle once each. Here both work on the same
    stretches of the key, to which the ends of the stretches before are copied. It takes the three steps where keys lie
    too sparsely for that, where a stretch's end may hold too few accepted rows, and for long windows.
    """
    whole_number("window", window)
    if seq_name in df.columns:
        raise ValueError(f"column {seq_name!r} exists already")
    carry = window - 1
    spread = key_spread(df, key)
    accepted = F.col(accepted_col)
    cut = None
    if spread is not None and window <= LONG_WINDOW:
        width = _fit(df, spread.span, carry, bucket_width)
        zone = min(width, max(8 * carry + 64, width // 16)) if carry else 0
        cut = Buckets(df.filter(accepted), key, spread.low, width, zone, (spread.span - 1) // width)
    if cut is None or not spread.fills(cut.width) or (cut.last and carry and not _zones_hold(cut, carry)):
        numbered = add_sequence(df, key, seq_name, unique=True)
        return rolling_average(numbered.filter(accepted), seq_name, value_col, window, digits=digits, name=name)
    home = cut.bucket()
    counts = df.groupBy(home.alias("__bucket")).agg(F.count("*").alias("__rows"))
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__bucket", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    copies = F.when(cut.in_zone() & accepted, F.array(home, home + 1)).otherwise(F.array(home))
    rows = df.withColumn("__home", home).withColumn("__bucket", F.explode(copies)).join(before, "__bucket")
    own = (F.col("__bucket") == F.col("__home")).cast("bigint")
    upto = Window.partitionBy("__bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn(seq_name, F.col("__before") + F.sum(own).over(upto))
    # rows that are not accepted have a window of their own, within the same stretch
    order = Window.partitionBy("__bucket", accepted_col).orderBy(key)
    averaged = _mean_by_frame(numbered, order, F.col(value_col).cast("double"), window, name)
    return (
        averaged.filter((F.col("__bucket") == F.col("__home")) & accepted)
        .withColumn(name, round_half_even(F.coalesce(name, F.lit(0.0)), digits))
        .select(seq_name, *df.columns, name)
    )


def _averaged(rows: DataFrame, order, value: Column, window: int, name: str, most_rows: int) -> DataFrame:
    """Short windows by frames; long ones by differences, but for stretches with values that have none."""
    if window <= LONG_WINDOW:
        return _mean_by_frame(rows, order, value, window, name)
    fit = F.abs(value) < F.lit(_limit(most_rows))
    odd = rows.filter(~F.coalesce(fit, F.lit(True))).select("__bucket").distinct()
    if odd.isEmpty():
        return _mean_by_difference(rows, order, value, window, name, most_rows)
    usual = _mean_by_difference(rows.join(odd, "__bucket", "left_anti"), order, value, window, name, most_rows)
    rest = _mean_by_frame(rows.join(odd, "__bucket", "left_semi"), order, value, window, name)
    return usual.select(*rest.columns).unionByName(rest)


def _mean_by_frame(rows: DataFrame, order, value: Column, window: int, name: str) -> DataFrame:
    """Add up each row's frame. Right for all values; the work grows with the window."""
    frame = order.rowsBetween(1 - window, Window.currentRow)
    coarse, rest = _exact_parts(value)
    total = F.sum(coarse).over(frame) + F.sum(rest).over(frame)
    return rows.withColumn(name, total / F.count(value).over(frame))


def _limit(most_rows: int) -> float:
    """Running sums of values below this do not overflow."""
    return 2.0 ** (62 - 10 - most_rows.bit_length())


def _mean_by_difference(
    rows: DataFrame, order, value: Column, window: int, name: str, most_rows: int
) -> DataFrame:
    """Take running sums ``window`` rows apart. The work does not grow with the window.

    The sums are whole numbers, of 1/1024ths and of the finest fractions that cannot overflow, so
    differences are exact. Values must be below ``_limit``.
    """
    fine = float(2 ** min(52, 72 - most_rows.bit_length()))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    coarse, rest = _exact_parts(value)
    running = {
        "__coarse": F.sum((coarse * 1024.0).cast("bigint")),
        "__fine": F.sum(F.rint(rest * fine).cast("bigint")),
        "__count": F.count(value),
    }
    summed = rows.withColumns({c: F.coalesce(e.over(upto), F.lit(0)) for c, e in running.items()})
    coarse, rest, count = (F.col(c) - F.lag(c, window, 0).over(order) for c in running)
    total = coarse.cast("double") / 1024.0 + rest.cast("double") / fine
    return summed.withColumn(name, F.when(count > 0, total / count))


# The finest fraction of 1/1024ths' rests that is added up, and values up to which that is exact.
_FINE, _WHOLE = 2.0**52, 2.0**52
_SUMS = ("__coarse", "__fine", "__count", "__nan", "__up", "__down")


def _mean_by_prefix(
    df: DataFrame, seq_col: str, value_col: str, window: int, name: str, width: int, spread: KeySpread | None
) -> DataFrame | None:
    """Means as differences of sums over all rows so far, ``window`` rows apart; ``None`` if some value has no such sum.

    Totals of stretches are added up on one row per stretch, sums within a stretch by a window over it. A row's sum is
    then sent to the place ``window`` rows on, where the row there takes it off. No task holds more than a stretch and
    the sums sent to it. Values that are infinite or not a number are counted, not added.
    """
    value = F.col(value_col).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    if not df.filter(finite & (F.abs(value) >= _WHOLE)).isEmpty():
        return None
    spread = spread or key_spread(df, seq_col)
    if spread is None:
        return None
    place = "__dense"
    if spread.rows == spread.span:
        dense = df.withColumn(place, F.col(seq_col).cast("bigint") - F.lit(spread.low))
    else:
        dense = add_sequence(df, seq_col, place, start=0, unique=True)
    coarse = F.rint(value * 1024.0)
    parts = {
        "__coarse": F.when(finite, coarse.cast("bigint")),
        "__fine": F.when(finite, F.rint((value - coarse / 1024.0) * _FINE).cast("bigint")),
        "__count": F.when(value.isNotNull(), 1),
        "__nan": F.when(F.isnan(value), 1),
        "__up": F.when(value == float("inf"), 1),
        "__down": F.when(value == float("-inf"), 1),
    }
    # sums of whole numbers that 64 bits could not hold
    exact = {c: F.coalesce(e, F.lit(0)).cast("decimal(38,0)") for c, e in parts.items()}

    def stretch(at: str) -> Column:
        return F.expr(f"cast(`{at}` div {width}L as bigint)")

    rows = dense.withColumns(exact).withColumn("__bucket", stretch(place))
    totals = rows.groupBy("__bucket").agg(*[F.sum(c).alias(f"{c}_all") for c in _SUMS])
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("__bucket", *[F.coalesce(F.sum(f"{c}_all").over(earlier), F.lit(0)).alias(f"{c}_all") for c in _SUMS])
    upto = Window.partitionBy("__bucket").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.join(before, "__bucket").withColumns({c: F.sum(c).over(upto) + F.col(f"{c}_all") for c in _SUMS})
    own = summed.select(*df.columns, place, F.struct(*_SUMS).alias("__sums"), F.lit(1).alias("__own"))
    sent = summed.select((F.col(place) + window).alias(place), F.struct(*_SUMS).alias("__sums"), F.lit(0).alias("__own"))
    met = own.unionByName(sent, allowMissingColumns=True).withColumn("__bucket", stretch(place))
    # at one place there are the sum sent to it, if any, and the row
    order = Window.partitionBy("__bucket").orderBy(place, "__own")
    last = F.lag(F.struct(place, "__sums")).over(order)
    there = met.withColumn("__last", last).filter("__own = 1")

    def over_window(c: str) -> Column:
        old = F.when(F.col("__last")[place] == F.col(place), F.col("__last")["__sums"][c])
        return F.col("__sums")[c] - F.coalesce(old, F.lit(0))

    coarse, fine, count, nan, up, down = map(over_window, _SUMS)
    # both in the finer unit, rounded once, unless that is beyond 38 digits
    units = F.try_add(F.try_multiply(coarse, F.lit(int(_FINE) // 1024).cast("decimal(38,0)")), fine)
    total = F.coalesce(units.cast("double") / _FINE, coarse.cast("double") / 1024.0 + fine.cast("double") / _FINE)
    mean = (
        F.when((nan > 0) | ((up > 0) & (down > 0)), float("nan"))
        .when(up > 0, float("inf"))
        .when(down > 0, float("-inf"))
        .when(count > 0, total / count.cast("double"))
    )
    return there.withColumn(name, mean)
