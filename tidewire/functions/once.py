"""Costly expressions, evaluated once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` for costly expressions that later filters or several columns refer to.

    A filter on a computed column is normally pushed below its projection by repeating the
    expression, and nothing is shared within a filter. Repeats cost time, and can make the generated
    method too long for the JVM to compile. The output of a one-row generator is not taken apart.
    """
    named = [value.alias(name) for name, value in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*named))))
