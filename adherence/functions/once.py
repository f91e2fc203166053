"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with further columns that are computed once for each row, however
    often they are read later.

    A plain projection is merged into the expressions and filters that read
    it, and a filter on it moves below joins with the whole expression, where
    nothing is shared. ``inline`` of one struct stays an operator of its own
    (inside whole-stage codegen), which neither rule passes."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
