"""Column computation that happens exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``df`` with the ``keep`` columns and the computed ones.

    The computed columns come out of a generator of one row.  Unlike a projection it is
    never merged with the steps above it, so a costly expression is not repeated for every
    use of its result, neither in later columns nor in pushed-down filters, and the plan
    of a long chain of steps stays small.
    """
    row = F.struct(*(col.alias(name) for name, col in columns.items()))
    return df.select(*keep, F.inline(F.array(row)))
