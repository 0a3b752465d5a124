"""Compute a value once and use it many times."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    Columns are expressions: naming one twice evaluates it twice. A lambda
    variable is a value, so an expensive argument is bound to one first.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters use as values.

    A filter on a projected column is moved below the projection with the
    column's whole expression in place of its name, once per mention. For a long
    chain of steps that multiplies the work and the plan. Generated columns are
    not moved through, so what is added here is computed once per row.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
