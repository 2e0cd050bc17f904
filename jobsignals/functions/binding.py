"""Evaluate a costly expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Catalyst substitutes an expression wherever it is used; a lambda variable
    keeps a costly one (a lower-cased text, say) from being recomputed.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that are computed once per row, whatever follows.

    A filter on ordinary computed columns is pushed below their projection and
    computes them again, once per condition. It is not pushed below a generator;
    filters on the other columns are.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
