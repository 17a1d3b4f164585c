"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often `use` mentions it.

    Columns are expressions: a costly one used three times, or inside a lambda, would run each time.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
