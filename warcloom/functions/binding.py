"""Local names inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` with `value` computed once, however often `body` uses it.

    Catalyst pushes a filter below a projection by writing the projected expression into the filter, and does the same
    for expressions captured by a lambda. An expression that names its argument once can then at worst be computed a
    second time; one that repeats its argument grows with every step. So functions here use each argument once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
