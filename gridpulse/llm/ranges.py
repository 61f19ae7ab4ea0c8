"""Ranges between sorted boundary values, found by built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_below(values: Sequence[str], x: Column, also_equal: bool = False) -> Column:
    """How many of the ascending ``values`` are below ``x`` (or equal to it).

    ``values`` are SQL literals. Two levels of about the root of their number are
    searched, so a row costs some dozens of comparisons with hundreds of
    boundaries.
    """
    if not values:
        return F.lit(0)
    step = max(1, isqrt(len(values)))
    runs = [values[i : i + step] for i in range(0, len(values), step)]

    def passed(some: Column) -> Column:
        return F.size(F.filter(some, lambda v: (v <= x) if also_equal else (v < x)))

    head = passed(F.expr(f"array({', '.join(run[0] for run in runs)})"))
    whole = F.expr(f"array({', '.join(f'array({", ".join(run)})' for run in runs)})")
    inside = passed(F.element_at(whole, F.greatest(head, F.lit(1))))
    return F.when(head == 0, 0).otherwise((head - 1) * step + inside)
