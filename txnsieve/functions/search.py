"""Binary search in a short sorted list that is part of the plan."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def listed(values: Sequence[int] | Sequence[float] | Sequence[str]) -> Column:
    """A list as one literal, however long it is."""
    kind = {str: "string", float: "double"}.get(type(values[0]) if values else int, "bigint")
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def count_at_most(bounds: Sequence[int] | Sequence[float] | Sequence[str], value: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``; 0 where it is null.

    The expression has one size whatever the number of bounds, and takes a step for each halving. Texts are
    compared by their bytes, which is the order of their code points.
    """
    sorted_bounds = listed(bounds)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(found: Column, size: Column) -> Column:
        beyond = found + size
        return F.when((beyond <= len(bounds)) & (F.get(sorted_bounds, beyond - 1) <= value), beyond).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps or [1])), F.lit(0), step)
