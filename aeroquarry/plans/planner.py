"""Turns a list of filters into one DataFrame plan.

Order: variables, channels, the time window, other AND filters as given, then
the union of all OR conditions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame

from ..operators import projection, spatial, superob, temporal, thinning  # noqa: F401  they register their filters
from .registry import AndFilter, Filter, OrFilter, make_filter

FIRST = ("variables", "channels")


def plan(start, end, filters: Sequence[dict[str, Any]] | None) -> list[Filter]:
    given: list[tuple[str, Any]] = []
    for entry in filters or []:
        if len(entry) != 1:
            raise ValueError("each filter is a dict with exactly one key")
        given += entry.items()
    ordered = [x for name in FIRST for x in given if x[0] == name]
    ordered.append(("time_window", {"start": start, "end": end}))
    ordered += [x for x in given if x[0] not in FIRST]
    return [make_filter(name, arg) for name, arg in ordered]


def apply(df: DataFrame, start, end, filters: Sequence[dict[str, Any]] | None = None) -> DataFrame:
    steps = plan(start, end, filters)
    for step in steps:
        if isinstance(step, AndFilter):
            df = step.apply(df)
    either = [step.condition(df) for step in steps if isinstance(step, OrFilter)]
    return df.where(reduce(lambda a, b: a | b, either)) if either else df
