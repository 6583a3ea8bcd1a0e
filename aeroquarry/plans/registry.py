"""Filter kinds and their registry.

An AND filter maps a frame to a frame; an OR filter gives a condition, and all
OR conditions of a call are joined by OR after every AND filter has run.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame


class FilterError(ValueError):
    """Wrong arguments of a filter."""

    def __init__(self, filter_type: str, message: str) -> None:
        super().__init__(f"{filter_type}: {message}")
        self.filter_type = filter_type


class Filter:
    name = ""

    def __init__(self, arg: Any) -> None:
        try:
            self.arg = self.checked(arg)
        except FilterError:
            raise
        except (ValueError, TypeError, KeyError) as error:
            raise FilterError(self.name, str(error)) from error

    def checked(self, arg: Any) -> Any:
        return arg


class AndFilter(Filter):
    def apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


class OrFilter(Filter):
    def condition(self, df: DataFrame) -> Column:
        raise NotImplementedError


_known: dict[str, type[Filter]] = {}


def register_filter(name: str) -> Callable[[type[Filter]], type[Filter]]:
    def add(cls: type[Filter]) -> type[Filter]:
        if not issubclass(cls, (AndFilter, OrFilter)):
            raise TypeError("a filter is an AndFilter or an OrFilter")
        cls.name = name
        _known[name] = cls
        return cls

    return add


def make_filter(name: str, arg: Any) -> Filter:
    if name not in _known:
        raise ValueError(f"unknown filter '{name}'; known: {sorted(_known)}")
    return _known[name](arg)
