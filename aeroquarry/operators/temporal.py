"""Time filters: the half-open window and closed periodic windows."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frame import POS, TIME
from ..plans.registry import AndFilter, register_filter


def _moment(value) -> dt.datetime:
    if isinstance(value, np.datetime64):
        value = value.astype("datetime64[us]").item()
    if not isinstance(value, dt.datetime):
        raise ValueError("start and end must be times")
    return value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value


def time_lit(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


@register_filter("time_window")
class TimeWindow(AndFilter):
    """start <= time < end. A plain comparison, so it is pushed into the Parquet scan; missing times drop out."""

    def checked(self, arg):
        start, end = _moment(arg["start"]), _moment(arg["end"])
        if end < start:
            raise ValueError("end lies before start")
        return start, end

    def apply(self, df: DataFrame) -> DataFrame:
        start, end = self.arg
        return df.where((F.col(TIME) >= time_lit(start)) & (F.col(TIME) < time_lit(end)))


def seconds(value) -> float:
    """Length in seconds: whole numbers are hours, floats hours cut to seconds, strings H[:M[:S]]."""
    if isinstance(value, bool):
        raise ValueError("a duration is needed")
    if isinstance(value, int):
        return value * 3600
    if isinstance(value, float):
        return int(value * 3600)
    if isinstance(value, np.timedelta64):
        return value / np.timedelta64(1, "s")
    if isinstance(value, dt.timedelta):
        return value.total_seconds()
    if isinstance(value, str):
        parts = [int(p) for p in value.split(":")]
        if len(parts) > 3:
            raise ValueError(f"unreadable duration '{value}'")
        h, m, s = (parts + [0, 0])[:3]
        return h * 3600 + m * 60 + s
    raise ValueError("a duration is needed")


@register_filter("periodic")
class Periodic(AndFilter):
    """Closed windows of a length, one every period from the first row's time up to the last row's.

    Closed form of the windows' union; the two anchors come from one small
    aggregate, run when the filter is applied, so the condition is plain numbers.
    """

    def checked(self, arg):
        period, window = seconds(arg["period"]), seconds(arg["window"])
        if period <= 0 or window <= 0:
            raise ValueError("period and window must be above zero")
        if period < window:
            raise ValueError("the window is longer than the period")
        return int(period * 1_000_000), int(window * 1_000_000)

    def apply(self, df: DataFrame) -> DataFrame:
        period, window = self.arg
        edge = lambda pick: pick(F.struct(F.col(TIME).alias("t")), POS)["t"].cast("timestamp_ntz")
        first, last = df.agg(edge(F.min_by), edge(F.max_by)).first()
        if first is None or last is None or last < first:
            return df.where(F.lit(False))
        t = F.timestamp_diff("MICROSECOND", time_lit(first), F.col(TIME))
        most = (last - first) // dt.timedelta(microseconds=period)
        k, off = F.floor(t / period), F.pmod(t, F.lit(period))
        inside = (k <= most) & (off <= window)
        if window == period:  # a window's end is the next one's start, also past the last start
            inside = inside | ((off == 0) & (k - 1 <= most))
        return df.where((F.col(TIME) >= time_lit(first)) & inside)
