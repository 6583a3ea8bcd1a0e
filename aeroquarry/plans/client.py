"""The public retrieval call."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..sources.lake import Lake
from . import planner


def decode_time(value: dt.datetime | np.datetime64 | str) -> dt.datetime:
    """Naive UTC datetime; aware values are converted, strings read as ISO 8601."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif isinstance(value, np.datetime64):
        if np.isnat(value):
            raise ValueError("time is missing")
        value = value.astype("datetime64[us]").item()
    if not isinstance(value, dt.datetime):
        raise ValueError(f"unsupported time: {value!r}")
    return value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value


def get(spark: SparkSession, lake: Lake | str, data_type: str, start_time, end_time, filters: Sequence[dict[str, Any]] | None = None) -> DataFrame:
    """Observations of a type in [start, end), filtered; lazy."""
    lake = Lake(spark, lake) if isinstance(lake, str) else lake
    start, end = decode_time(start_time), decode_time(end_time)
    return planner.apply(lake.read(data_type, start, end), start, end, filters)
