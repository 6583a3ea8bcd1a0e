"""The observation frame: groups of variables as top-level structs, ``_pos`` as the row order.

Table-level facts travel as metadata of the ``_pos`` column: the channel vector
and whether rows are in time order. ``_pos`` is a long in stored tables; after a
re-sort it is a struct that orders the same way.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POS = "_pos"
TIME, LATITUDE, LONGITUDE = "MetaData.dateTime", "MetaData.latitude", "MetaData.longitude"
REQUIRED = (TIME, LATITUDE, LONGITUDE)


class Leaf(NamedTuple):
    group: str | None
    name: str
    field: T.StructField

    @property
    def path(self) -> str:
        return f"{self.group}.{self.name}" if self.group else self.name

    @property
    def flat(self) -> str:
        return f"{self.group}__{self.name}" if self.group else self.name


def leaves(df: DataFrame) -> list[Leaf]:
    """All variables but ``_pos``, in stored order."""
    found: list[Leaf] = []
    for field in df.schema.fields:
        if field.name == POS:
            continue
        if isinstance(field.dataType, T.StructType):
            found += [Leaf(field.name, inner.name, inner) for inner in field.dataType.fields]
        else:
            found.append(Leaf(None, field.name, field))
    return found


def facts(df: DataFrame) -> dict:
    return dict(df.schema[POS].metadata or {})


def with_facts(df: DataFrame, **changes) -> DataFrame:
    known = {**facts(df), **changes}
    return df.withColumn(POS, F.col(POS).alias(POS, metadata=known))


def nest(df: DataFrame, variables: Iterable[Leaf], metadata: dict) -> DataFrame:
    """Back from flat columns to ``_pos`` and groups."""
    groups: dict[str | None, list[Leaf]] = {}
    for leaf in variables:
        groups.setdefault(leaf.group, []).append(leaf)
    out: list[Column] = [F.col(POS).alias(POS, metadata=metadata)]
    for group, members in groups.items():
        cols = [F.col(f"`{m.flat}`").alias(m.name, metadata=m.field.metadata or {}) for m in members]
        out += cols if group is None else [F.struct(*cols).alias(group)]
    return df.select(*out)


def finite(col: Column) -> Column:
    """Not null, NaN or infinite."""
    return F.coalesce((F.abs(col.cast("double")) < F.lit(float("inf"))) & ~F.isnan(col.cast("double")), F.lit(False))


def located(df: DataFrame) -> DataFrame:
    """Rows with a usable position."""
    return df.where(finite(F.col(LATITUDE)) & finite(F.col(LONGITUDE)))
