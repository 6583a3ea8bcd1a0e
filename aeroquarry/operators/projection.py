"""Column-wise filters: variables and channels."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frame import POS, REQUIRED, facts, leaves
from ..plans.registry import AndFilter, register_filter


@register_filter("variables")
class Variables(AndFilter):
    """Keeps the named variables, the position and time of each row, and the row axis."""

    def checked(self, arg):
        if isinstance(arg, str) or not isinstance(arg, (list, tuple, set)):
            raise ValueError("a list of variable paths is needed")
        names = [str(a).strip("/").replace("/", ".") for a in arg]
        if not names:
            raise ValueError("at least one variable is needed")
        return names

    def apply(self, df: DataFrame) -> DataFrame:
        have = leaves(df)
        paths = {leaf.path for leaf in have}
        if missing := sorted(set(self.arg) - paths):
            raise ValueError(f"unknown variables: {missing}")
        wanted = {*self.arg, *REQUIRED, "Location"}
        out = [F.col(POS).alias(POS, metadata=facts(df))]
        groups: dict[str | None, list] = {}
        for leaf in have:
            if leaf.path in wanted:
                groups.setdefault(leaf.group, []).append(leaf)
        for group, members in groups.items():
            cols = [F.col(m.path).alias(m.name, metadata=m.field.metadata or {}) for m in members]
            out += cols if group is None else [F.struct(*cols).alias(group)]
        return df.select(*out)


@register_filter("channels")
class Channels(AndFilter):
    """Keeps the listed channels of per-channel variables, in stored order; unknown ones are ignored."""

    def checked(self, arg):
        if not isinstance(arg, (list, tuple)) or not arg:
            raise ValueError("a list of channel numbers is needed")
        if any(isinstance(c, bool) or not isinstance(c, int) or c < 1 for c in arg):
            raise ValueError("channels are whole numbers from 1")
        if len(set(arg)) != len(arg):
            raise ValueError("channels must not repeat")
        return list(arg)

    def apply(self, df: DataFrame) -> DataFrame:
        stored = facts(df).get("channels")
        if not stored:
            warnings.warn("these observations have no channels", stacklevel=2)
            return df
        at = [i for i, c in enumerate(stored) if c in set(self.arg)]
        places = F.array(*map(F.lit, at)) if at else F.array().cast("array<int>")
        pick = lambda col: F.transform(places, lambda i: F.get(col, i))
        known = {**facts(df), "channels": [stored[i] for i in at]}
        out = [F.col(POS).alias(POS, metadata=known)]
        for field in df.schema.fields:
            if field.name == POS:
                continue
            if isinstance(field.dataType, T.StructType):
                inner = [
                    (pick(F.col(f"{field.name}.{f.name}")) if isinstance(f.dataType, T.ArrayType) else F.col(f"{field.name}.{f.name}")).alias(f.name, metadata=f.metadata or {})
                    for f in field.dataType.fields
                ]
                out.append(F.struct(*inner).alias(field.name))
            else:
                out.append(pick(F.col(field.name)).alias(field.name) if isinstance(field.dataType, T.ArrayType) else F.col(field.name))
        return df.select(*out)
