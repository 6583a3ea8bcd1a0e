"""Typed configuration: unknown and missing fields are errors."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os
from typing import Any, get_type_hints

LAKE_TYPES = ("parquet", "zarr", "netcdf")


class ConfigError(ValueError):
    pass


def setting(default: Any = dataclasses.MISSING, help: str = "", choices: tuple | None = None, path: bool = False, factory: Any = dataclasses.MISSING):
    meta = {"help": help, "choices": choices, "path": path}
    if factory is not dataclasses.MISSING:
        return dataclasses.field(default_factory=factory, metadata=meta)
    return dataclasses.field(default=default, metadata=meta)


def _optional(kind: Any) -> bool:
    return type(None) in getattr(kind, "__args__", ())


def _moment(value: Any, where: str) -> dt.datetime:
    """ISO 8601, or what the file's format reads as a date or a time; naive UTC."""
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    try:
        value = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    except ValueError:
        value = None
    if not isinstance(value, dt.datetime):
        raise ConfigError(f"{where}: a time is needed")
    return value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value


def load(cls: type, values: dict[str, Any], where: str = "") -> Any:
    """An instance of a settings class from plain values."""
    if not isinstance(values, dict):
        raise ConfigError(f"{where or cls.__name__}: a mapping is needed")
    fields, hints = {f.name: f for f in dataclasses.fields(cls)}, get_type_hints(cls)
    if unknown := sorted(set(values) - set(fields)):
        raise ConfigError(f"{where or cls.__name__}: unknown fields {unknown}")
    out = {}
    for name, f in fields.items():
        at = f"{where}.{name}" if where else name
        if name not in values:
            if f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING:
                raise ConfigError(f"{at}: missing")
            continue
        value, kinds = values[name], [k for k in (getattr(hints[name], "__args__", None) or (hints[name],)) if k is not type(None)] if _optional(hints[name]) else [hints[name]]
        if value is None and _optional(hints[name]):
            out[name] = None
            continue
        if section := next((k for k in kinds if dataclasses.is_dataclass(k)), None):
            out[name] = load(section, value, at)
            continue
        if dt.datetime in kinds:
            out[name] = _moment(value, at)
            continue
        base = next((k for k in (bool, int, float, str, list, dict) if k in kinds or any(getattr(x, "__origin__", None) is k for x in kinds)), None)
        if base is float and isinstance(value, int) and not isinstance(value, bool):
            value = float(value)
        if base and (not isinstance(value, base) or (base is int and isinstance(value, bool))):
            raise ConfigError(f"{at}: {base.__name__} is needed")
        if f.metadata.get("choices") and value not in f.metadata["choices"]:
            raise ConfigError(f"{at}: one of {f.metadata['choices']} is needed")
        out[name] = os.path.abspath(os.path.expandvars(os.path.expanduser(value))) if f.metadata.get("path") and value else value
    return cls(**out)


@dataclasses.dataclass
class LakeSettings:
    base_dir: str = setting(help="folder of the lake, under root_dir")
    type: str = setting("parquet", "storage format", LAKE_TYPES)
    split_by: str = setting("day", "date folders", ("none", "year", "month", "day"))


@dataclasses.dataclass
class ListenerSettings:
    landing_dir: str = setting("notifications", "where messages land")
    download_dir: str = setting("downloads", "where files are kept")
    topic: str = setting("origin/a/wis2/us-noaa-nws/data/core/weather/#", "topic filter")


@dataclasses.dataclass
class DumpSettings:
    root_path: str = setting("", "root of the dump archive")


@dataclasses.dataclass
class BufrSettings:
    catalogue: str = setting("", "YAML file of message types", path=True)
    tables_dir: str = setting("", "folder of decoding tables, for decoders that need one", path=True)


@dataclasses.dataclass
class Settings:
    root_dir: str = setting(help="root of all relative paths", path=True)
    data_lake: LakeSettings = setting(help="the lake")
    run_for_num_sec: int | None = setting(None, "listen that long; unset: until stopped")
    not_before: dt.datetime | None = setting(None, "earliest day that a dump ingest reads")
    bufr: BufrSettings | None = setting(None, "binary bulletins")
    wis2: ListenerSettings = setting(factory=ListenerSettings, help="push ingest")
    ncep_dump: DumpSettings = setting(factory=DumpSettings, help="batch ingest")

    @property
    def lake_dir(self) -> str:
        return os.path.join(self.root_dir, self.data_lake.base_dir)


def from_file(path: str) -> Settings:
    import json

    with open(path) as f:
        if path.endswith(".json"):
            return load(Settings, json.load(f))
        import yaml

        return load(Settings, yaml.safe_load(f))


def to_dict(settings: Any) -> dict:
    return dataclasses.asdict(settings)


def describe(cls: type = Settings, indent: int = 0) -> str:
    lines = []
    hints = get_type_hints(cls)
    for f in dataclasses.fields(cls):
        kind = hints[f.name]
        name = getattr(kind, "__name__", str(kind))
        lines.append(f"{' ' * indent}{f.name}: {name}" + (f" - {f.metadata['help']}" if f.metadata.get("help") else ""))
        for part in getattr(kind, "__args__", (kind,)):
            if dataclasses.is_dataclass(part):
                lines.append(describe(part, indent + 2))
    return "\n".join(lines)


def config_path(explicit: str | None = None) -> str:
    """The given path, else AEROQUARRY_CONFIG, else the user's configuration folder."""
    home = os.environ.get("XDG_CONFIG_HOME", os.path.expanduser("~/.config"))
    return explicit or os.environ.get("AEROQUARRY_CONFIG") or os.path.join(home, "aeroquarry", "config.yaml")
