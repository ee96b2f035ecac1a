"""Layered settings: ``base.yaml``, then ``<environment>.yaml``, then secrets from the environment or ``.env``.

What a setting may be is one table, ``SETTINGS``; loading checks the merged files against it and names every fault at once.
"""

from __future__ import annotations

import os
import tomllib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache
from pathlib import Path
from typing import Any

import yaml

from tidemark.platform.errors import ConfigurationFileNotFoundError, ConfigurationParseError, ConfigurationValidationError

ENVIRONMENTS = ("local", "dev", "test", "prod")
NEEDED = object()


class Secret(str):
    """Text that shows as stars where it is printed as part of something else."""

    def __repr__(self) -> str:
        return "'***'"


@dataclass(frozen=True)
class Key:
    """A setting: its type, the values it may have, its least length or the number it must be above, and its default."""

    kind: type = str
    among: tuple[str, ...] = ()
    least: int = 0
    above: int | None = None
    default: Any = NEEDED

    def fault(self, value: Any) -> str | None:
        fits = isinstance(value, str | Path) if self.kind in (Path, Secret) else type(value) is self.kind
        if not fits:
            return f"{value!r} is no {self.kind.__name__}"
        if self.among and value not in self.among:
            return f"{value!r} is none of {', '.join(self.among)}"
        if self.kind is str and len(value) < self.least:
            return f"has fewer than {self.least} characters"
        if self.above is not None and value <= self.above:
            return f"{value} is not above {self.above}"
        return None


OPTIONAL, FOLDER = Key(default=None), Key(Path)
# fixed values: sections and keys of the files, and the bounds of their values
SETTINGS: dict[str, dict[str, Key]] = {
    "application": {"name": Key(least=3), "environment": Key(among=ENVIRONMENTS), "app_version": Key(least=3)},
    "spark": {"master": Key(least=1), "session_timezone": Key(), "shuffle_partitions": Key(int, above=0), "broadcast_size_mb": Key(int, above=10), "adaptive_query_execution": Key(bool, default=True)},
    "storage": {
        "mode": Key(among=("local", "object_store"), default="local"), "lakehouse_root": FOLDER, "checkpoint_root": FOLDER, "quarantine_root": FOLDER, "snapshot_root": FOLDER,
        "endpoint": OPTIONAL, "bucket": OPTIONAL, "access_key": OPTIONAL, "secret_key": Key(Secret, default=None),
    },
    "logging": {"level": Key(among=("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")), "format": Key(among=("json", "text")), "log_directory": FOLDER, "destination": Key(among=("console", "file", "both"), default="console")},
    "kafka": {"bootstrap_servers": Key()},
    "customer": {"customers_topic": Key(), "customer_addresses_topic": Key(), "customer_consents_topic": Key()},
    "reconciliation": {"bucket_count": Key(int, above=0)},
}
#: What an object store needs besides, and where its secrets come from.
STORE_KEYS = ("endpoint", "bucket", "access_key", "secret_key")
SECRETS = {"access_key": "OBJECT_STORE_ACCESS_KEY", "secret_key": "OBJECT_STORE_SECRET_KEY"}


class Section(Mapping):
    """Settings by name, as items and as attributes; they can't be changed."""

    def __init__(self, values: Mapping[str, Any]):
        object.__setattr__(self, "_values", dict(values))

    def __getitem__(self, name: str) -> Any:
        return self._values[name]

    def __getattr__(self, name: str) -> Any:
        if name.startswith("__") or name not in self._values:
            raise AttributeError(name)
        return self._values[name]

    def __setattr__(self, name: str, value: Any) -> None:
        raise AttributeError(f"{name} can't be set")

    def __iter__(self) -> Iterator[str]:
        return iter(self._values)

    def __len__(self) -> int:
        return len(self._values)

    def __hash__(self) -> int:
        return id(self)

    def __repr__(self) -> str:
        return f"Section({self._values!r})"


Settings = Section


def section(name: str, given: Any, faults: list[str] | None = None) -> Section:
    """One section, checked. Faults are added to the list, or raised without one."""
    mine: list[str] = [] if faults is None else faults
    given = {} if given is None else given
    if not isinstance(given, Mapping):
        mine.append(f"{name}: no mapping")
        given = {}
    keys, values = SETTINGS[name], {}
    mine += [f"{name}.{k}: unknown" for k in given if k not in keys]
    for k, key in keys.items():
        value = given.get(k, key.default)
        if value is NEEDED:
            mine.append(f"{name}.{k}: missing")
        elif value is not None or key.default is NEEDED:
            if fault := key.fault(value):
                mine.append(f"{name}.{k}: {fault}")
            else:
                value = key.kind(value)
        values[k] = value
    if name == "storage" and values["mode"] == "object_store":
        mine += [f"storage.{k}: an object store needs it" for k in STORE_KEYS if values[k] is None]
    if faults is None and mine:
        raise ConfigurationValidationError("\n".join(mine))
    return Section(values)


def checked(raw: Mapping[str, Any]) -> Settings:
    faults = [f"{name}: unknown" for name in raw if name not in SETTINGS]
    found = {name: section(name, raw.get(name), faults) for name in SETTINGS}
    if faults:
        raise ConfigurationValidationError("\n".join(faults))
    return Section(found)


def _parsed(path: Path, parse, what: str) -> dict[str, Any]:
    if not path.is_file():
        raise ConfigurationFileNotFoundError(f"no {what} {path}")
    try:
        found = parse(path.read_text(encoding="utf-8"))
    except (yaml.YAMLError, tomllib.TOMLDecodeError) as error:
        raise ConfigurationParseError(f"{path} can't be read: {error}") from error
    if not isinstance(found, dict):
        raise ConfigurationParseError(f"{path} holds no mapping")
    return found


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """A new mapping: over's values win, mappings on both sides are merged in turn."""
    both = {k: merged(base[k], v) if isinstance(v, Mapping) and isinstance(base.get(k), Mapping) else v for k, v in over.items()}
    return {**base, **both}


def project_version(toml: Path) -> str:
    project = _parsed(toml, tomllib.loads, "project file").get("project")
    if not isinstance(project, dict) or "version" not in project:
        raise ConfigurationParseError(f"{toml} names no project version")
    return project["version"]


def project_root(start: Path | None = None) -> Path:
    """The nearest folder above that holds a pyproject.toml."""
    here = (start or Path.cwd()).resolve()
    for folder in (here, *here.parents):
        if (folder / "pyproject.toml").is_file():
            return folder
    raise ConfigurationFileNotFoundError(f"no pyproject.toml at or above {here}")


def _dotenv(path: Path) -> dict[str, str]:
    if not path.is_file():
        return {}
    pairs = (line.split("=", 1) for line in path.read_text(encoding="utf-8").splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip().strip("'\"") for k, v in pairs}


@cache
def _settings(environment: str, root: Path, configs: Path) -> Settings:
    layers = [_parsed(configs / f"{name}.yaml", yaml.safe_load, "configuration file") for name in ("base", environment)]
    layers.append({"application": {"app_version": project_version(root / "pyproject.toml")}})
    storage = layers[1].get("storage") or layers[0].get("storage") or {}
    if storage.get("mode", "local") == "local":
        layers.append({"storage": {k: str(root / v) for k, v in storage.items() if SETTINGS["storage"].get(k) is FOLDER and isinstance(v, str)}})
    else:
        given = {**_dotenv(root / ".env"), **os.environ}
        layers.append({"storage": {k: given[name] for k, name in SECRETS.items() if name in given}})
    raw: dict[str, Any] = {}
    for layer in layers:
        raw = merged(raw, layer)
    return checked(raw)


def get_settings(environment: str = "local", root: Path | str | None = None, configs: Path | str | None = None) -> Settings:
    """The settings of an environment; loaded once for each combination of normalised paths."""
    at = Path(root).resolve() if root else project_root()
    return _settings(environment, at, Path(configs).resolve() if configs else at / "configs")
