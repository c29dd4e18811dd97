"""Settings in layers: later ones win, tables are merged, ${NAME} is taken from the environment."""

from __future__ import annotations

import os
import re
import tomllib
from collections.abc import Mapping
from typing import Any

from ..sources.contracts import Contract

DEFAULTS: dict[str, Any] = {
    "people": {"accept": 0.90, "review": 0.75},
    "stays": {"cap_days": 45, "entries": ["CHECK_IN", "TRANSFER_IN"]},
    "links": {"days": 2, "share": 0.02},
    "visits": {"return_days": 30},
    "calendar": {"start": "2022-01-01", "end": "2027-03-31"},
    "quality": {"checks": []},
    "seeds": {},
    "sources": {},
}


def merge(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """base with the values of over; tables in both are merged, everything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def filled(value: Any, env: Mapping[str, str]) -> Any:
    """value with every ${NAME} in its texts replaced; a name that is not there is an error."""
    if isinstance(value, str):

        def one(m: re.Match) -> str:
            if m[1] not in env:
                raise KeyError(f"{m[1]} is not set")
            return env[m[1]]

        return re.sub(r"\$\{(\w+)\}", one, value)
    if isinstance(value, Mapping):
        return {k: filled(v, env) for k, v in value.items()}
    return [filled(v, env) for v in value] if isinstance(value, list) else value


def load(*layers: str | Mapping[str, Any], env: Mapping[str, str] | None = None) -> dict[str, Any]:
    """DEFAULTS under the layers (TOML files or mappings), in order."""
    out = DEFAULTS
    for layer in layers:
        if isinstance(layer, str):
            with open(layer, "rb") as f:
                layer = tomllib.load(f)
        out = merge(out, layer)
    return filled(out, os.environ if env is None else env)


def contracts(config: Mapping[str, Any]) -> dict[str, Contract]:
    """Contracts of the configured sources: format, columns (name = type) and key."""
    return {n: Contract(n, s["format"], tuple(s["columns"].items()), tuple(s["key"])) for n, s in config["sources"].items()}
