"""Typed settings from a mapping or a JSON file, checked before any job runs."""

from __future__ import annotations

import dataclasses
import json
import typing
from pathlib import Path

_NAMES = {int: "a whole number", float: "a number", str: "a text", bool: "true or false"}


def _value(name: str, kind, value):
    if dataclasses.is_dataclass(kind):
        return typed(kind, value, name)
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin in (list, tuple):
        if not isinstance(value, list | tuple):
            raise ValueError(f"{name}: a list is expected, not {value!r}")
        return origin(_value(f"{name}[{i}]", args[0], v) for i, v in enumerate(value))
    if args and type(None) in args:
        return None if value is None else _value(name, next(a for a in args if a is not type(None)), value)
    if kind is float and type(value) is int:
        return float(value)
    if kind in _NAMES and type(value) is not kind:
        raise ValueError(f"{name}: {_NAMES[kind]} is expected, not {value!r}")
    return value


def typed(kind, mapping, name: str = "settings"):
    """An instance of the dataclass ``kind``; unknown and missing names and wrong types are errors, then its ``check`` method, if any, is run."""
    if not isinstance(mapping, dict):
        raise ValueError(f"{name}: a mapping is expected, not {mapping!r}")
    hints, fields = typing.get_type_hints(kind), {f.name: f for f in dataclasses.fields(kind)}
    if unknown := sorted(set(mapping) - set(fields)):
        raise ValueError(f"{name}: unknown {unknown}; there are {sorted(fields)}")
    lost = [n for n, f in fields.items() if n not in mapping and f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING]
    if lost:
        raise ValueError(f"{name}: missing {lost}")
    out = kind(**{n: _value(f"{name}.{n}", hints[n], v) for n, v in mapping.items()})
    if hasattr(out, "check"):
        out.check()
    return out


def read_settings(kind, path: str):
    return typed(kind, json.loads(Path(path).read_text(encoding="utf-8")), Path(path).name)
