"""Dotted paths into JSON text, on the JVM's JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_path(path: str | None) -> list[str]:
    """``a.b.c`` -> its names; a blank path has none. Names reach object fields only."""
    if path is None or not path.strip():
        return []
    parts = path.split(".")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def json_path(parts: list[str]) -> str:
    """The same path in the syntax of ``get_json_object``."""
    out = "$"
    for name in parts:
        if not name or name == "*":
            raise ValueError(f"field name {name!r} cannot be addressed")
        if "'" not in name and "?" not in name:
            out += f"['{name}']"
        elif "[" not in name:
            out += f".{name}"
        else:
            raise ValueError(f"field name {name!r} cannot be addressed")
    return out


def compact_json(col: Column) -> Column:
    """Compact rendering of JSON text with key order kept; null when it is not JSON."""
    return F.get_json_object(col, "$")


def json_leaf(col: Column, parts: list[str]) -> Column:
    """Text of a leaf (raw for strings, JSON otherwise, ``null`` for a JSON null);
    SQL null when the path is missing or the document is not JSON."""
    doc = compact_json(col)
    parent = doc if len(parts) == 1 else F.get_json_object(doc, json_path(parts[:-1]))
    has_key = F.array_contains(F.json_object_keys(parent), parts[-1])
    return F.coalesce(
        F.get_json_object(doc, json_path(parts)),
        F.when(has_key, F.lit("null")),
    )
