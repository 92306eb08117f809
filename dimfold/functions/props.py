"""JSON property bags for graph vertices and edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(**fields: Column) -> Column:
    """``json_build_object``: keeps NULL fields (Spark drops them by default)."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})


def prop(properties: Column | str, key: str) -> Column:
    """``properties ->> key`` as text."""
    p = F.col(properties) if isinstance(properties, str) else properties
    return F.get_json_object(p, f"$.{key}")


def as_map(properties: Column | str) -> Column:
    """Properties as ``map<string,string>`` (nested values keep their JSON text)."""
    p = F.col(properties) if isinstance(properties, str) else properties
    return F.from_json(p, "map<string,string>")
