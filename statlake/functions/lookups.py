"""Lookups in small literal tables, evaluated inside the plan."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, functions as F


def lookup(key: Column, table: Mapping[Any, Any], default: Any = None) -> Column:
    """Value of ``key`` in a literal table, else ``default``."""
    if not table:
        return F.lit(default)
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def blank_to_null(column: Column) -> Column:
    """Trimmed text; null if nothing is left."""
    return F.nullif(F.trim(column), F.lit(""))


def truncated(column: Column, width: int = 80) -> Column:
    """Text cut to ``width`` characters, the last three being ``...`` when it was cut."""
    return (F.when(F.char_length(column) > width,
                   F.concat(F.substring(column, 1, width - 3), F.lit("...")))
            .otherwise(column))
