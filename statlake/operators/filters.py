"""Row filters and geometry pruning.  All narrow; date ranges reach the Parquet scan."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fixed_values import DATE_COLUMN_CANDIDATES, GEOMETRY_COLUMNS, PUBLISHERS
from ..model import Layout, TableMeta
from ..plans.sizing import quoted


def from_source(df: DataFrame, source: str | None, column: str = "source") -> DataFrame:
    """Rows of one source, matched exactly; an unknown source gives no rows."""
    return df.filter(F.col(column) == source) if source else df


def from_publisher(df: DataFrame, publisher: str | None, column: str = "source") -> DataFrame:
    """Rows of one publisher, given by its short name or its source label."""
    return from_source(df, PUBLISHERS.get(publisher, publisher) if publisher else None, column)


def without_geometry(df: DataFrame) -> DataFrame:
    """Drop geometry columns before any action, so Parquet never decodes them."""
    return df.drop(*GEOMETRY_COLUMNS)


def resolve_date_column(meta: TableMeta | None, columns: Sequence[str]) -> str | None:
    """Date axis of a table: what its metadata says, else the first candidate it has."""
    if meta is not None:
        named = meta.date_column
        if named or "date_filter_column" in meta.table or meta.columns:
            return named
        if meta.table:
            return None
    return next((c for c in DATE_COLUMN_CANDIDATES if c in columns), None)


def date_range(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    *,
    column: str | None = None,
    meta: TableMeta | None = None,
    unreadable: str = "error",
) -> DataFrame:
    """Rows with ``start <= date <= end``; each ISO bound is optional and inclusive.

    A table without a date axis is returned whole, with a warning.  Text that is no date (``2024Q1``)
    is an error at run time, unless ``unreadable`` says to ``"keep"`` or to ``"drop"`` such rows.
    """
    if unreadable not in ("error", "keep", "drop"):
        raise ValueError("unreadable must be 'error', 'keep' or 'drop'")
    if start is None and end is None:
        return df
    for bound in (start, end):
        if bound is not None:
            datetime.fromisoformat(bound)
    column = column or resolve_date_column(meta, df.columns)
    if column is None or column not in df.columns:
        warnings.warn("start/end ignored: the table has no date column", UserWarning, stacklevel=2)
        return df
    kind = df.schema[column].dataType
    value = F.col(quoted(column))
    if isinstance(kind, T.StringType):
        text, value, kind = value, F.try_to_timestamp(value), T.TimestampType()
        strange = text.isNotNull() & value.isNull()
        if unreadable == "error":
            message = F.concat(F.lit(f"{column!r} holds text that is no date: "), text)
            value = F.when(strange, F.raise_error(message).cast(kind)).otherwise(value)
    inside = F.lit(True)
    if start is not None:
        inside = inside & (value >= F.lit(start).cast(kind))
    if end is not None:
        inside = inside & (value <= F.lit(end).cast(kind))
    if isinstance(df.schema[column].dataType, T.StringType) and unreadable == "keep":
        inside = inside | strange
    return df.filter(inside)


def dimension_columns(df: DataFrame, layout: Layout | None = None) -> list[str]:
    """Declared id columns that are not time; without a layout, the text columns."""
    if layout is not None and layout.id_columns:
        return [c for c in layout.id_columns if c in df.columns and c not in layout.time_columns]
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in GEOMETRY_COLUMNS]


def dimension_contains(
    df: DataFrame,
    text: str | None,
    *,
    columns: Sequence[str] | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Rows where any dimension column holds ``text``, ignoring case."""
    if not text:
        return df
    columns = list(columns) if columns is not None else dimension_columns(df, layout)
    needle = F.lower(F.lit(text))
    hits = [F.coalesce(F.contains(F.lower(F.col(quoted(c)).cast("string")), needle), F.lit(False))
            for c in columns]
    return df.filter(reduce(lambda a, b: a | b, hits, F.lit(False)))


def state_condition(schema: T.StructType, text: str | None) -> Column | None:
    """Condition for a ``column = value`` current-state rule, or None if it does not apply.

    Booleans match however they are stored (``true``, ``"True"``); whole numbers and
    words are compared as text, case-sensitively.  Nulls never match.
    """
    if not text or not text.strip():
        return None
    name, equals, raw = (part.strip() for part in text.partition("="))
    if not equals or not raw or not re.fullmatch(r"\w+", name):
        warnings.warn(f"state rule {text!r} is not of the form 'column = value'; ignored",
                      UserWarning, stacklevel=2)
        return None
    if name not in schema.fieldNames():
        return None
    kind = schema[name].dataType
    column = F.col(quoted(name))
    if raw.lower() in ("true", "false"):
        if isinstance(kind, T.BooleanType):
            return column == F.lit(raw.lower() == "true")  # reaches the Parquet scan
        return F.lower(column.cast("string")) == raw.lower()
    if re.fullmatch(r"[+-]?\d+", raw):
        number = int(raw)
        if isinstance(kind, T.IntegralType) and -2**63 <= number < 2**63:
            return column == F.lit(number)
        raw = str(number)
    return column.cast("string") == raw


def current_state(df: DataFrame, text: str | None) -> DataFrame:
    """Only the live rows of a table that also holds history rows."""
    condition = state_condition(df.schema, text)
    return df if condition is None else df.filter(condition)
