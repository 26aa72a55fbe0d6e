"""Small value types passed beside DataFrames, and the errors operators raise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from .functions.fixed_values import DATE_COLUMN_CANDIDATES, TABLE_META_KEYS


class StatlakeError(Exception):
    """Base of the errors this package defines."""


class LayoutError(StatlakeError, ValueError):
    """A reshape was refused because the shape is not declared or not unambiguous."""


class SyncError(StatlakeError, RuntimeError):
    """A table could not be brought up to date; the committed state is untouched."""


@dataclass(frozen=True)
class ChangeColumns:
    """Names of the bookkeeping columns a change feed carries."""

    seq: str = "_seq"
    op: str = "_op"
    committed_at: str = "_committed_at"
    snapshot_id: str = "_snapshot_id"

    @property
    def all(self) -> tuple[str, ...]:
        return (self.seq, self.op, self.committed_at, self.snapshot_id)


@dataclass(frozen=True)
class Layout:
    """Declared shape of a table: ``long``, ``wide``, ``feature`` or ``entity``."""

    kind: str
    id_columns: tuple[str, ...] = ()
    value_columns: tuple[str, ...] = ()
    time_columns: tuple[str, ...] = ()
    measure_name_column: str | None = None
    series_ids: Mapping[str, str] = field(default_factory=dict)

    def but(self, **changes: Any) -> "Layout":
        return replace(self, **changes)


def _names(value: Any) -> tuple[str, ...]:
    if value is None:
        return ()
    if isinstance(value, str):
        return (value,)
    return tuple(value)


@dataclass(frozen=True)
class TableMeta:
    """Description of one dataset: table fields plus a column glossary.

    A field that is present with a null value is different from a field that is
    absent: an explicit null ``date_filter_column`` says the table has no date axis.
    """

    table: Mapping[str, Any]
    columns: Sequence[Mapping[str, Any]] = ()

    @classmethod
    def of(cls, description: Mapping[str, Any]) -> "TableMeta":
        kept = {k: description[k] for k in TABLE_META_KEYS if k in description}
        return cls(kept, tuple(description.get("columns") or ()))

    def get(self, key: str, default: Any = None) -> Any:
        value = self.table.get(key)
        return default if value is None else value

    @property
    def date_column(self) -> str | None:
        if "date_filter_column" in self.table:
            return self.table["date_filter_column"] or None
        known = {c.get("name") for c in self.columns}
        return next((c for c in DATE_COLUMN_CANDIDATES if c in known), None)

    @property
    def series_ids(self) -> dict[str, str]:
        return {c["name"]: c["series_id"] for c in self.columns
                if c.get("name") and c.get("series_id")}

    @property
    def layout(self) -> Layout | None:
        kind = str(self.get("layout", "")).strip().lower()
        if not kind:
            return None
        return Layout(
            kind=kind,
            id_columns=_names(self.get("id_columns")),
            value_columns=_names(self.get("value_columns")),
            time_columns=_names(self.get("time_columns")),
            measure_name_column=self.get("measure_name_column"),
            series_ids=self.series_ids,
        )

    def column_label(self, column: str) -> str | None:
        """Trimmed description of a column, from its first glossary entry."""
        for entry in self.columns:
            if entry.get("name") == column:
                return str(entry.get("description") or "").strip() or None
        return None


@dataclass(frozen=True)
class SyncResult:
    """Outcome of one sync call."""

    status: str  # downloaded | updated | unchanged
    path: str
    sync_mode: str  # snapshot | changelog
    previous_snapshot_id: str | None = None
    current_snapshot_id: str | None = None
    bytes_written: int = 0
    previous_seq: int | None = None
    current_seq: int | None = None
    ops_applied: int | None = None
