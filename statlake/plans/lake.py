"""One entry point over a catalogue: list, search, read, export and sync datasets."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixed_values import PUBLISHERS
from ..model import ChangeColumns, Layout, StatlakeError, SyncResult, TableMeta
from ..operators import catalog as cat
from ..operators.filters import date_range, dimension_contains, from_publisher, from_source, resolve_date_column
from ..operators.limits import most_recent, preview as preview_rows, sort_by_date
from ..operators.reshape import to_long, to_wide
from ..operators.search import search_catalog
from ..sources.readers import parse_date, read_changes, read_floor, read_table
from ..sources.writers import write_table
from ..streaming.sync import sync as sync_table
from ..streaming.versions import VersionedTable


class Lake:
    """Datasets described by a catalogue DataFrame.

    Beside its metadata a catalogue row has ``path`` (where the table is), and optionally
    ``format``, ``feed_path`` (its change feed) and ``current_state_filter``.  If the catalogue
    has a ``date_filter_column``, a null there says the dataset has no date axis; if it has
    none, the glossary is looked at.  A dataset's description is read once, by one small job; what is read
    from the dataset itself is lazy.
    """

    def __init__(self, spark: SparkSession, catalog: DataFrame, names: ChangeColumns = ChangeColumns()):
        self.spark, self.catalog, self.names = spark, catalog, names
        self._rows: dict[str, dict] = {}

    def list(self, source: str | None = None, *, publisher: str | None = None) -> DataFrame:
        """Datasets of a source label, matched exactly, or of a publisher by its short name or label."""
        return from_publisher(from_source(self.catalog, source), publisher)

    def search(self, query: str, source: str | None = None, *, publisher: str | None = None) -> DataFrame:
        return search_catalog(from_publisher(self.catalog, publisher), query, source=source)

    def _row(self, name: str) -> dict:
        if name not in self._rows:
            row = self.catalog.filter(F.col("name") == name).limit(1).collect()
            if not row:
                raise StatlakeError(f"the catalogue has no dataset {name!r}")
            self._rows[name] = row[0].asDict(recursive=True)
        return dict(self._rows[name])

    def info(self, name: str) -> TableMeta:
        return TableMeta.of(self._row(name))

    def table(self, name: str, *, geometry: bool = True) -> DataFrame:
        """The whole table, as published."""
        row = self._row(name)
        fmt = row.get("format") or "parquet"
        return cat.labelled(read_table(self.spark, row["path"], fmt, geometry=geometry),
                            TableMeta.of(row))

    def to_long(self, name: str, **options) -> tuple[DataFrame, Layout]:
        """The dataset reshaped to long form by the layout its metadata declares."""
        return to_long(self.table(name), self.info(name).layout, **options)

    def to_wide(self, name: str, **options) -> tuple[DataFrame, Layout]:
        """The dataset reshaped to wide form by the layout its metadata declares."""
        return to_wide(self.table(name), self.info(name).layout, **options)

    def get(
        self,
        name: str,
        start: str | None = None,
        end: str | None = None,
        *,
        limit: int | None = None,
        dimensions: str | None = None,
        geometry: bool = True,
        source: str | None = None,
        tie_break: Sequence[str] = (),
        ordered: bool = False,
    ) -> DataFrame:
        """A filtered read; ``limit`` keeps the most recent rows.

        ``source`` says which publisher is expected; another one is only warned about.  Rows
        are ordered by date if limited or if ``ordered`` (a sort of the whole result).
        """
        meta = self.info(name)
        if source is not None:
            expected, actual = PUBLISHERS.get(source, source), str(meta.get("source", "")).strip()
            if actual and actual != expected:
                warnings.warn(f"{name!r} is published by {actual!r}, not {expected!r}",
                              UserWarning, stacklevel=2)
        df = parse_date(self.table(name, geometry=geometry))
        column = resolve_date_column(meta, df.columns)
        if start is not None or end is not None:
            if column is None:
                warnings.warn(f"start/end ignored: {name!r} has no date column",
                              UserWarning, stacklevel=2)
            else:
                df = date_range(df, start, end, column=column)
        df = dimension_contains(df, dimensions, layout=meta.layout)
        if limit is not None and limit > 0:
            return most_recent(df, limit, date=column or "date", tie_break=tie_break)
        return sort_by_date(df, column or "date", tie_break) if ordered else df

    def preview(self, name: str, limit: int = 10) -> DataFrame:
        return preview_rows(self.table(name), limit)

    def download(self, name: str, path: str, format: str = "parquet", *, start: str | None = None,
                 end: str | None = None, limit: int | None = None, tie_break: Sequence[str] = ()) -> str:
        """Write a filtered slice."""
        return write_table(self.get(name, start, end, limit=limit, tie_break=tie_break), path, format)

    def download_bulk(self, name: str, path: str, format: str | None = None, *,
                      freshness: str = "current", root: str | None = None) -> str:
        """Write the whole table in its own format or another.

        With ``root``, a synced table's versions are the source: ``current`` is the latest,
        ``monthly`` the last one committed before this month began.
        """
        if freshness not in ("current", "monthly"):
            raise ValueError("freshness must be 'current' or 'monthly'")
        row = cat.with_format(cat.with_route(self.catalog.filter(F.col("name") == name)), "__format").first()
        if row is None:
            raise StatlakeError(f"the catalogue has no dataset {name!r}")
        if row["bulk_refused"]:
            raise StatlakeError(f"{name!r} may not be exported in bulk")
        if root is None:
            df = self.table(name)
        else:
            table = VersionedTable(self.spark, root)
            month = datetime.now(timezone.utc).replace(day=1, hour=0, minute=0, second=0, microsecond=0)
            commit = table.version_before(month) if freshness == "monthly" else None
            if commit is None and freshness == "monthly":
                raise StatlakeError(f"{root} has no version from before this month")
            df = table.read(commit)
        return write_table(df, path, format or row["__format"])

    def sync(self, name: str, root: str, *, format: str = "parquet", force: bool = False,
             **options) -> SyncResult:
        """Keep a copy of a dataset current, by the tier its metadata names."""
        row = self._row(name)
        feed = None
        if row.get("feed_path"):
            feed = read_changes(self.spark, row["feed_path"], names=self.names)
        if TableMeta.of(row).get("cdc_serving_tier") == "changelog":
            floor = read_floor(self.spark, row["feed_path"]) if row.get("feed_path") else None
            options = {"state_filter": row.get("current_state_filter"), "names": self.names,
                       "retention_floor": floor, **options}
        return sync_table(self.spark, root, TableMeta.of(row), lambda: self.table(name), feed,
                          format=format, force=force, **options)
