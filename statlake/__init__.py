"""Keeping and querying a lake of published statistical tables with Spark."""

from .model import (
    ChangeColumns, Layout, LayoutError, StatlakeError, SyncError, SyncResult, TableMeta,
)
from .operators.cdc import (
    diff_snapshots, feed_pages, high_water, latest_per_key, merge_changes, op_counts, since,
)
from .operators.digesttree import changed_rows, diff_stored, same_stored, write_digested
from .operators.filters import (
    current_state, date_range, dimension_contains, from_publisher, from_source, resolve_date_column,
    without_geometry,
)
from .operators.geo import envelope, within_bbox, write_by_place
from .operators.history import rows_at
from .operators.hotkeys import hot_keys
from .operators.limits import capped, first_n, most_recent, preview, sort_by_date
from .operators.quality import duplicate_keys, same_rows, signed_difference, source_mismatch
from .operators.reshape import to_long, to_wide
from .operators.search import search_catalog, search_rows
from .operators.textindex import add_rows, search_index
from .plans.lake import Lake
from .plans.lineage import drop_scratch
from .plans.settings import configure
from .sources.readers import (
    read_catalog, read_changes, read_envelope, read_records, read_table, union_pages,
)
from .sources.writers import to_records, write_table
from .streaming.stream import polling_interval, read_feed_stream, stream_changelog
from .streaming.sync import sync, sync_changelog, sync_log, sync_snapshot
from .streaming.versions import VersionedTable

__all__ = [n for n in dir() if not n.startswith("_")]
