"""Keeping a table current from snapshots or from a change feed, in batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..model import ChangeColumns, SyncError, SyncResult, TableMeta
from ..operators.cdc import added_rows, check_feed, high_water, strip_bookkeeping, without_keys
from ..operators.filters import current_state
from ..plans.sizing import BROADCAST_LIMIT_BYTES, quoted, row_bytes
from ..sources.writers import write_table
from .versions import BUCKET, Commit, VersionedTable, bucket_number

NAMES = ChangeColumns()
DEFAULT_BUCKETS = 64


def _result(table: VersionedTable, commit: Commit, **other) -> SyncResult:
    values = dict(
        status=commit.status, path=table.root, sync_mode=commit.sync_mode,
        previous_snapshot_id=commit.previous_snapshot_id, current_snapshot_id=commit.snapshot_id,
        bytes_written=commit.bytes_written, previous_seq=commit.previous_seq,
        current_seq=commit.watermark_seq, ops_applied=commit.ops_applied)
    return SyncResult(**{**values, **other})


def sync_snapshot(
    spark: SparkSession,
    root: str,
    snapshot: DataFrame | Callable[[], DataFrame],
    snapshot_id: str | None,
    *,
    format: str = "parquet",
    force: bool = False,
    allow_empty: bool = False,
) -> SyncResult:
    """Replace the table if the publisher's snapshot id differs from the stored one.

    Equal ids and readable data: ``unchanged`` and no rows are read.  A blank id never
    counts as equal.  The first write is ``downloaded``, later ones ``updated``.
    """
    table = VersionedTable(spark, root)
    last = table.commit()
    if (last is not None and not force and snapshot_id and last.snapshot_id == snapshot_id
            and last.sync_mode == "snapshot" and last.format == format and table.is_readable(last)):
        return SyncResult("unchanged", table.root, "snapshot", last.snapshot_id, snapshot_id)
    rows = snapshot() if callable(snapshot) else snapshot
    version, attempt = 1 if last is None else last.version + 1, table.new_attempt()
    write_table(rows, table.data_path(attempt), format)
    _, count, size = table.written(attempt, rows.schema, False, format)
    if count == 0 and not allow_empty:
        raise SyncError("the snapshot has no rows; the table is left as it was")
    commit = table.append(Commit(
        version, attempt, "downloaded" if last is None else "updated", "snapshot", rows.schema.json(),
        format=format, snapshot_id=snapshot_id,
        previous_snapshot_id=last.snapshot_id if last else None,
        rows_written=count, bytes_written=size))
    return _result(table, commit, current_seq=None, ops_applied=None)


def _aligned(changes: DataFrame, schema: T.StructType) -> DataFrame:
    """Feed columns in the table's types, so equal keys hash alike and old files stay readable.

    Whole numbers are cast (one that does not fit is an error at run time) and floats
    widened; any other change of type needs a new baseline.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    columns = []
    for f in changes.schema.fields:
        column, kind = F.col(quoted(f.name)), kinds.get(f.name, f.dataType)
        if f.dataType.simpleString() != kind.simpleString():
            whole = isinstance(f.dataType, T.IntegralType) and isinstance(kind, T.IntegralType)
            wider = isinstance(f.dataType, T.FloatType) and isinstance(kind, T.DoubleType)
            if not whole and not wider:
                raise SyncError(f"column {f.name!r} is {kind.simpleString()} in the table but "
                                f"{f.dataType.simpleString()} in the feed; force a new baseline")
            column = column.cast(kind).alias(f.name)
        columns.append(column)
    return changes.select(*columns)


def _write_buckets(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy(BUCKET).parquet(path)


def write_baseline(
    table: VersionedTable,
    baseline: DataFrame,
    *,
    key: Sequence[str],
    watermark_seq: int,
    status: str,
    state_filter: str | None,
    snapshot_id: str | None,
    bucket_by: Sequence[str],
    bucket_count: int,
    last: Commit | None,
    previous_seq: int | None = None,
) -> Commit:
    """Write a full baseline split into buckets and make it current."""
    rows = current_state(baseline, state_filter)
    version, attempt = 1 if last is None else last.version + 1, table.new_attempt()
    number = bucket_number(rows.schema, bucket_by, bucket_count)
    # Rebalancing gives each bucket few files and lets AQE split a bucket that is too big.
    _write_buckets(rows.withColumn(BUCKET, number).hint("rebalance", BUCKET), table.data_path(attempt))
    buckets, count, size = table.written(attempt, rows.schema, True)
    return table.append(Commit(
        version, attempt, status, "changelog", rows.schema.json(), snapshot_id=snapshot_id,
        previous_snapshot_id=last.snapshot_id if last else None, previous_seq=previous_seq,
        watermark_seq=watermark_seq, baseline_seq=watermark_seq, ops_applied=0, key=tuple(key), state_filter=state_filter,
        bucket_by=tuple(bucket_by), bucket_count=bucket_count, buckets=buckets,
        rows_written=count, bytes_written=size))


def apply_changes(
    table: VersionedTable,
    last: Commit,
    changes: DataFrame,
    *,
    key: Sequence[str] | None = None,
    state_filter: str | None = None,
    names: ChangeColumns = NAMES,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    batch: str | None = None,
) -> SyncResult:
    """Merge feed rows after the stored cursor into the touched buckets and commit.

    One aggregation over the feed finds what the merge has to know: how many rows, the new
    cursor, which buckets are touched, whether any key is null, and how many bytes the
    keys take.  Keys that measure below ``broadcast_limit`` are broadcast, so the table's
    rows are not shuffled; otherwise both sides are, with skewed partitions split by AQE.

    ``batch`` names the micro-batch when the rows come from a stream, which hands over each
    row once.  There rows that the table held before any stream are passed over, since a feed with a
    history starts with them; a later row at or before the cursor would mean that feed files arrived out of
    sequence, and is an error.  A row without a sequence number is an error too.
    """
    key = tuple(key or last.key)
    state_filter = state_filter or last.state_filter
    schema = last.struct
    check_feed(schema, changes.schema, key, names)
    changes = _aligned(changes, schema)
    # What the table already held when a stream first came to it is passed over; a null stays, to be refused.
    held = last.watermark_seq if batch is None else last.baseline_seq
    if held is not None:
        changes = changes.filter((F.col(names.seq) > held) | F.col(names.seq).isNull())
    number = bucket_number(changes.schema, last.bucket_by, last.bucket_count)
    any_null = F.greatest(*[F.col(quoted(k)).isNull().cast("int") for k in key], F.lit(0))
    facts = changes.agg(
        F.count(F.lit(1)).alias("n"), F.max(names.seq).alias("high"),
        F.count_if(F.col(names.seq) <= last.watermark_seq).alias("late"),
        F.count_if(F.col(names.seq).isNull()).alias("unnumbered"),
        F.max(any_null).alias("nulls"),
        F.sum(row_bytes(changes.schema, list(key))).alias("key_bytes"),
        F.collect_set(number).alias("buckets"),  # at most bucket_count numbers
    ).first()
    if facts["unnumbered"]:
        raise SyncError(f"{facts['unnumbered']} feed rows have no sequence number")
    if facts["late"]:
        raise SyncError(f"feed rows at or before sequence {last.watermark_seq} arrived late")
    if facts["n"] == 0:
        return SyncResult("unchanged", table.root, "changelog", last.snapshot_id, last.snapshot_id,
                          0, last.watermark_seq, last.watermark_seq, 0)

    changes = changes.filter(F.col(names.seq) <= facts["high"])  # the feed may have grown since
    small = facts["key_bytes"] <= broadcast_limit
    kept = without_keys(table.read(last, facts["buckets"]), changes, key,
                        broadcast=small, null_safe=bool(facts["nulls"]))
    added = added_rows(changes, key, state_filter=state_filter, keep="latest", names=names)
    kept = kept.withColumn(BUCKET, number)
    added = added.withColumn(BUCKET, number).hint("rebalance", BUCKET)
    if not small:
        kept = kept.hint("rebalance", BUCKET)  # the join spread the buckets over all tasks
    merged = current_state(kept.unionByName(added, allowMissingColumns=True), state_filter)

    version, attempt = last.version + 1, table.new_attempt()
    _write_buckets(merged, table.data_path(attempt))
    schema = merged.drop(BUCKET).schema
    rewritten, count, size = table.written(attempt, schema, True)
    touched = {str(b) for b in facts["buckets"]}
    untouched = {b: a for b, a in last.buckets.items() if b not in touched}
    commit = table.append(Commit(
        version, attempt, "updated", "changelog", schema.json(), snapshot_id=last.snapshot_id,
        previous_snapshot_id=last.snapshot_id, previous_seq=last.watermark_seq,
        watermark_seq=facts["high"], baseline_seq=facts["high"] if batch is None else last.baseline_seq,
        ops_applied=facts["n"], key=key, state_filter=state_filter,
        bucket_by=last.bucket_by, bucket_count=last.bucket_count,
        buckets={**untouched, **rewritten}, rows_written=count, bytes_written=size, batch=batch))
    return _result(table, commit)


def sync_changelog(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    baseline: DataFrame | Callable[[], DataFrame],
    *,
    key: Sequence[str] | None = None,
    state_filter: str | None = None,
    snapshot_id: str | None = None,
    retention_floor: int | None = None,
    bucket_by: Sequence[str] | None = None,
    bucket_count: int = DEFAULT_BUCKETS,
    force: bool = False,
    names: ChangeColumns = NAMES,
) -> SyncResult:
    """Bring a table up to date from its change feed.

    A first, forced, or formerly snapshot-synced table is written from the baseline, with the
    feed's high-water mark (read before the baseline) as cursor.  A cursor older than
    ``retention_floor``, the lowest sequence number the feed still holds, means rows were
    missed, so the baseline is taken again.  Otherwise only newer feed rows are merged.

    ``bucket_by`` may name some of the key columns, such as the period, so that changes which
    fall together rewrite few buckets.
    """
    table = VersionedTable(spark, root)
    last = table.commit()
    key = tuple(key or (last.key if last else ()) or ())
    state_filter = state_filter or (last.state_filter if last else None)
    if not key:
        raise ValueError("a changelog table needs at least one key column")
    bucket_by = tuple(bucket_by or key)
    if not set(bucket_by) <= set(key):
        raise ValueError("bucket_by may only name key columns")

    cold = force or last is None or last.sync_mode != "changelog" or last.watermark_seq is None
    expired = (not cold and retention_floor is not None
               and last.watermark_seq < retention_floor - 1)
    if not cold and not expired:
        return apply_changes(table, last, changes, key=key, state_filter=state_filter, names=names)
    seq = high_water(changes, names).first()["seq_high"]
    rows = strip_bookkeeping(baseline() if callable(baseline) else baseline, names)
    commit = write_baseline(
        table, rows, key=key, watermark_seq=seq, status="updated" if expired else "downloaded",
        state_filter=state_filter, snapshot_id=snapshot_id, bucket_by=bucket_by,
        bucket_count=bucket_count, last=last, previous_seq=last.watermark_seq if expired else None)
    return _result(table, commit,
                   previous_snapshot_id=commit.previous_snapshot_id if expired else None)


def sync(
    spark: SparkSession,
    root: str,
    meta: TableMeta,
    snapshot: DataFrame | Callable[[], DataFrame],
    changes: DataFrame | None = None,
    *,
    format: str = "parquet",
    force: bool = False,
    **options,
) -> SyncResult:
    """Sync by the tier the metadata names: ``changelog``, or anything else as snapshot."""
    if meta.get("cdc_serving_tier") == "changelog":
        if changes is None:
            raise SyncError("the table is served as a changelog but no feed was given")
        if format != "parquet":
            raise ValueError("a changelog table is always kept as parquet")
        return sync_changelog(spark, root, changes, snapshot, force=force,
                              key=options.pop("key", None) or meta.get("pk_columns"),
                              snapshot_id=meta.get("current_snapshot_id"), **options)
    return sync_snapshot(spark, root, snapshot, meta.get("current_snapshot_id"),
                         format=format, force=force)


def sync_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per commit: what each sync did."""
    return VersionedTable(spark, root).log().select(
        "version", "status", "sync_mode", "previous_snapshot_id",
        F.col("snapshot_id").alias("current_snapshot_id"), "previous_seq",
        F.col("watermark_seq").alias("current_seq"), "ops_applied", "rows_written",
        "bytes_written", "committed_at")
