"""Change feeds: merging into a keyed table, reducing, diffing, describing.

A feed row is a full row image plus bookkeeping columns (:class:`ChangeColumns`):
a sequence number that is unique and grows in commit order, and an operation,
``I``, ``U`` or ``D``.  An update is either one ``U`` or a ``D`` followed by an ``I``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fixed_values import FEED_PAGE_ROWS
from ..model import ChangeColumns
from ..plans.lineage import cut_lineage
from ..plans.sizing import broadcast_if_small, quoted
from .filters import current_state, state_condition
from .quality import signed_difference
from .ranking import with_row_index

NAMES = ChangeColumns()


def strip_bookkeeping(df: DataFrame, names: ChangeColumns = NAMES) -> DataFrame:
    return df.drop(*names.all)


def check_feed(state: T.StructType, changes: T.StructType, key: Sequence[str],
               names: ChangeColumns = NAMES) -> None:
    """Refuse a merge without a key, a feed without its columns, or keys of different types."""
    if not key:
        raise ValueError("a merge needs at least one key column")
    absent = [c for c in (names.seq, names.op, *key) if c not in changes.names]
    if absent:
        raise ValueError(f"the change feed lacks {absent}")
    for k in key:
        if k in state.names:
            ours, theirs = state[k].dataType, changes[k].dataType
            both_numeric = isinstance(ours, T.NumericType) and isinstance(theirs, T.NumericType)
            if ours != theirs and not both_numeric:
                raise TypeError(f"key {k!r} is {ours.simpleString()} in the table "
                                f"but {theirs.simpleString()} in the feed")


def without_keys(
    state: DataFrame,
    touched: DataFrame,
    key: Sequence[str],
    *,
    broadcast: bool = False,
    null_safe: bool = True,
) -> DataFrame:
    """Rows of ``state`` whose key is not in ``touched`` (left anti join).

    ``touched`` is made distinct first (partial aggregation before its shuffle), so one
    key repeated any number of times costs one row.  A hot key on the state side is
    split by AQE, or never moved when the keys are broadcast, which callers ask for only after
    they have measured them.  Null keys match null keys
    unless ``null_safe=False``, which callers use once they have counted no null key.
    """
    aliases = [f"__k{i}" for i in range(len(key))]
    keys = touched.select(*[F.col(quoted(k)).alias(a) for k, a in zip(key, aliases)]).distinct()
    if broadcast:
        keys = F.broadcast(keys)
    left, right = state.alias("__state"), keys.alias("__touched")
    pairs = [(F.col(f"__state.{quoted(k)}"), F.col(f"__touched.{a}")) for k, a in zip(key, aliases)]
    condition = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return left.join(right, reduce(lambda a, b: a & b, condition), "left_anti")


def latest_per_key(
    changes: DataFrame,
    key: Sequence[str],
    *,
    state_filter: str | None = None,
    names: ChangeColumns = NAMES,
) -> DataFrame:
    """The last operation of each key, deletes included.

    Rows written as history (non-deletes that fail ``state_filter``) are not operations
    on the current row.  ``max_by`` is combined before the shuffle, so a key with a third
    of the feed sends one row per task.
    """
    live = state_condition(changes.schema, state_filter)
    if live is not None:
        changes = changes.filter((F.col(names.op) == "D") | live)
    rest = [c for c in changes.columns if c not in key]
    # A row without a sequence number counts as the earliest of its key.
    seq = F.coalesce(F.col(quoted(names.seq)), F.lit(-2**63))
    last = F.max_by(F.struct(*[F.col(quoted(c)) for c in rest]), seq)
    return (changes.groupBy(*[F.col(quoted(k)) for k in key]).agg(last.alias("__last"))
            .select(*[F.col(quoted(k)) for k in key],
                    *[F.col(f"__last.{quoted(c)}").alias(c) for c in rest])
            .select(*[F.col(quoted(c)) for c in changes.columns]))


def added_rows(
    changes: DataFrame,
    key: Sequence[str],
    *,
    state_filter: str | None = None,
    keep: str = "all",
    names: ChangeColumns = NAMES,
) -> DataFrame:
    """Feed rows that enter the table: all non-deletes, or only each key's last operation."""
    if keep not in ("all", "latest"):
        raise ValueError("keep must be 'all' or 'latest'")
    if keep == "latest":
        changes = latest_per_key(changes, key, state_filter=state_filter, names=names)
    # A row without an operation is no delete, so it stays.
    return strip_bookkeeping(changes.filter(~F.col(names.op).eqNullSafe("D")), names)


def merge_changes(
    state: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    *,
    state_filter: str | None = None,
    keep: str = "all",
    names: ChangeColumns = NAMES,
    null_safe: bool = True,
) -> DataFrame:
    """Apply a change feed to a keyed table.

    Every row whose key the feed touches leaves the table; the feed's rows that are not
    deletes join it; bookkeeping columns go; ``state_filter`` keeps the live rows.

    ``keep="all"`` adds every such feed row.  ``keep="latest"`` adds only the last
    operation of each key, which makes applying several batches at once, or one batch
    twice, give the same table.
    """
    check_feed(state.schema, changes.schema, key, names)
    added = added_rows(changes, key, state_filter=state_filter, keep=keep, names=names)
    kept = strip_bookkeeping(state, names)
    if all(k in state.columns for k in key):
        kept = without_keys(kept, changes, key, null_safe=null_safe)
    return current_state(kept.unionByName(added, allowMissingColumns=True), state_filter)


def since(changes: DataFrame, seq: int, upto: int | None = None,
          names: ChangeColumns = NAMES) -> DataFrame:
    """Feed rows after the cursor; the range reaches the Parquet scan."""
    rows = changes.filter(F.col(names.seq) > seq)
    return rows if upto is None else rows.filter(F.col(names.seq) <= upto)


def high_water(changes: DataFrame, names: ChangeColumns = NAMES) -> DataFrame:
    """One row: the highest sequence number, 0 for an empty feed."""
    return changes.agg(F.coalesce(F.max(names.seq), F.lit(0)).cast("long").alias("seq_high"))


def op_counts(changes: DataFrame, names: ChangeColumns = NAMES) -> DataFrame:
    """Rows per operation."""
    return changes.groupBy(F.col(names.op).alias("op")).agg(F.count(F.lit(1)).alias("rows"))


def feed_pages(changes: DataFrame, page_rows: int = FEED_PAGE_ROWS,
               names: ChangeColumns = NAMES) -> DataFrame:
    """One row per page of the feed in sequence order.

    Columns: ``page``, ``row_count``, ``seq_low``, ``seq_high`` (the cursor to go on
    from) and ``truncated`` (more pages follow).
    """
    ranked = with_row_index(changes.select(F.col(quoted(names.seq)).alias("seq")), ["seq"])
    pages = (
        ranked.groupBy(F.floor(F.col("row_index") / page_rows).cast("long").alias("page"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.min("seq").alias("seq_low"),
             F.max("seq").alias("seq_high"), F.max("row_index").alias("__last"))
    )
    end = ranked.agg(F.max("row_index")).scalar()
    return pages.select("page", "row_count", "seq_low", "seq_high",
                        (F.col("__last") < end).alias("truncated"))


def hashable(schema: T.StructType) -> list[Column]:
    """What a row hash has to see: Spark's skips nulls, so each column comes with a null flag, and nested
    values go in as JSON text, in which their nulls have a place."""
    parts = []
    for f in schema.fields:
        column = F.col(quoted(f.name))
        nested = isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        parts += [F.to_json(F.struct(column), {"ignoreNullFields": "false"}) if nested else column, column.isNull()]
    return parts


def changed_candidates(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the rows whose digests cancel out.

    Only two 64-bit hashes per row are shuffled to find digests held by a different number
    of rows on either side; rows with those digests are then picked by a semi join.
    """
    columns = [F.col(quoted(c)) for c in old.columns]
    parts = hashable(old.schema)
    digests = [F.xxhash64(*parts).alias("__h1"), F.xxhash64(F.lit(1), *parts).alias("__h2")]
    changed = signed_difference(old.select(*digests), new.select(*digests), "__net").drop("__net")
    changed = broadcast_if_small(cut_lineage(changed, "digests"))

    def pick(df: DataFrame) -> DataFrame:
        hashed = df.select(*columns, *digests)
        return hashed.join(changed, ["__h1", "__h2"], "left_semi").drop("__h1", "__h2")

    return pick(old), pick(new)


def diff_rows(old: DataFrame, new: DataFrame, op: str = NAMES.op, *,
              by_digest: bool = False) -> DataFrame:
    """Rows to delete from ``old`` (``D``) and to insert (``I``) to arrive at ``new``.

    A changed row gives both.  Copies count: three copies against one gives two rows.

    Whole rows are shuffled and compared.  For wide tables of which little has changed,
    ``by_digest`` reads both twice but shuffles 128-bit digests and only the rows they
    single out; a change would be missed only if two rows had equal digests.
    """
    if by_digest:
        old, new = changed_candidates(old, new)
    return _numbered_copies(old, new, op).drop("__copy")


def _numbered_copies(old: DataFrame, new: DataFrame, op: str) -> DataFrame:
    """The rows of a diff with ``__copy``, the number of each among its equals."""
    net = signed_difference(old, new, "__net")
    copies = F.abs("__net")
    chunk = 65_536  # keeps the arrays that repeat a row small, however many copies there are
    return (
        net.withColumn(op, F.when(F.col("__net") < 0, "D").otherwise("I"))
        .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1,
                                                   F.lit(chunk).cast("long"))))
        .withColumn("__copy", F.explode(F.sequence(
            F.col("__from"), F.least(F.col("__from") + chunk, copies) - 1,
            F.lit(1).cast("long"))))
        .drop("__net", "__from")
    )


def diff_snapshots(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    *,
    after_seq: int = 0,
    committed_at: str | None = None,
    snapshot_id: str | None = None,
    names: ChangeColumns = NAMES,
    by_digest: bool = False,
) -> DataFrame:
    """The change feed that leads from ``old`` to ``new``.

    Sequence numbers are dense and start after ``after_seq``; all deletes precede all
    inserts, so an update is a ``D`` followed by an ``I`` of the same key.
    """
    if by_digest:
        old, new = changed_candidates(old, new)
    # Row hash and copy number split a key with a large share of the changes over many tasks.
    order: list[Column] = [F.col(names.op), *[F.col(quoted(k)) for k in key],
                           F.xxhash64(*hashable(old.schema)), F.col("__copy")]
    ranked = with_row_index(_numbered_copies(old, new, names.op), order, "__rank")
    return ranked.select(
        (F.col("__rank") + F.lit(after_seq + 1)).cast("long").alias(names.seq),
        F.col(names.op),
        F.lit(committed_at).cast("string").alias(names.committed_at),
        F.lit(snapshot_id).cast("string").alias(names.snapshot_id),
        *[F.col(quoted(c)) for c in old.columns],
    )
