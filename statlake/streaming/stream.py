"""Following a change feed with Structured Streaming."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..model import ChangeColumns, SyncError
from .sync import apply_changes
from .versions import VersionedTable

# Words and suffixes a polling interval may be given in (fixed values).
_NAMED_INTERVALS = {"hourly": "1 hour", "daily": "1 day", "weekly": "7 days"}
_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}


def polling_interval(text: str) -> str:
    """Trigger interval for plain seconds (``60``), ``30s``, ``15m``, ``6h``, ``1d``, ``hourly``, ``daily``, ``weekly``."""
    word = text.strip().lower()
    if word in _NAMED_INTERVALS:
        return _NAMED_INTERVALS[word]
    match = re.fullmatch(r"(\d+)\s*([smhd]?)", word)
    if not match or int(match[1]) == 0:
        raise ValueError(f"not a polling interval: {text!r}")
    return f"{int(match[1])} {_UNITS[match[2] or 's']}"


def read_feed_stream(spark: SparkSession, path: str, schema: T.StructType,
                     files_per_trigger: int | None = None) -> DataFrame:
    """The feed directory as a stream, files in the order they were published.

    With ``files_per_trigger`` each file has to hold a whole page, since the files that one
    job writes side by side have no order among themselves.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_changelog(
    feed: DataFrame,
    root: str,
    *,
    checkpoint: str,
    every: str | None = None,
    key: Sequence[str] | None = None,
    names: ChangeColumns = ChangeColumns(),
) -> StreamingQuery:
    """Merge each micro-batch of a feed stream into a table that has its baseline.

    Without ``every`` the query applies what is there and stops; with it, it keeps polling.
    The table's log row names the micro-batch and moves cursor and data together, so a
    batch that is repeated after a crash is recognised and applied once.
    """
    table = VersionedTable(feed.sparkSession, root)

    def merge(batch: DataFrame, batch_id: int) -> None:
        last = table.commit()
        if last is None or last.sync_mode != "changelog":
            raise SyncError(f"no changelog baseline under {root}")
        label = f"{checkpoint}#{batch_id}"
        if last.batch != label:
            apply_changes(table, last, batch, key=key, names=names, batch=label)

    writer = feed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=polling_interval(every)).start()
