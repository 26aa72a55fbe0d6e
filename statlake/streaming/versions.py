"""A table kept as Parquet directories and a log of commits.

``<root>/data/attempt=X`` holds rows; ``<root>/log`` holds one JSON line per commit,
appended with Spark's own file commit.  Every write has a directory of its own and counts only once its log
row names it, so a failed, repeated or second write never touches rows that were committed, and data and feed
cursor move together.  Old directories are left to the store's own retention.  One writer per table is assumed.

A table may be split into hash buckets of its key (or of some of its key columns).  A
commit then writes only the buckets it touches; the log row says which directory holds
each bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..plans.sizing import quoted
from ..sources.formats import CSV_READ, empty_texts

BUCKET = "__bucket"

LOG_SCHEMA = (
    "version long, attempt long, status string, sync_mode string, format string, snapshot_id string, "
    "previous_snapshot_id string, previous_seq long, watermark_seq long, baseline_seq long, ops_applied long, "
    "key array<string>, state_filter string, bucket_by array<string>, bucket_count int, "
    "buckets map<string,long>, schema string, rows_written long, bytes_written long, "
    "batch string, committed_at string")


@dataclass(frozen=True)
class Commit:
    """One row of a table's log."""

    version: int
    attempt: int  # the directory that was written
    status: str
    sync_mode: str
    schema: str
    format: str = "parquet"
    snapshot_id: str | None = None
    previous_snapshot_id: str | None = None
    previous_seq: int | None = None
    watermark_seq: int | None = None
    baseline_seq: int | None = None  # the cursor of the last commit that no stream made
    ops_applied: int | None = None
    key: Sequence[str] = ()
    state_filter: str | None = None
    bucket_by: Sequence[str] = ()
    bucket_count: int | None = None
    buckets: Mapping[str, int] = field(default_factory=dict)
    rows_written: int = 0
    bytes_written: int = 0
    batch: str | None = None  # the micro-batch a stream committed
    committed_at: str = ""

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def bucket_number(schema: T.StructType, bucket_by: Sequence[str], count: int) -> Column:
    """Bucket of a row; equal keys get equal buckets (0.0 and -0.0 too)."""
    parts = []
    for name in bucket_by:
        c = F.col(quoted(name))
        floating = isinstance(schema[name].dataType, (T.DoubleType, T.FloatType))
        parts.append(c + F.lit(0.0) if floating else c)
    return F.pmod(F.xxhash64(*parts), F.lit(count)).cast("int")


class VersionedTable:
    """Reads and commits versions of one table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log_path = f"{self.root}/log"

    @staticmethod
    def new_attempt() -> int:
        """The number of a directory that no other write uses."""
        return uuid.uuid4().int >> 66

    def data_path(self, attempt: int) -> str:
        return f"{self.root}/data/attempt={attempt}"

    def log(self) -> DataFrame:
        """All commits; empty for a table that was never written."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(self.log_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def commit(self, version: int | None = None) -> Commit | None:
        """The commit of a version, by default the latest; None if there is none."""
        if version is None:
            newest = self._newest_log_files()
            if not newest:
                return None
            rows = self.spark.read.schema(LOG_SCHEMA).json(newest)
        else:
            rows = self.log().filter(F.col("version") == version)
        found = rows.orderBy(F.col("version").desc(), F.col("committed_at").desc()).limit(1).collect()
        return Commit(**found[0].asDict(recursive=True)) if found else None

    def _newest_log_files(self, most: int = 4) -> list[str]:
        """The last few log files by their time, so that finding the latest commit does not read the whole log.

        There is one writer and one file per commit; a few are read because times may be equal.
        """
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.log_path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        found = [(s.getModificationTime(), s.getPath().toString()) for s in files.listStatus(folder)
                 if s.isFile() and s.getPath().getName().startswith("part-")]
        return [path for _, path in sorted(found)[-most:]]

    def version_before(self, moment: datetime) -> Commit | None:
        """The last commit made before a moment."""
        stamp = moment.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
        found = (self.log().filter(F.col("committed_at") < stamp)
                 .orderBy(F.col("version").desc()).limit(1).collect())
        return Commit(**found[0].asDict(recursive=True)) if found else None

    def read(self, commit: Commit | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a commit (the latest by default), or only of some of its buckets."""
        commit = commit or self.commit()
        if commit is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        if commit.bucket_count is None:
            return self._loaded(commit, self.data_path(commit.attempt))
        wanted = commit.buckets.items()
        if buckets is not None:
            chosen = {str(b) for b in buckets}
            wanted = [(b, a) for b, a in wanted if b in chosen]
        paths = [f"{self.data_path(a)}/{BUCKET}={b}" for b, a in wanted]
        if not paths:
            return self.spark.createDataFrame([], commit.struct)
        return self._reader(commit).load(paths)

    def _reader(self, commit: Commit):
        reader = self.spark.read.schema(commit.struct)
        if commit.format in ("csv", "csv_gz"):
            return reader.format("csv").options(**CSV_READ)
        return reader.format(commit.format if commit.format in ("json", "orc") else "parquet")

    def _loaded(self, commit: Commit, path) -> DataFrame:
        rows = self._reader(commit).load(path)
        return empty_texts(rows) if commit.format in ("csv", "csv_gz") else rows

    def _listed_bytes(self, path: str) -> int | None:
        """Bytes of the data files under a path, from a listing; None if it is gone."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return None
        listed, total = files.listFiles(folder, True), 0
        while listed.hasNext():
            file = listed.next()
            if not file.getPath().getName().startswith(("_", ".")):
                total += file.getLen()
        return total

    def is_readable(self, commit: Commit) -> bool:
        """Whether the files of an unbucketed commit hold as many bytes as were written; reads no data."""
        return self._listed_bytes(self.data_path(commit.attempt)) == commit.bytes_written

    def written(self, attempt: int, schema: T.StructType, bucketed: bool,
                format: str = "parquet") -> tuple[dict[str, int], int, int]:
        """Buckets, rows and bytes that a directory holds."""
        if bucketed:
            schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        probe = Commit(0, attempt, "", "", schema.json(), format=format)
        files = self._reader(probe).load(self.data_path(attempt)).select(
            (F.col(BUCKET) if bucketed else F.lit(0)).cast("string").alias("bucket"))
        # At most one row per bucket comes back.
        rows = files.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        return ({r["bucket"]: attempt for r in rows} if bucketed else {},
                sum(r["n"] for r in rows), self._listed_bytes(self.data_path(attempt)) or 0)

    def append(self, commit: Commit) -> Commit:
        """Make a written version the current one: one small file, visible as a whole or not at all."""
        stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
        values = {**asdict(commit), "committed_at": stamp, "key": list(commit.key),
                  "bucket_by": list(commit.bucket_by)}
        line = self.spark.range(0, 1, 1, 1).select(F.lit(json.dumps(values)).alias("value"))
        line.write.mode("append").text(self.log_path)
        return Commit(**values)
