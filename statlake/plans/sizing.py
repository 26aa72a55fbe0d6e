"""Measured size checks before a side is broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Well under the 8 GB hard limit and small enough to be built on every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
TASK_ROWS = 250_000

_FIXED_BYTES = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def quoted(name: str) -> str:
    """Back-quoted column name, so dots and spaces in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def row_bytes(schema: T.StructType, columns: list[str] | tuple[str, ...] | None = None) -> Column:
    """Approximate size of one row as an expression (variable parts are measured)."""
    parts = [F.lit(16)]
    for f in schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(quoted(f.name))
        if type(f.dataType) in _FIXED_BYTES:
            parts.append(F.lit(max(8, _FIXED_BYTES[type(f.dataType)])))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16)
    return reduce(lambda a, b: a + b, parts).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` by one distributed aggregation."""
    return df.agg(F.sum(row_bytes(df.schema)).alias("b")).first()["b"] or 0


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Shuffle partitions that keep a task's part of ``df`` near ``rows``.  Counts it, for which a stored table's footers are enough."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def estimated_bytes(df: DataFrame) -> int:
    """What the planner expects ``df`` to take: file sizes, carried through the plan.  Runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it measures below ``limit``, else as it is.

    Unmarked, the join is planned by Catalyst and AQE (shuffled, skew split).  Only what the planner already expects to be
    small is measured, which reads ``df`` once more: give a written table (``cut_lineage``) if it is costly to compute.  Of rows made
    in the program the planner expects the worst, so they are neither measured nor broadcast.
    """
    small = estimated_bytes(df) <= limit and measured_bytes(df) <= limit
    return F.broadcast(df) if small else df
