"""Dense row numbers over a whole table without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.lineage import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_row_index(df: DataFrame, order: list[Column | str], column: str = "row_index") -> DataFrame:
    """Add a 0-based index that follows ``order``.

    Rows are range-partitioned and sorted in parallel, then written once with their
    position, so the index cannot change if a stage is repeated.  The index is the
    position inside the partition plus the number of rows in earlier partitions;
    that offset table has one row per partition and is the only thing broadcast.
    End ``order`` with a unique column, so a repeated value can be split too.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__pos", F.monotonically_increasing_id()),
        "ranked",
    )
    part = F.shiftright("__pos", _ROW_BITS)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: this window is over partition counts, not over data.
    before = F.coalesce(
        F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))
    inside = F.col("__pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(column, F.col("__before") + inside)
        .drop("__part", "__before", "__pos")
    )
