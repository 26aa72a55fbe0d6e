"""Comparing stored tables by a tree of digests over hash ranges of their key.

A table is written in the order of a hash of its key.  The leading bits of the hash are a leaf; for every leaf, and for
every group of 16 leaves, 256 leaves and so on up to the whole table, the number of rows and sums of two row hashes are kept.
Two tables are compared from the root down: below nodes that agree nothing is looked at.  Only rows of leaves that differ
are read again; the ranges of the hash in which they lie reach the scan, which skips other files and row groups.

A difference is missed only if different rows of one leaf have equal counts and equal sums of both 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.lineage import cut_lineage
from ..plans.sizing import broadcast_if_small, estimated_bytes, quoted
from .cdc import NAMES, diff_rows, hashable

LEAF_BITS = 16
STEP = 4  # bits from a level to the next: a node has 16 children
MOST_RANGES = 64  # of the hash, pushed to the scan
FILE_BYTES = 128 << 20
LEAF = "__leaf"
_NODE = "level int, node long, rows long, a_low long, a_high long, b_low long, b_high long"
_SUMS = ("rows", "a_low", "a_high", "b_low", "b_high")


def _halves(hash_: Column, name: str) -> list[Column]:
    """Sums of 32-bit halves do not overflow."""
    return [F.sum(hash_.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"{name}_low"), F.sum(F.shiftrightunsigned(hash_, 32)).alias(f"{name}_high")]


def write_digested(df: DataFrame, path: str, key: Sequence[str], bits: int = LEAF_BITS) -> None:
    """Write a table and its digests under ``path``; tables to be compared need the same columns, key and ``bits``.

    Null keys have a leaf like any other; a key with a large share of the rows is split over several files.
    """
    if bits % STEP or not 0 < bits <= 32:
        raise ValueError(f"bits must be a multiple of {STEP} up to 32")
    if LEAF in df.columns:
        raise ValueError(f"the table already has a column {LEAF}")
    spark, whole = df.sparkSession, hashable(df.schema)
    parts = [p for k in key for p in hashable(df.select(quoted(k)).schema)]
    size = estimated_bytes(df)
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 if size > 1 << 60 else -(-size // FILE_BYTES))
    placed = df.withColumn(LEAF, F.shiftrightunsigned(F.xxhash64(*parts), 64 - bits))
    placed.repartitionByRange(files, LEAF, F.xxhash64(*whole)).sortWithinPartitions(LEAF).write.parquet(f"{path}/rows")
    rows = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    a, b = F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)
    leaves = rows.groupBy(LEAF).agg(F.count(F.lit(1)).alias("rows"), *_halves(a, "a"), *_halves(b, "b"))
    above = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftrightunsigned(LEAF, bits - STEP * level).alias("node"))
                      for level in range(bits // STEP + 1)])
    nodes = (leaves.select(*_SUMS, F.inline(above)).groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in _SUMS]))
    nodes.repartition("level", "node").sortWithinPartitions("level", "node").write.parquet(f"{path}/digests")


def _level(spark: SparkSession, path: str, level: int, sign: int) -> DataFrame:
    nodes = spark.read.schema(_NODE).parquet(f"{path}/digests").filter(F.col("level") == level)
    return nodes.select("node", *[(F.col(c) * sign).alias(c) for c in _SUMS])


def _levels(spark: SparkSession, path: str) -> int:
    """Levels below the root; 0 for an empty table."""
    return spark.read.schema(_NODE).parquet(f"{path}/digests").agg(F.max("level")).first()[0] or 0


def _differing(spark: SparkSession, old: str, new: str, level: int, above: DataFrame | list[int] | None) -> DataFrame:
    """Nodes of a level that differ, among the children of ``above``."""
    nodes = _level(spark, old, level, -1).unionByName(_level(spark, new, level, 1))
    parent = F.shiftrightunsigned("node", STEP)
    if isinstance(above, list):
        nodes = nodes.filter(parent.isin(above))
    elif above is not None:
        nodes = nodes.join(broadcast_if_small(above.select(F.col("node").alias("above"))), parent == F.col("above"), "left_semi")
    unequal = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in _SUMS])
    return nodes.groupBy("node").agg(*[F.sum(c).alias(c) for c in _SUMS]).filter(unequal).select("node")


def same_stored(spark: SparkSession, old: str, new: str) -> bool:
    """Whether two tables hold the same rows, from the digests of their roots."""
    return _differing(spark, old, new, 0, None).isEmpty()


def changed_leaves(spark: SparkSession, old: str, new: str) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Leaves that differ, and at most ``MOST_RANGES`` ranges of leaves in which they all lie."""
    both = {_levels(spark, old), _levels(spark, new)} - {0}
    levels = max(both, default=0)
    if len(both) > 1:
        raise ValueError("the tables were written with different numbers of bits")
    above, ranges = None, []
    for level in range(levels + 1):
        found = _differing(spark, old, new, level, above)
        if not isinstance(above, list) and above is not None:
            found = cut_lineage(found, "nodes")  # many nodes stay a table
        few = [r["node"] for r in found.limit(MOST_RANGES + 1).collect()]
        if not few:
            return found, []
        above = cut_lineage(found, "nodes") if len(few) > MOST_RANGES and isinstance(above, list) else found
        if len(few) <= MOST_RANGES:
            width = STEP * (levels - level)
            above, ranges = few, [(n << width, (n + 1 << width) - 1) for n in sorted(few)]
    return (cut_lineage(spark.createDataFrame([(n,) for n in above], "node long"), "nodes") if isinstance(above, list) else above), ranges


def changed_rows(spark: SparkSession, old: str, new: str) -> tuple[DataFrame, DataFrame]:
    """Rows of both tables in leaves that differ."""
    leaves, ranges = changed_leaves(spark, old, new)
    leaves = broadcast_if_small(leaves.select(F.col("node").alias(LEAF)))

    def pick(path: str) -> DataFrame:
        rows = spark.read.parquet(f"{path}/rows")
        if not ranges:
            return rows.limit(0).drop(LEAF)
        near = reduce(lambda a, b: a | b, [F.col(LEAF).between(low, high) for low, high in ranges])
        return rows.filter(near).join(leaves, LEAF, "left_semi").drop(LEAF)

    return pick(old), pick(new)


def diff_stored(spark: SparkSession, old: str, new: str, op: str = NAMES.op) -> DataFrame:
    """Rows to delete from the old table (``D``) and to insert (``I``) to arrive at the new one; copies count."""
    return diff_rows(*changed_rows(spark, old, new), op)
