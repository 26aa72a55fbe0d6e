"""Shards by extendible hashing, in DataFrame operations only.

A row's hash is 60 bits of its key's MD5.  The directory is indexed by a prefix of those bits; a
bucket that holds more than the byte limit is split on one more bit, no other bucket is, until
every bucket fits.  A shard is therefore the shortest prefix whose rows fit the limit.

Rows are summed once to directory cells, whose depth follows from total size and limit; the sizes
of all shorter prefixes are sums of cells.  A bucket becomes a shard where it fits and its parent does
not, its entries in the directory are its cells, and rows find their shard by one equi-join.  Cells that
still hold too much go to a next round with further bits.  Rows that agree in all 60 bits are
numbered and split by the bits of that number, so even one key with a third of all rows is split.

Defined results: a null key hashes as a key of its own; a null text has no bytes; a row larger than the
limit is a shard alone; equal rows are interchangeable; an empty table gives no rows; an input column
named as one of the results is refused.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ranking import with_row_index
from ..plans.lineage import cut_lineage

BYTE_LIMIT = 1 << 20
BITS = 60
SLACK = 3  # bits beyond what evenly filled shards would need
DEEPEST = 24  # bits of one round: a directory of at most 16 million cells
RESULT = ("shard", "shard_depth", "shard_rows", "shard_bytes")


def hashed(text: Column) -> Column:
    """60 bits of the MD5 of a text; all bits set for null."""
    digest = F.md5(text.cast("string").cast("binary"))
    return F.coalesce(F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long"), F.lit((1 << BITS) - 1))


def _directory(cells: DataFrame, depth: int, limit: int) -> DataFrame:
    """For every cell of ``depth`` bits below each ``__prefix``: the ``suffix`` that is its shard, null where the cell
    itself holds too much, and that bucket's rows and bytes."""
    sizes = cut_lineage(
        cells.withColumn("__depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
        .groupBy("__prefix", "__depth", F.expr(f"shiftright(__cell, {depth} - __depth)").alias("__cell"))
        .agg(F.sum("shard_rows").alias("shard_rows"), F.sum("shard_bytes").alias("shard_bytes")), "directory")
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1)
    split = sizes.where(~fits).select("__prefix", (F.col("__depth") + 1).alias("__depth"), F.col("__cell").alias("__parent"))
    below = (sizes.withColumn("__parent", F.shiftright("__cell", 1))
             .join(split, ["__prefix", "__depth", "__parent"]).drop("__parent"))
    buckets = (below.where(fits | (F.col("__depth") == depth))
               .unionByName(sizes.where(fits & (F.col("__depth") == 0) | (F.lit(depth) == 0))))
    bits = F.substring(F.lpad(F.bin("__cell"), depth, "0"), F.lit(depth + 1) - F.col("__depth"), F.col("__depth"))
    cells_of = F.expr(f"sequence(shiftleft(__cell, {depth} - __depth), shiftleft(__cell + 1, {depth} - __depth) - 1)")
    return (buckets.withColumn("suffix", F.when(fits, bits)).withColumn("__cell", F.explode(cells_of))
            .select("__prefix", "__cell", "suffix", "shard_rows", "shard_bytes"))


def assign_shards(df: DataFrame, key: str, size: Column, limit: int = BYTE_LIMIT) -> DataFrame:
    """All rows and columns with ``shard`` (its bits), ``shard_depth``, ``shard_rows``, ``shard_bytes``."""
    clash = {c.lower() for c in df.columns} & set(RESULT)
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    columns = df.columns
    rows = df.select("*", hashed(F.col(key)).alias("__hash"), F.coalesce(size, F.lit(0)).cast("long").alias("__bytes"),
                     F.lit("").alias("__prefix"))
    done, used = [], 0
    heaviest = rows.agg(F.sum("__bytes")).first()[0] or 0
    while True:
        depth = min(DEEPEST, BITS - used, max(0, math.ceil(math.log2(max(heaviest, 1) / limit))) + SLACK)
        rows = rows.withColumn("__cell", F.shiftright("__hash", BITS - used - depth).bitwiseAND(F.lit((1 << depth) - 1)))
        entries = _directory(rows.groupBy("__prefix", "__cell").agg(
            F.count(F.lit(1)).alias("shard_rows"), F.sum("__bytes").alias("shard_bytes")), depth, limit)
        placed, shard = rows.join(entries, ["__prefix", "__cell"]), F.concat("__prefix", "suffix")
        done.append(placed.where(F.col("suffix").isNotNull()).select(
            *columns, shard.alias("shard"), F.length(shard).alias("shard_depth"), "shard_rows", "shard_bytes"))
        heaviest = entries.where(F.col("suffix").isNull()).agg(F.max("shard_bytes")).first()[0]
        if heaviest is None:
            return reduce(DataFrame.unionByName, done)
        used += depth
        longer = F.concat("__prefix", F.lpad(F.bin("__cell"), depth, "0"))
        rows = cut_lineage(placed.where(F.col("suffix").isNull()).select(
            *columns, "__hash", "__bytes", longer.alias("__prefix"), F.monotonically_increasing_id().alias("__tie")), "oversized")
        if used == BITS:
            # These rows agree in all bits of their keys: number them and go on with the bits of the number.
            numbered = with_row_index(rows, ["__prefix", F.xxhash64(*columns), "__tie"], "__number")
            rows = numbered.withColumn("__hash", hashed(F.concat_ws(":", "__prefix", "__number"))).drop("__number")
            used = 0


ORACLE = f"""
WITH hashed AS (
    SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
           to_base(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, {BITS // 4}))::BIGINT, 2, {BITS}) AS bits
    FROM documents),
prefixes AS (SELECT doc_id, n_bytes, d, substr(bits, 1, d) AS shard FROM hashed, range(0, 33) AS depths(d)),
buckets AS (SELECT d, shard, count(*) AS n, sum(n_bytes) AS bytes FROM prefixes GROUP BY d, shard),
found AS (SELECT p.doc_id, min(p.d) AS d FROM prefixes p JOIN buckets b USING (d, shard)
          WHERE b.bytes <= {BYTE_LIMIT} OR b.n = 1 GROUP BY p.doc_id)
SELECT p.doc_id, p.n_bytes, p.shard, p.d AS shard_depth, b.n AS shard_rows, CAST(b.bytes AS BIGINT) AS shard_bytes
FROM found f JOIN prefixes p USING (doc_id, d) JOIN buckets b USING (d, shard)
"""
