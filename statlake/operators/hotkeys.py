"""Keys that hold a large share of a table's rows, found in bounded memory and counted exactly."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..plans.sizing import quoted
from .cdc import hashable

LEAST_SHARE = 0.0001


def hot_keys(df: DataFrame, key: Sequence[str], share: float = 0.01, *, column: str = "copies") -> DataFrame:
    """Every key with at least ``share`` of all rows, its number of rows and its share; a null counts as a value.

    The first pass keeps a sketch of frequent hashes per task, of a size that depends on ``share`` alone, and sends only sketches on: no key
    above the share can be missing from them.  The second counts the few candidates exactly.  Use it to choose what to split before a
    join or a window on the key.
    """
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share must lie between {LEAST_SHARE} and 1")
    digest = F.xxhash64(*[p for k in key for p in hashable(df.select(quoted(k)).schema)])
    hashed = df.select(*[F.col(quoted(k)) for k in key], digest.alias("__hash"))
    # The sketch is off by at most a quarter of the share, so at most 1 / (3/4 share) hashes can seem to reach it.
    tracked = 1 << math.ceil(math.log2(16 / share))
    most = min(tracked, math.ceil(2 / share))
    seen = hashed.agg(F.expr(f"approx_top_k(__hash, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("all")).first()
    found = [item["item"] for item in seen["top"] or [] if item["count"] >= share * seen["all"] * 0.75]
    rows = hashed.filter(F.col("__hash").isin(found)) if found else hashed.limit(0)
    return (rows.groupBy(*[F.col(quoted(k)) for k in key]).agg(F.count(F.lit(1)).alias(column))
            .filter(F.col(column) >= F.lit(share) * seen["all"]).withColumn("share", F.col(column) / F.lit(max(seen["all"], 1))))
