"""Checks on whole tables: equality, duplicate keys, mislabelled sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..plans.sizing import broadcast_if_small, quoted


def signed_difference(old: DataFrame, new: DataFrame, column: str = "net") -> DataFrame:
    """Distinct rows whose number of copies differs, with copies in new minus copies in old.

    One aggregation over both tables.  It groups by the whole row with a partial count
    before the shuffle: nulls and NaN compare equal, a hot key is spread over its
    different rows, and equal copies are combined where they are read.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError("the tables have different columns: "
                         f"{sorted(set(old.columns) ^ set(new.columns))}")
    names = [F.col(quoted(c)) for c in old.columns]
    both = (old.select(*names, F.lit(-1).cast("long").alias(column))
            .unionByName(new.select(*names, F.lit(1).cast("long").alias(column))))
    return (both.groupBy(*names).agg(F.sum(quoted(column)).alias(column))
            .filter(F.col(quoted(column)) != 0))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """True if both tables hold the same rows, whatever the row and column order."""
    return signed_difference(a, b, "__net").isEmpty()


def duplicate_keys(df: DataFrame, key: Sequence[str], column: str = "copies") -> DataFrame:
    """Keys held by more than one row (null counts as a value)."""
    return (df.groupBy(*[F.col(quoted(k)) for k in key]).agg(F.count(F.lit(1)).alias(column))
            .filter(F.col(column) > 1))


def source_mismatch(
    df: DataFrame,
    expected: DataFrame,
    on: Sequence[str],
    *,
    source: str = "source",
    expected_source: str = "expected_source",
) -> DataFrame:
    """Rows whose recorded source is not the expected one; a blank record is fine.

    ``expected`` is broadcast if it measures small, so rows that share one key stay where
    they are; otherwise AQE splits the hot key.
    """
    recorded = F.trim(F.coalesce(F.col(source), F.lit("")))
    return (df.join(broadcast_if_small(expected), list(on), "inner")
            .filter((recorded != "") & (recorded != F.col(expected_source))))
