"""Sorting by date, most-recent-N, previews and capped exports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.fixed_values import EXPORT_ROW_CEILING, PREVIEW_ROWS
from ..plans.lineage import cut_lineage
from ..plans.sizing import quoted
from ..sources.writers import to_records
from .filters import without_geometry

SKETCH_SIZE = 2048  # a quantile sketch of about 50 KB per task
SKETCH_ERROR = 0.005  # share of all rows by which a rank is allowed to be off, some four times the sketch's own error
HALVINGS = 40  # the sketch is asked for the best half of all rows, the best quarter, and so on


def _columns(names: Sequence[str]) -> list:
    return [F.col(quoted(n)) for n in names]


def sort_by_date(df: DataFrame, date: str = "date", tie_break: Sequence[str] = (), *,
                 stable: bool = False) -> DataFrame:
    """Ascending by date, undated rows last; a table without the column is unchanged.

    Ties follow ``tie_break`` and then a hash of the row: it is the same when a task is
    repeated, and lets the range partitioner split a date with a large share of the rows.
    ``stable`` keeps ties in input order instead; positions are written down first, since
    rows that come out of a shuffle may be in another order the next time.
    """
    if date not in df.columns:
        return df
    order = [F.col(quoted(date)).asc_nulls_last(), *(c.asc() for c in _columns(tie_break))]
    if stable:
        placed = cut_lineage(df.withColumn("__at", F.monotonically_increasing_id()), "placed")
        return placed.orderBy(*order, F.col("__at")).drop("__at")
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.orderBy(*order, F.xxhash64(*_columns(hashed)))


def first_n(df: DataFrame, n: int | None, order: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows by ``order`` (input position if none given)."""
    if n is None or n <= 0:
        return df
    return _top(df, n, order)


def most_recent(
    df: DataFrame,
    n: int | None,
    *,
    date: str = "date",
    tie_break: Sequence[str] = (),
    undated: str = "latest",
    two_pass: bool = False,
) -> DataFrame:
    """The ``n`` latest rows by ``date``, returned in ascending order.

    ``n`` missing or not positive keeps all rows.  Undated rows count as the latest
    unless ``undated="exclude"``.  At the cut, ties go to the larger ``tie_break``, then to
    the later input row.  Without the date column the first ``n`` rows are returned.

    ``two_pass`` first finds the n-th latest date from the date column alone and reads the
    other columns only where the date reaches it: for wide tables that are roughly in date
    order, whose older files the scan then skips.
    """
    if undated not in ("latest", "exclude"):
        raise ValueError("undated must be 'latest' or 'exclude'")
    if n is None or n <= 0:
        return sort_by_date(df, date, tie_break)
    if date not in df.columns:
        return first_n(df, n, tie_break)
    if undated == "exclude":
        df = df.filter(F.col(quoted(date)).isNotNull())
    ties = _columns(tie_break)
    if two_pass:
        day = F.col(quoted(date))
        # Rows per date, combined where they are read; of the n latest dates those that are reached.
        dates = df.filter(day.isNotNull()).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows"))
        later = Window.orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, -1)
        nth = (dates.orderBy(F.col("day").desc()).limit(n).withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0)))
               .filter(F.col("later") < n).agg(F.min("day")).scalar())
        df = df.filter(day.isNull() | (day >= nth))
    latest = _top(df, n, [date, *tie_break], descending=True)
    return latest.orderBy(F.col(quoted(date)).asc_nulls_last(), *(c.asc() for c in ties))


def _sketched(column: Column, kind: T.DataType) -> tuple[str, Column] | None:
    """The sketch for a column's type, and the column as a number that grows with it (or stays equal)."""
    if isinstance(kind, T.DateType):
        return "bigint", F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return "bigint", F.unix_micros(column)
    if isinstance(kind, T.IntegralType):
        return "bigint", column.cast("long")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        number = column.cast("double")
        return "double", F.when(F.isnan(number), F.lit(float("inf"))).otherwise(number)  # NaN is the largest
    if isinstance(kind, T.StringType):
        return "bigint", F.conv(F.hex(F.rpad(F.substring(F.encode(column, "UTF-8"), 1, 7), 7, F.lit(b"\0"))), 16, 10).cast("long")
    return None


def _within_cut_off(df: DataFrame, n: int, name: str, descending: bool) -> DataFrame:
    """Rows that can be among the ``n`` best by one column: undated ones, and those not behind a bound.

    The bound comes from one quantile sketch of the column and is then checked by a count: if fewer than ``n`` rows reached it, the
    worst value of all takes its place.  Both are subqueries on the one column; for dates and numbers the bound reaches the scan.
    """
    column, kind = F.col(quoted(name)), df.schema[name].dataType
    found = _sketched(column, kind)
    if found is None:
        return df
    sketch, number = found
    shares = [2.0 ** -i for i in range(HALVINGS)]
    ranks = F.array(*[F.lit(1 - s if descending else s) for s in shares])
    seen = df.select(number.alias("number"))
    made = seen.agg(F.count("number").alias("rows"), F.call_function(f"kll_sketch_agg_{sketch}", F.col("number"), F.lit(SKETCH_SIZE)).alias("sketch"))
    halvings = F.floor(F.log2(F.col("rows") / (n + SKETCH_ERROR * F.col("rows"))))
    place = F.greatest(F.lit(1), F.least(F.lit(HALVINGS), halvings + 1)).cast("int")
    bound = made.where("rows > 0").select(F.element_at(F.call_function(f"kll_sketch_get_quantile_{sketch}", F.col("sketch"), ranks), place)).scalar()
    reached = F.count_if(F.col("number") >= bound if descending else F.col("number") <= bound)
    worst = F.min("number") if descending else F.max("number")
    sure = seen.agg(F.when(reached >= n, bound).otherwise(worst).alias("bound")).scalar()
    if isinstance(kind, T.DateType):
        column, sure = column, F.date_from_unix_date(sure.cast("int"))
    elif isinstance(kind, T.TimestampType):
        column, sure = column, F.timestamp_micros(sure)
    elif isinstance(kind, (T.StringType, T.FractionalType, T.DecimalType)):
        column = number
    return df.filter(column.isNull() | (column >= sure if descending else column <= sure))


def _top(df: DataFrame, n: int, by: Sequence[str], *, descending: bool = False) -> DataFrame:
    """The first ``n`` rows by columns and then by input position, or the last ones.

    One plan for every ``n``: a bound on the first column, what is within it in a top-k.  Each task sends at most ``n`` rows on, and
    all tasks together about ``n`` and a share of ``SKETCH_ERROR``; the rows that are returned pass one task.
    """
    if by:
        df = _within_cut_off(df, n, by[0], descending)
    columns = [*_columns(by)]
    order = [*(c.desc_nulls_first() if descending and not at else c.desc() if descending else c.asc_nulls_last() for at, c in enumerate(columns)),
             F.col("__at").desc() if descending else F.col("__at").asc()]
    return df.withColumn("__at", F.monotonically_increasing_id()).orderBy(*order).limit(n).drop("__at")


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """At most ten sample rows, without geometry."""
    n = PREVIEW_ROWS if not n else n
    return without_geometry(df).limit(max(0, min(n, PREVIEW_ROWS)))


@dataclass(frozen=True)
class Capped:
    """A bounded export: JSON records, whether more rows exist, and how many if counted."""

    records: list[str]
    limit: int
    truncated: bool
    total: int | None = None


def capped_limit(n: int, ceiling: int = EXPORT_ROW_CEILING) -> int:
    return max(1, min(int(n), ceiling))


def capped(df: DataFrame, n: int = 100, ceiling: int = EXPORT_ROW_CEILING, *,
           count: bool = False) -> Capped:
    """Up to ``min(n, ceiling)`` rows as JSON records, for callers that want a small answer.

    ``count`` also counts all rows, which reads all of them.
    """
    limit = capped_limit(n, ceiling)
    rows = to_records(df.limit(limit + 1)).collect()
    return Capped([r["record"] for r in rows[:limit]], limit, len(rows) > limit,
                  df.count() if count else None)
