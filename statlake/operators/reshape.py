"""Long/wide reshaping under a declared layout.  Refuses rather than guesses."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.fixed_values import GEOMETRY_COLUMNS, UNRESHAPABLE_LAYOUTS
from ..functions.lookups import lookup
from ..model import Layout, LayoutError
from ..plans.sizing import quoted

# Up to here a wide table is one aggregation with a pair of aggregates per measure;
# beyond it generated code gets too long and Spark's two-step pivot is used.
DIRECT_MEASURES = 64


def _require(df: DataFrame, layout: Layout | None, wanted: str) -> Layout:
    if layout is None or not layout.kind:
        raise LayoutError("no layout is declared for this table; its shape is not guessed")
    kind = layout.kind.strip().lower()
    if kind in UNRESHAPABLE_LAYOUTS:
        raise LayoutError(f"a table of layout {kind!r} has one row per thing; there is nothing to reshape")
    if any(c in df.columns for c in GEOMETRY_COLUMNS):
        raise LayoutError("drop the geometry column first; reshaping would repeat it for each measure")
    if kind != wanted:
        raise LayoutError(f"the table is declared {kind!r}; this reshape needs {wanted!r}")
    return layout


def _present(names: Sequence[str], df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [c for c in names if c in df.columns and c not in but]


def _same_name(names: Sequence[str], case_sensitive: bool) -> list[str]:
    folded = [n if case_sensitive else n.lower() for n in names]
    return sorted({n for n, f in zip(names, folded) if folded.count(f) > 1})


def _case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"


def to_long(
    df: DataFrame,
    layout: Layout | None,
    *,
    names_to: str | None = None,
    values_to: str = "value",
    keep_nulls: bool = False,
) -> tuple[DataFrame, Layout]:
    """One row per id and measure of a wide table; narrow, no shuffle.

    Null and NaN values are left out unless ``keep_nulls``.  If the layout knows series
    ids they are added as ``series_id``.  Returns the rows and their new layout.
    """
    layout = _require(df, layout, "wide")
    values = _present(layout.value_columns, df)
    if not values:
        raise LayoutError("none of the declared value columns is in the table")
    ids = (_present(layout.id_columns, df, values)
           or [c for c in df.columns if c not in values])
    names_to = names_to or layout.measure_name_column or "measure"
    clash = _same_name([*ids, names_to, values_to], _case_sensitive(df))
    if clash or values_to in df.columns:
        raise LayoutError(f"output columns would clash: {clash or [values_to]}")

    kinds = {df.schema[v].dataType for v in values}
    if len(kinds) > 1 and not all(isinstance(k, T.NumericType) for k in kinds):
        raise LayoutError("the value columns have types with no common numeric type: "
                          f"{sorted(k.simpleString() for k in kinds)}")
    long = df.unpivot([F.col(quoted(c)) for c in ids], [F.col(quoted(c)) for c in values],
                      names_to, values_to)
    if not keep_nulls:
        value = F.col(quoted(values_to))
        long = long.filter(value.isNotNull())
        if isinstance(long.schema[values_to].dataType, (T.DoubleType, T.FloatType)):
            long = long.filter(~F.isnan(value))
    if layout.series_ids and "series_id" not in long.columns:
        long = long.withColumn("series_id", lookup(F.col(quoted(names_to)), layout.series_ids))
    return long, Layout(
        kind="long",
        id_columns=tuple(ids),
        value_columns=(values_to,),
        time_columns=tuple(c for c in layout.time_columns if c in long.columns),
        measure_name_column=names_to,
    )


def measure_names(df: DataFrame, column: str) -> list[Any]:
    """Distinct measure names in order, nulls last; refused beyond Spark's pivot limit."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    name = F.col(quoted(column))
    rows = df.select(name).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise LayoutError(f"{column!r} has more than {limit} different values")
    found = [r[0] for r in rows]
    return sorted(n for n in found if n is not None) + [None] * (None in found)


def to_wide(
    df: DataFrame,
    layout: Layout | None,
    *,
    names_from: str | None = None,
    values_from: str | None = None,
    id_columns: Sequence[str] | None = None,
    fill: Any = None,
    names: Sequence[Any] | None = None,
    tasks: int | None = None,
) -> tuple[DataFrame, Layout]:
    """One row per id with a column per measure.

    Two rows for one cell are an error at run time, never silently aggregated.  ``names``
    gives the measures and saves the job that finds them; a measure outside it is an
    error too.  ``fill`` replaces missing measures.  Beyond ``DIRECT_MEASURES`` measures rows are dealt by id to
    ``tasks`` tasks, each of which holds its wide rows (the session's shuffle partitions, if not given).  Returns rows and their new layout.
    """
    layout = _require(df, layout, "long")
    values = _present(layout.value_columns, df)
    names_from = names_from or layout.measure_name_column
    values_from = values_from or (values[0] if len(values) == 1 else None)
    if not names_from or not values_from:
        raise LayoutError("which column holds names and which holds values is not unambiguous; "
                          "say names_from and values_from")
    for c in (names_from, values_from):
        if c not in df.columns:
            raise LayoutError(f"there is no column {c!r}")
    used = (names_from, values_from)
    if id_columns is None:
        ids = _present(layout.id_columns, df, used) or [c for c in df.columns if c not in used]
    else:
        ids = list(id_columns)
    given = names is not None
    names = list(names) if given else measure_names(df, names_from)
    labels = ["null" if n is None else str(n) for n in names]
    clash = _same_name([*ids, *labels], _case_sensitive(df))
    if clash:
        raise LayoutError(f"measures would give clashing column names: {clash}")

    parts = (df, ids, names_from, values_from, names, labels, given)
    wide = _cells_direct(*parts) if len(names) <= DIRECT_MEASURES else _cells_two_step(*parts, tasks)
    if fill is not None:
        kind = df.schema[values_from].dataType
        wide = wide.select(*[F.col(quoted(c)) for c in ids],
                           *[F.coalesce(F.col(quoted(c)), F.lit(fill).cast(kind)).alias(c)
                             for c in labels])
    return wide, Layout(
        kind="wide",
        id_columns=tuple(ids),
        value_columns=tuple(labels),
        time_columns=tuple(c for c in layout.time_columns if c in wide.columns),
        measure_name_column=None,
    )


def _duplicate_error():
    return F.raise_error(F.lit("two rows share one id and measure; the table cannot be widened")).cast("boolean")


def _unknown_error():
    return F.raise_error(F.lit("a measure is not in the given names")).cast("boolean")


def _cells_direct(df, ids, names_from, values_from, names, labels, given):
    """One aggregation on the ids, combined before its only shuffle."""
    name, value = F.col(quoted(names_from)), F.col(quoted(values_from))
    aggs = []
    for i, n in enumerate(names):
        here = name.isNull() if n is None else name == F.lit(n)
        aggs += [F.first(F.when(here, value), ignorenulls=True).alias(f"__v{i}"),
                 F.count(F.when(here, F.lit(1))).alias(f"__n{i}")]
    everything = F.count(F.lit(1)).alias("__rows")
    grouped = df.groupBy(*[F.col(quoted(c)) for c in ids]).agg(everything, *aggs)
    known = sum((F.col(f"__n{i}") for i in range(len(names))), F.lit(0))
    # A filter, since a check inside a column would go when the column is not read.
    sound = F.when(F.greatest(*[F.col(f"__n{i}") for i in range(len(names))], F.lit(0)) > 1, _duplicate_error())
    if given:
        sound = sound.when(F.col("__rows") != known, _unknown_error())
    return grouped.filter(sound.otherwise(F.lit(True))).select(
        *[F.col(quoted(c)) for c in ids], *[F.col(f"__v{i}").alias(label) for i, label in enumerate(labels)])


def _cells_two_step(df, ids, names_from, values_from, names, labels, given, tasks=None):
    """Cells first, then Spark's pivot of unique cells: cost per row does not grow with names.

    Rows are dealt by id while they are narrow: neither aggregation shuffles, and wide rows are only made where they stay.
    """
    name, value = F.col(quoted(names_from)), F.col(quoted(values_from))
    dealt = df.repartition(*([tasks] if tasks else []), *[F.col(quoted(c)) for c in ids]) if ids else df
    cells = (dealt.groupBy(*[F.col(quoted(c)) for c in ids], name)
             .agg(F.first(value).alias("__v"), F.count(F.lit(1)).alias("__n")))
    sound = F.when(F.col("__n") > 1, _duplicate_error())
    if given:
        listed = name.isin([n for n in names if n is not None])
        if None in names:
            listed = listed | name.isNull()
        sound = sound.when(~F.coalesce(listed, F.lit(False)), _unknown_error())
    cells = cells.filter(sound.otherwise(F.lit(True))).select(*[F.col(quoted(c)) for c in ids], name, "__v")
    # Spark names a pivot's columns by its own rule; these are named as in the direct way.
    return (cells.groupBy(*[F.col(quoted(c)) for c in ids])
            .pivot(names_from, names).agg(F.first("__v")).toDF(*ids, *labels))
