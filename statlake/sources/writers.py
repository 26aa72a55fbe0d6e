"""Writing tables as interchange files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.sizing import quoted
from .formats import CSV_WRITE

# File name endings of whole-table artefacts (fixed values).
EXTENSIONS = {"parquet": ".parquet", "csv_gz": ".csv.gz", "geoparquet": ".geo.parquet",
              "csv": ".csv", "json": ".json"}

# Microseconds are kept; Spark's own text default stops at milliseconds.
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN has no JSON or CSV form; it is written as a missing value, inside nested values too."""
    clean = {f.name: _without_nan(F.col(quoted(f.name)), f.dataType) for f in df.schema.fields if _holds_floats(f.dataType)}
    return df.withColumns(clean) if clean else df


def _holds_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_floats(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_floats(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_holds_floats(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def _without_nan(value: Column, kind: T.DataType) -> Column:
    if not _holds_floats(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _without_nan(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _without_nan(x, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [_without_nan(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.when(~F.isnan(value), value)


def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists") -> str:
    """Write ``df`` under ``path`` and return the path.

    JSON is one object per line, with nulls kept and dates in ISO form; a single JSON
    array could only be written by one task.
    """
    text = format in ("csv", "csv_gz", "json")
    writer = nan_to_null(df).write.options(**_TIMES).mode(mode) if text else df.write.mode(mode)
    if format in ("parquet", "geoparquet"):
        writer.option("compression", "snappy").parquet(path)
    elif format == "csv":
        writer.options(**CSV_WRITE).csv(path)
    elif format == "csv_gz":
        writer.options(**CSV_WRITE).csv(path, compression="gzip")
    elif format == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif format == "orc":
        writer.orc(path)
    else:
        raise ValueError(f"unknown format {format!r}; expected one of {', '.join(EXTENSIONS)}, orc")
    return path


def to_records(df: DataFrame, column: str = "record") -> DataFrame:
    """One JSON object per row, with nulls kept, as a text column."""
    clean = nan_to_null(df)
    fields = F.struct(*[F.col(quoted(c)) for c in clean.columns])
    return clean.select(F.to_json(fields, {**_TIMES, "ignoreNullFields": "false"}).alias(column))
