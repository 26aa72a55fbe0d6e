"""Reading tables, catalogues, record payloads and change feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..model import ChangeColumns
from ..operators.cdc import since as rows_since
from ..operators.filters import from_source, without_geometry
from .csvlines import read_split_csv
from .formats import CSV_READ, empty_texts

FORMATS = ("parquet", "geoparquet", "csv", "csv_gz", "json", "orc")

DATA_SOURCES = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("licence", T.StringType())]))


def read_table(
    spark: SparkSession,
    path: str | list[str],
    format: str = "parquet",
    *,
    schema: T.StructType | str | None = None,
    geometry: bool = True,
    source: str | None = None,
    spread: bool = False,
    split: bool = False,
) -> DataFrame:
    """A whole table.  GeoParquet keeps its geometry as WKB bytes.

    ``geometry=False`` leaves geometry columns out of the scan.  Text formats should be
    given a ``schema``; without one a CSV is read twice to find its types.  A CSV file is read by
    one task, since its values may hold line breaks: ``spread=True`` rebalances its rows right after, and ``split=True``, which needs
    the ``schema``, reads a plain CSV file by many tasks at the price of a shuffle.
    """
    if split and (format != "csv" or schema is None):
        raise ValueError("only plain CSV with a schema can be split")
    if format not in FORMATS:
        raise ValueError(f"unknown format {format!r}; expected one of {', '.join(FORMATS)}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if format in ("parquet", "geoparquet"):
        df = reader.parquet(*([path] if isinstance(path, str) else path))
    elif format == "orc":
        df = reader.orc(path)
    elif format == "json":
        df = reader.json(path)
    elif split:
        df = read_split_csv(spark, path, schema)
    else:
        df = empty_texts(reader.options(**CSV_READ).csv(path, inferSchema=schema is None, enforceSchema=False))
    if not geometry:
        df = without_geometry(df)
    if spread:
        df = df.hint("rebalance")
    return from_source(df, source)


def parse_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Turn a text date column into timestamps; text that is no date is an error."""
    if column in df.columns and isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, F.to_timestamp(F.col(column)))
    return df


def read_catalog(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """One row per dataset, from ``{"datasets": [...]}``, a bare list, or a table."""
    if format != "json":
        return read_table(spark, path, format)
    return _unwrapped(spark.read.json(path, multiLine=True), "datasets")


def _unwrapped(payload: DataFrame, key: str) -> DataFrame:
    if key in payload.columns and isinstance(payload.schema[key].dataType, T.ArrayType):
        if not isinstance(payload.schema[key].dataType.elementType, T.StructType):
            return payload.drop(*payload.columns).limit(0)  # only empty lists: no rows, no columns
        return payload.select(F.inline(key))
    return payload


def _payload(spark: SparkSession, path, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return spark.read.json(path, multiLine=True)
    whole = T.StructType([T.StructField("data", T.ArrayType(schema)),
                          T.StructField("data_sources", DATA_SOURCES),
                          *[f for f in schema.fields if f.name not in ("data", "data_sources")]])
    return spark.read.schema(whole).json(path, multiLine=True)


def _records(payload: DataFrame, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return _unwrapped(payload, "data")
    fields = [F.col(f"`{f.name}`") for f in schema.fields]
    # A payload whose list is null has none of a record's own fields, so it gives no row.
    is_record = reduce(lambda a, b: a | b, [c.isNotNull() for c in fields])
    bare = F.when(is_record, F.array(F.struct(*fields)))
    return payload.select(F.inline(F.coalesce(F.col("data"), bare)))


def read_records(spark: SparkSession, path: str | list[str],
                 schema: T.StructType | None = None) -> DataFrame:
    """Rows of JSON payloads, each ``{"data": [...]}`` or a bare list.

    One payload is one task's work, so large pulls should come as many files.
    """
    return _records(_payload(spark, path, schema), schema)


def read_envelope(spark: SparkSession, path: str | list[str],
                  schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON payloads and, apart, the licence records that came with them."""
    payload = _payload(spark, path, schema)
    if "data_sources" in payload.columns:
        sources = payload.select(F.inline("data_sources")).distinct()
    else:
        sources = spark.createDataFrame([], DATA_SOURCES.elementType)
    return _records(payload, schema), sources


def read_changes(
    spark: SparkSession,
    path: str | list[str],
    since: int = 0,
    upto: int | None = None,
    *,
    schema: T.StructType | None = None,
    names: ChangeColumns = ChangeColumns(),
) -> DataFrame:
    """Feed rows after a cursor, over all pages under ``path``.

    With a ``schema``, pages that lack a column give nulls; without one, all footers are
    read to find the union of the pages' columns.
    """
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    return rows_since(reader.parquet(*([path] if isinstance(path, str) else path)),
                      since, upto, names)


def read_floor(spark: SparkSession, path: str) -> int | None:
    """The lowest sequence number a feed still holds, which its publisher keeps in ``<feed>.floor``; None if it says none."""
    try:
        row = spark.read.text(path.rstrip("/") + ".floor").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return int(row[0]) if row is not None and row[0].strip() else None


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """Pages one after another, matched by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)
