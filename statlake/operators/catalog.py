"""Questions about the catalogue: formats, routes, glossary, licences, provenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fixed_values import (
    DATE_COLUMN_CANDIDATES, GEOMETRY_COLUMNS, LARGE_TABLE_ROWS, PROVENANCE_KEYS, TABLE_META_KEYS,
    UNRESHAPABLE_LAYOUTS,
)
from ..functions.lookups import blank_to_null
from ..model import TableMeta
from ..plans.sizing import broadcast_if_small


def _field(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column, or a null of that type if the catalogue does not have it."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _says_yes(column: Column) -> Column:
    return ~F.coalesce(column, F.lit("")).isin("", "none", "false")


def describe(catalog: DataFrame, name: str) -> TableMeta | None:
    """Metadata of one dataset, or None if the catalogue does not list it."""
    row = catalog.filter(F.col("name") == name).limit(1).collect()
    if not row:
        return None
    return TableMeta.of(row[0].asDict(recursive=True))


def table_fields(catalog: DataFrame) -> DataFrame:
    """Table-level fields only; the glossary and unknown fields are left out."""
    return catalog.select(*[k for k in TABLE_META_KEYS if k in catalog.columns])


def glossary(catalog: DataFrame) -> DataFrame:
    """One row per dataset and column, from the nested glossary."""
    entries = catalog.select(F.col("name").alias("dataset"), F.posexplode("columns"))
    return entries.select("dataset", F.col("pos").alias("position"), "col.*")


def column_labels(glossary_rows: DataFrame) -> DataFrame:
    """Label per dataset and column: its first glossary entry, trimmed, blank as null."""
    first = F.min_by(F.struct("description"), "position").getField("description")
    return (glossary_rows.groupBy("dataset", "name")
            .agg(blank_to_null(first).alias("label")))


def has_geometry(catalog: DataFrame) -> Column:
    return (_says_yes(_field(catalog, "geometry_type")) | _says_yes(_field(catalog, "geometry_wkt"))
            | F.coalesce(_field(catalog, "has_geometry", "boolean"), F.lit(False)))


def with_format(catalog: DataFrame, column: str = "format") -> DataFrame:
    """Add the whole-table format: GeoParquet if the dataset carries geometry."""
    return catalog.withColumn(
        column, F.when(has_geometry(catalog), "geoparquet").otherwise("parquet"))


def with_route(catalog: DataFrame, *, geometry: bool = True, column: str = "route") -> DataFrame:
    """Add how a whole-table read is served, and whether bulk export is allowed or refused.

    ``bulk`` if a live read is blocked (geometry wanted, or a large table) and the bulk
    class allows export; ``live`` otherwise.
    """
    bulk_class = F.lower(F.coalesce(_field(catalog, "bulk_export_class"), F.lit("")))
    allowed = ~bulk_class.isin("", "none")
    blocked = F.coalesce(_field(catalog, "row_count_at_last_refresh", "long"), F.lit(0)) > LARGE_TABLE_ROWS
    if geometry:
        blocked = blocked | F.coalesce(_field(catalog, "has_geometry", "boolean"), F.lit(False))
    return (catalog.withColumn("bulk_allowed", allowed)
            .withColumn("bulk_refused", bulk_class == "none")
            .withColumn(column, F.when(allowed & blocked, "bulk").otherwise("live")))


def date_axis(catalog: DataFrame) -> Column:
    """Date column per dataset: the declared one if the catalogue declares, else from the glossary."""
    if "date_filter_column" in catalog.columns:
        return blank_to_null(F.col("date_filter_column"))
    if "columns" not in catalog.columns:
        return F.lit(None).cast("string")
    names = F.col("columns.name")
    return F.coalesce(*[F.when(F.array_contains(names, c), F.lit(c)) for c in DATE_COLUMN_CANDIDATES])


def reshape_path(catalog: DataFrame) -> Column:
    """Which reshape a dataset allows: ``to_long``, ``to_wide`` or ``refused``."""
    layout = F.lower(F.trim(F.coalesce(_field(catalog, "layout"), F.lit(""))))
    geometry = has_geometry(catalog)
    if "columns" in catalog.columns:
        geometry = geometry | F.coalesce(
            F.arrays_overlap(F.col("columns.name"), F.array(*[F.lit(c) for c in GEOMETRY_COLUMNS])),
            F.lit(False))
    return (F.when(geometry | layout.isin(*UNRESHAPABLE_LAYOUTS), "refused")
            .when(layout == "wide", "to_long").when(layout == "long", "to_wide")
            .otherwise("refused"))


def audit(catalog: DataFrame, *, geometry: bool = True) -> DataFrame:
    """One row per dataset: format, route, date column, layout and legal reshape."""
    routed = with_route(with_format(catalog), geometry=geometry)
    return routed.select(
        "name", "format", "route", "bulk_allowed", "bulk_refused",
        date_axis(catalog).alias("date_column"), _field(catalog, "layout").alias("layout"),
        reshape_path(catalog).alias("reshape"))


def licence_rollup(catalog: DataFrame) -> DataFrame:
    """Datasets per source and licence."""
    return catalog.groupBy("source", "licence").agg(F.count(F.lit(1)).alias("datasets"))


def override_provenance(catalog: DataFrame, provenance: DataFrame, on: str = "name",
                        keys: Sequence[str] = PROVENANCE_KEYS) -> DataFrame:
    """Catalogue and provenance records side by side; a non-blank provenance value wins.

    A full outer join in two halves, records with their catalogue row and catalogue rows
    without a record: AQE can split a name with many records in either half, but not in a
    full join.
    """
    keys = [k for k in keys if k in catalog.columns or k in provenance.columns]
    other = [c for c in catalog.columns if c != on and c not in keys]
    p, c = provenance.alias("p"), broadcast_if_small(catalog).alias("c")

    def merged(k: str) -> Column:
        sides = []
        if k in provenance.columns:
            sides.append(F.nullif(F.col(f"p.{k}"), F.lit("")))
        if k in catalog.columns:
            sides.append(F.col(f"c.{k}"))
        return F.coalesce(*sides).alias(k)

    recorded = p.join(c, F.col(f"p.{on}") == F.col(f"c.{on}"), "left").select(
        F.col(f"p.{on}").alias(on), *[F.col(f"c.{o}") for o in other], *[merged(k) for k in keys])
    unrecorded = catalog.join(provenance.select(on).distinct(), on, "left_anti")
    return recorded.unionByName(unrecorded.select(on, *other, *[k for k in keys if k in catalog.columns]),
                                allowMissingColumns=True)


def attach_metadata(df: DataFrame, catalog: DataFrame, on: str, fields: Sequence[str]) -> DataFrame:
    """Add catalogue fields to rows of several datasets; unknown datasets get nulls.

    The catalogue side is broadcast if it measures small; otherwise AQE splits a dataset
    that holds a large share of the rows.
    """
    side = catalog.select(F.col("name").alias(on), *fields)
    return df.join(broadcast_if_small(side), on, "left")


def labelled(df: DataFrame, entries: TableMeta) -> DataFrame:
    """Put glossary descriptions into the schema as column comments."""
    for f in df.schema.fields:
        text = entries.column_label(f.name)
        if text:
            df = df.withMetadata(f.name, {**f.metadata, "comment": text})
    return df


def with_source(df: DataFrame, source: str, column: str = "source") -> DataFrame:
    """Label rows with the source they were read from."""
    return df.withColumn(column, F.lit(source))
