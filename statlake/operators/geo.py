"""Bounding boxes of WKT geometry, with built-in text functions, and tables laid out by place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.wkt import bounding_box
from ..plans.sizing import measured_bytes, quoted

FILE_BYTES = 128 << 20  # of rows as they are sorted, before they are encoded and compressed
CURVE_BITS = 16  # per axis
BOX = ("xmin", "ymin", "xmax", "ymax")


def envelope(df: DataFrame, wkt: str = "geometry_wkt") -> DataFrame:
    """Add ``xmin, ymin, xmax, ymax``; null for blank, empty or malformed geometry."""
    boxed = df.withColumn("__box", bounding_box(F.col(quoted(wkt))))
    return boxed.withColumns({b: F.col(f"__box.{b}") for b in BOX}).drop("__box")


def _inside(box: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    return ((box["xmin"] >= xmin) & (box["ymin"] >= ymin)
            & (box["xmax"] <= xmax) & (box["ymax"] <= ymax))


def within_bbox(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float,
                wkt: str = "geometry_wkt") -> DataFrame:
    """Rows whose geometry's box lies inside the given box.

    If the table already has box columns they are used, and the range reaches the scan.
    """
    if all(b in df.columns for b in BOX):
        return df.filter((F.col("xmin") >= xmin) & (F.col("ymin") >= ymin)
                         & (F.col("xmax") <= xmax) & (F.col("ymax") <= ymax))
    # One reference to the box: a filter on four columns would find it four times.
    box = F.array(bounding_box(F.col(quoted(wkt))))
    return df.filter(F.exists(box, lambda b: _inside(b, xmin, ymin, xmax, ymax)))


def _spread(bits: Column) -> Column:
    """The bits of a number of ``CURVE_BITS`` bits, each followed by a zero."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def curve_code(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> Column:
    """Place on a Z-order curve over ``xmin, ymin, xmax, ymax``: near points mostly get near codes; what lies outside counts as on the edge."""
    def cell(value: Column, low: float, high: float) -> Column:
        share = (value - low) / (high - low) if high > low else F.lit(0.0)
        top = (1 << CURVE_BITS) - 1
        return F.least(F.greatest(F.floor(share * (top + 1)), F.lit(0)), F.lit(top)).cast("long")

    return _spread(cell(x, bounds[0], bounds[2])).bitwiseOR(F.shiftleft(_spread(cell(y, bounds[1], bounds[3])), 1))


def write_by_place(df: DataFrame, path: str, wkt: str = "geometry_wkt", bounds: tuple[float, float, float, float] | None = None) -> None:
    """Write a table with the boxes of its geometry, in the order of their centres on a curve.

    Files and row groups then cover small areas, and their statistics let ``within_bbox`` on the table that is read back skip most of them.
    Rows without a box come first.  One aggregation measures the rows.  Without ``bounds`` another finds the extent, which parses every geometry once more.
    """
    boxed = df if all(b in df.columns for b in BOX) else envelope(df, wkt)
    x, y = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    if bounds is None:
        bounds = tuple(boxed.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first())
    code = F.lit(None).cast("long") if None in bounds else curve_code(x, y, bounds)
    # The planner knows nothing of how long texts are, and a task sorts all rows of its file.
    files = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-measured_bytes(df) // FILE_BYTES))
    # A place with a large share of the rows is split by a hash of the row's box.
    order = [F.col("__code").asc_nulls_first(), F.xxhash64(*BOX, quoted(wkt) if wkt in boxed.columns else "xmin")]
    boxed.withColumn("__code", code).repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__code").write.parquet(path)
