"""Bounding boxes of WKT text, without Python code per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns of the WKT format: how a shape starts, which shapes are made of rings, and a list of coordinates.
SHAPE_START = (r"(?i)^\s*(?:srid=\d+;\s*)?"
               r"(?:(?:multi)?(?:point|linestring|polygon)|linearring|geometrycollection)\s*(?:zm|z|m)?\s*\(")
RINGS = r"(?i)^\s*(?:srid=\d+;\s*)?(?:(?:multi)?polygon|linearring)"
COORDINATES = r"\(([-+0-9.eE\s,]+)\)"
EMPTY_MEMBER = r"(?i)\bempty\b"
LEAST_RING = 4  # coordinates of a ring, the first of which is repeated as the last


def _count(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def bounding_box(wkt: Column) -> Column:
    """Struct ``xmin, ymin, xmax, ymax``; null for blank, empty or malformed text.

    The lists of coordinates are found in one pass.  Between two commas stands one coordinate or one EMPTY member,
    so there are one more of these than commas, or something was not understood.  An open ring is malformed.
    """
    def numbers(coordinate: Column) -> Column:
        return F.transform(F.split(F.trim(F.translate(coordinate, "\t\r\n", "   ")), " +"), lambda n: n.try_cast("double"))

    def lists(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(COORDINATES), F.lit(1))
        return F.transform(found, lambda one: F.transform(F.split(one, ","), numbers))

    def shape(text: Column) -> Column:
        well_formed = (text.rlike(SHAPE_START) & F.endswith(F.rtrim(text), F.lit(")"))
                       & (_count(text, "(") == _count(text, ")")))
        return F.when(well_formed, F.struct(
            lists(text).alias("lists"), text.rlike(RINGS).alias("rings"),
            (_count(text, ",") + 1).alias("n"),
            F.when(F.contains(F.upper(text), F.lit("EMPTY")), F.regexp_count(text, F.lit(EMPTY_MEMBER))).otherwise(0).alias("empty")))

    def closed(ring: Column) -> Column:
        first, last = F.element_at(ring, 1), F.element_at(ring, -1)
        return (F.size(ring) >= LEAST_RING) & (F.get(first, F.lit(0)) == F.get(last, F.lit(0))) & (F.get(first, F.lit(1)) == F.get(last, F.lit(1)))

    def box(found: Column) -> Column:
        every = F.flatten(found["lists"])

        def of(points: Column) -> Column:
            whole = ((F.size(points) > 0) & (F.size(points) + found["empty"] == found["n"])
                     & F.forall(points, lambda p: F.size(p).between(2, 4) & ~F.exists(p, lambda n: n.isNull()))
                     & (~found["rings"] | F.forall(found["lists"], closed)))
            x, y = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
            return F.when(whole, F.struct(F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"),
                                          F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax")))

        return F.element_at(F.transform(F.array(every), of), 1)

    # One-element arrays bind what is used several times, so that it is computed once.
    return F.element_at(F.transform(F.transform(F.array(wkt), shape), box), 1)
