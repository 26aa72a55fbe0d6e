import pytest
from pyspark.sql import functions as F

from statlake import envelope, within_bbox

SHAPES = [
    ("POINT(1 2)", (1, 2, 1, 2)), ("point z (1 2 3)", (1, 2, 1, 2)), ("POINT ZM (1 2 3 4)", (1, 2, 1, 2)),
    ("MULTIPOINT ((1 2),(3 4))", (1, 2, 3, 4)), ("LINESTRING (174.5 -41.25, 1e2 -4.5E1)", (100, -45, 174.5, -41.25)),
    ("SRID=4326;POLYGON ((0 0, 4 0, 4 4, 0 0),(1 1, 2 1, 2 2, 1 1))", (0, 0, 4, 4)),
    ("MULTIPOLYGON (((.5 5., 1 0, 1 5, .5 5.)), ((9 9, 8 8, 9 8, 9 9)))", (0.5, 0, 9, 9)),
    ("GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (3 4, 5 -6))", (1, -6, 5, 4)),
    ("POINT EMPTY", None), ("", None), ("  ", None), (None, None), ("circle (1 2)", None), ("POINT (1)", None),
    ("POINT (1 e)", None), ("LINESTRING (1 2, x y)", None), ("LINESTRING (1 2, 3 4 oops)", None),
    ("POLYGON ((0 0, 1 1)", None), ("POINT (1 2 3 4 5)", None),
]


def test_envelopes(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(SHAPES)], "id int, geometry_wkt string")
    got = {r["id"]: (r["xmin"], r["ymin"], r["xmax"], r["ymax"]) for r in envelope(df).collect()}
    for i, (text, want) in enumerate(SHAPES):
        assert got[i] == (want or (None,) * 4), text


def test_bbox_is_containment(spark):
    df = spark.createDataFrame([(1, "POINT (1 1)"), (2, "LINESTRING (1 1, 9 1)"), (3, "bad"), (4, "POINT (5 5)")],
                               "id int, geometry_wkt string")
    inside = within_bbox(df, 0, 0, 5, 5)
    assert inside.columns == df.columns and sorted(r["id"] for r in inside.collect()) == [1, 4]
    assert sorted(r["id"] for r in within_bbox(envelope(df), 0, 0, 5, 5).collect()) == [1, 4]


def test_large_polygon(spark):
    ring = F.concat_ws(", ", F.transform(F.sequence(F.lit(0), F.lit(50_000)), lambda i: F.concat_ws(" ", i, -i)))
    df = spark.range(2).select(F.concat(F.lit("POLYGON (("), ring, F.lit(", 0 0))")).alias("geometry_wkt"))
    assert [tuple(r) for r in envelope(df).drop("geometry_wkt").distinct().collect()] == [(0, -50_000, 50_000, 0)]


@pytest.mark.parametrize("text, box", [
    ("GEOMETRYCOLLECTION (POINT EMPTY, POINT (1 2))", (1, 2, 1, 2)), ("MULTIPOINT (EMPTY, (3 4))", (3, 4, 3, 4)),
    ("MULTIPOLYGON (((0 0,2 0,2 2,0 0),(0 0,1 0,1 1,0 0)), EMPTY)", (0, 0, 2, 2)), ("LINEARRING (0 0, 1 0, 1 1, 0 0)", (0, 0, 1, 1)),
    ("POLYGON ((0 0, 1 0, 1 1, 0 1))", None), ("POLYGON ((0 0, 1 0, 0 0))", None), ("GEOMETRYCOLLECTION (POINT EMPTY)", None),
    ("POINT (1 2 junk)", None), ("LINESTRING (1 2,\n3 4)", (1, 2, 3, 4)), ("POINT (1,2)", None)])
def test_members_rings_and_line_breaks(spark, text, box):
    row = envelope(spark.createDataFrame([(text,)], "geometry_wkt string")).first()
    assert tuple(row)[1:] == (box or (None,) * 4)


def test_a_table_by_place_skips_files(spark, tmp_path):
    from statlake import write_by_place
    path = str(tmp_path / "places")
    points = spark.range(0, 40_000, 1, 4).select("id", ((F.col("id") * 7919) % 200 - 100).alias("x"), ((F.col("id") * 104_729) % 211 - 100).alias("y"))
    df = points.select("id", F.when(F.col("id") % 50 == 0, None).otherwise(F.concat(F.lit("POINT ("), "x", F.lit(" "), "y", F.lit(")"))).alias("geometry_wkt"))
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_by_place(df, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(path)
    assert stored.count() == 40_000 and stored.columns == ["id", "geometry_wkt", "xmin", "ymin", "xmax", "ymax"]
    inside = within_bbox(stored, 10, 10, 30, 30).select("id")
    want = {r["id"] for r in points.filter("x BETWEEN 10 AND 30 AND y BETWEEN 10 AND 30 AND id % 50 <> 0").collect()}
    assert {r["id"] for r in inside.collect()} == want and len(want) > 100
    plan = inside._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(xmin,10" in plan.toString() and "rlike" not in plan.toString()
    while "AdaptiveSparkPlanExec" in plan.getClass().getName():
        plan = plan.executedPlan()
    while "FileSourceScanExec" not in plan.getClass().getName():
        plan = plan.children().apply(0)
    assert plan.metrics().apply("numOutputRows").value() < 40_000 / 4  # the box is a hundredth of the area


def test_codes_on_the_curve(spark):
    from statlake.operators.geo import curve_code
    rows = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (3.0, 3.0), (-5.0, 99.0), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "x double, y double").select(curve_code(F.col("x"), F.col("y"), (0, 0, 4, 4)).alias("c"))
    unit = 1 << 28  # a quarter of an axis, in both its bits
    assert [r["c"] // unit for r in df.collect()] == [0, 1, 2, 15, 10, 15]
    flat = spark.createDataFrame(rows, "x double, y double").select(curve_code(F.col("x"), F.col("y"), (1, 1, 1, 1)).alias("c"))
    assert {r["c"] for r in flat.collect()} == {0}


def test_a_table_without_boxes_by_place(spark, tmp_path):
    from statlake import write_by_place
    df = spark.createDataFrame([(1, "broken"), (2, None)], "id int, geometry_wkt string")
    write_by_place(df, str(tmp_path / "none"))
    assert within_bbox(spark.read.parquet(str(tmp_path / "none")), 0, 0, 1, 1).count() == 0
    write_by_place(df.limit(0), str(tmp_path / "empty"), bounds=(0, 0, 1, 1))
    assert spark.read.parquet(str(tmp_path / "empty")).count() == 0


def test_files_follow_the_length_of_the_texts(spark, tmp_path, monkeypatch):
    from statlake import write_by_place
    from statlake.operators import geo
    monkeypatch.setattr(geo, "FILE_BYTES", 100_000)
    line = F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda n: F.concat_ws(" ", n + F.col("id"), n)), ", "), F.lit(")"))
    df = spark.range(0, 1000, 1, 2).select("id", line.alias("geometry_wkt"))  # some 1.5 MB, of which the planner expects 28 bytes a row
    write_by_place(df, str(tmp_path / "long"), bounds=(0, 0, 1200, 200))
    stored = spark.read.parquet(str(tmp_path / "long"))
    assert stored.count() == 1000 and stored.select(F.input_file_name()).distinct().count() > 10
