import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from statlake import (
    Lake, LayoutError, StatlakeError, VersionedTable, read_catalog, read_changes, read_envelope, read_records,
    read_table, same_rows, sync_snapshot, to_records, write_table,
)
from statlake.operators import catalog as cat
from statlake.plans.lineage import cut_lineage, scratch_path
from statlake.plans.sizing import broadcast_if_small, measured_bytes
from statlake.sources.readers import parse_date

ROW = T.StructType([T.StructField("date", T.StringType()), T.StructField("value", T.DoubleType())])


def put(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload))
    return str(path)


@pytest.mark.parametrize("payload", [{"datasets": [{"name": "a"}, {"name": "b"}]}, [{"name": "a"}, {"name": "b"}]])
def test_catalog_payloads(spark, tmp_path, payload):
    got = read_catalog(spark, put(tmp_path / "c.json", payload))
    assert sorted(r["name"] for r in got.collect()) == ["a", "b"]


def test_empty_payloads(spark, tmp_path):
    assert read_catalog(spark, put(tmp_path / "c.json", {"datasets": []})).count() == 0
    assert read_records(spark, put(tmp_path / "r.json", {"data": []})).count() == 0
    assert read_records(spark, str(tmp_path / "r.json"), ROW).columns == ["date", "value"]
    assert read_records(spark, str(tmp_path / "r.json"), ROW).count() == 0


@pytest.mark.parametrize("schema", [None, ROW])
@pytest.mark.parametrize("wrapped", [True, False])
def test_record_payloads(spark, tmp_path, rows, schema, wrapped):
    data = [{"date": "2024-01-01", "value": 1.5}, {"date": "2024-02-01", "value": None}]
    put(tmp_path / "in" / "1.json", {"data": data} if wrapped else data)
    put(tmp_path / "in" / "2.json", {"data": data[:1]} if wrapped else data[:1])
    got = read_records(spark, str(tmp_path / "in"), schema)
    assert rows(got) == [("2024-01-01", 1.5), ("2024-01-01", 1.5), ("2024-02-01", None)]


@pytest.mark.parametrize("schema", [None, ROW])
def test_envelope(spark, tmp_path, rows, schema):
    path = put(tmp_path / "e.json", {"data_sources": [{"name": "S", "licence": "CC-BY"}], "data": [{"date": "d", "value": 2.0}]})
    records, sources = read_envelope(spark, path, schema)
    assert rows(records) == [("d", 2.0)] and rows(sources) == [("CC-BY", "S")]
    records, sources = read_envelope(spark, put(tmp_path / "f.json", [{"date": "d", "value": 2.0}]), schema)
    assert rows(records) == [("d", 2.0)] and rows(sources) == []


@pytest.fixture()
def messy(spark):
    return spark.createDataFrame([
        (1, 'quote " and, comma', 0.1, dt.datetime(2024, 1, 2, 3, 4, 5, 678901), dt.date(2024, 2, 29), True),
        (2, "line\nbreak \\ and tāngata", None, None, None, None),
    ], "id long, text string, value double, ts timestamp, day date, ok boolean")


@pytest.mark.parametrize("format", ["parquet", "geoparquet", "csv", "csv_gz", "json", "orc"])
def test_round_trip(spark, tmp_path, messy, format):
    path = write_table(messy, str(tmp_path / "out"), format)
    assert same_rows(read_table(spark, path, format, schema=messy.schema, spread=True), messy)


@pytest.mark.parametrize("format", ["csv", "json"])
def test_nan_is_written_as_missing(spark, tmp_path, format):
    df = spark.createDataFrame([(1, float("nan"))], "id int, v double")
    path = write_table(df, str(tmp_path / "out"), format)
    assert read_table(spark, path, format, schema=df.schema).first()["v"] is None


def test_records_keep_nulls_and_text(spark):
    df = spark.createDataFrame([(None, "ā", float("nan"))], "a int, b string, c double")
    assert json.loads(to_records(df).first()["record"]) == {"a": None, "b": "ā", "c": None}


def test_unknown_formats(spark, tmp_path, messy):
    with pytest.raises(ValueError, match="unknown format"):
        write_table(messy, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError, match="unknown format"):
        read_table(spark, str(tmp_path), "xlsx")


def test_geometry_is_left_out_of_every_format(spark, tmp_path):
    df = spark.createDataFrame([(1, "POINT (1 2)")], "id int, geometry_wkt string")
    for format in ("parquet", "csv", "csv_gz"):
        path = write_table(df, str(tmp_path / format), format)
        assert read_table(spark, path, format, geometry=False).columns == ["id"]


def test_feed_pages_with_different_columns(spark, tmp_path, rows):
    path = str(tmp_path / "feed")
    spark.createDataFrame([(1, "I", 7)], "_seq long, _op string, id long").write.parquet(path)
    late = spark.createDataFrame([(2, "U", 7, "x")], "_seq long, _op string, id long, note string")
    late.write.mode("append").parquet(path)
    assert rows(read_changes(spark, path)) == [("I", 1, 7, None), ("U", 2, 7, "x")]
    assert rows(read_changes(spark, path, since=1, schema=late.schema)) == [("U", 2, 7, "x")]


def test_text_dates_are_parsed_and_bad_ones_refused(spark):
    df = parse_date(spark.createDataFrame([("2024-01-05",)], "date string"))
    assert df.first()["date"] == dt.datetime(2024, 1, 5)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        parse_date(spark.createDataFrame([("soon",)], "date string")).collect()


def test_broadcast_only_when_measured_small(spark, tmp_path):
    rows = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    assert 10_000 < measured_bytes(rows) < 12_000 and measured_bytes(rows.limit(0)) == 0
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    rows.write.parquet(str(tmp_path / "t"))
    written = spark.read.parquet(str(tmp_path / "t"))
    assert hinted(broadcast_if_small(written)) and not hinted(broadcast_if_small(written, 5_000))
    # Rows of which the planner does not know the size are never broadcast.
    assert not hinted(broadcast_if_small(rows))


def test_scratch_is_under_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    kept = cut_lineage(spark.range(5))
    assert kept.count() == 5
    app = spark.sparkContext.applicationId
    assert all(f"/statlake/{app}/cut-" in f for f in kept.inputFiles())


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "a1"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session, "x")
    Session.sparkContext.master = "local[2]"
    first, second = scratch_path(Session, "x"), scratch_path(Session, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


@pytest.fixture()
def lake(spark, tmp_path):
    series = spark.createDataFrame(
        [("2024-03-01", "North", 3.0), ("2024-01-01", "South", 1.0), ("2024-02-01", "north", 2.0)],
        "date string, area string, value double")
    shapes = spark.createDataFrame([(1, "POINT (1 2)")], "id int, geometry_wkt string")
    listing = [
        ("series", "RBNZ", write_table(series, str(tmp_path / "series")), None, "open", None, None),
        ("shapes", "LINZ", write_table(shapes, str(tmp_path / "shapes")), None, "none", True, None),
        ("texts", "RBNZ", write_table(series, str(tmp_path / "texts"), "csv"), "csv", None, None, "date"),
    ]
    schema = "name string, source string, path string, format string, bulk_export_class string, has_geometry boolean, layout string"
    catalog = spark.createDataFrame(listing, schema).withColumn(
        "columns", F.array(F.struct(F.when(F.col("name") != "shapes", "date").otherwise("id").alias("name"))))
    return Lake(spark, catalog)


def test_lake_reads(lake, spark, tmp_path):
    take = lambda d: [r["value"] for r in d.collect()]
    assert lake.list("RBNZ").count() == 2 and lake.search("shape").count() == 1
    assert take(lake.get("series", limit=2)) == [2.0, 3.0]
    assert take(lake.get("series", ordered=True)) == [1.0, 2.0, 3.0]
    assert take(lake.get("series", start="2024-02-01", ordered=True)) == [2.0, 3.0]
    assert take(lake.get("texts", end="2024-02-01", dimensions="NORTH")) == [2.0]
    assert lake.get("shapes", geometry=False).columns == ["id"]
    assert lake.preview("shapes").columns == ["id"]
    with pytest.warns(UserWarning, match="published by"):
        lake.get("series", source="oecd")
    with pytest.warns(UserWarning, match="no date column"):
        assert lake.get("shapes", start="2024-01-01").count() == 1
    with pytest.raises(StatlakeError):
        lake.get("absent")


def test_lake_exports(lake, spark, tmp_path):
    path = lake.download("series", str(tmp_path / "o1"), "csv", limit=1)
    assert read_table(spark, path, "csv").count() == 1
    path = lake.download_bulk("series", str(tmp_path / "o2"), "csv_gz")
    assert read_table(spark, path, "csv_gz").count() == 3
    with pytest.raises(StatlakeError, match="bulk"):
        lake.download_bulk("shapes", str(tmp_path / "o3"))


def test_lake_syncs_by_tier(spark, tmp_path):
    feed, place = str(tmp_path / "feed"), str(tmp_path / "prices")
    spark.createDataFrame([(1, "old", False), (1, "a", True), (2, "b", True)],
                          "id long, name string, is_current boolean").write.parquet(place)
    page = "_seq long, _op string, id long, name string, is_current boolean"
    spark.createDataFrame([(4, "I", 2, "b", True)], page).write.parquet(feed)
    catalog = spark.createDataFrame(
        [("prices", place, feed, "changelog", ["id"], "is_current = true", "s1"),
         ("fixed", place, None, None, None, None, "s1")],
        "name string, path string, feed_path string, cdc_serving_tier string, pk_columns array<string>, "
        "current_state_filter string, current_snapshot_id string")
    lake, root = Lake(spark, catalog), str(tmp_path / "copy")
    first = lake.sync("prices", root, bucket_count=2)
    assert (first.sync_mode, first.status, first.current_seq) == ("changelog", "downloaded", 4)
    spark.createDataFrame([(5, "D", 1, "a", True), (6, "I", 3, "c", True)], page).write.mode("append").parquet(feed)
    assert lake.sync("prices", root).ops_applied == 2
    assert sorted(tuple(r) for r in VersionedTable(spark, root).read().collect()) == [(2, "b", True), (3, "c", True)]
    other = str(tmp_path / "fixed")
    assert [lake.sync("fixed", other).status for _ in range(2)] == ["downloaded", "unchanged"]
    assert VersionedTable(spark, other).read().count() == 3


def test_bulk_export_by_freshness(lake, spark, tmp_path, monkeypatch):
    root = str(tmp_path / "versions")
    table = VersionedTable(spark, root)
    sync_snapshot(spark, root, spark.range(1), "s1")
    sync_snapshot(spark, root, spark.range(2), "s2")
    stamps = [r["committed_at"] for r in table.log().orderBy("version").collect()]
    assert stamps == sorted(stamps)
    between = dt.datetime.fromisoformat(stamps[1]).replace(tzinfo=dt.timezone.utc)
    assert table.version_before(between + dt.timedelta(seconds=2)).version == 2
    assert table.version_before(between - dt.timedelta(days=40)) is None
    path = lake.download_bulk("series", str(tmp_path / "b1"), root=root)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(StatlakeError, match="month"):
        lake.download_bulk("series", str(tmp_path / "b2"), root=root, freshness="monthly")
    monkeypatch.setattr(VersionedTable, "version_before", lambda self, moment: self.commit(1))
    path = lake.download_bulk("series", str(tmp_path / "b3"), root=root, freshness="monthly")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="freshness"):
        lake.download_bulk("series", str(tmp_path / "b4"), freshness="yearly")


def test_lake_reshapes_by_declared_layout(lake, spark):
    declared = lake.catalog.withColumn("layout", F.when(F.col("name") == "series", "long")) \
        .withColumn("id_columns", F.array(F.lit("date"))).withColumn("value_columns", F.array(F.lit("value"))) \
        .withColumn("measure_name_column", F.lit("area"))
    wide, layout = Lake(spark, declared).to_wide("series", names=["North", "South", "north"][:2] + ["x"])
    assert layout.value_columns == ("North", "South", "x")
    with pytest.raises(LayoutError):
        lake.to_long("texts")


def test_audit_of_a_lake(lake, rows):
    got = {r["name"]: (r["format"], r["route"], r["date_column"], r["reshape"]) for r in cat.audit(lake.catalog).collect()}
    assert got["series"] == ("parquet", "live", "date", "refused")
    assert got["shapes"] == ("geoparquet", "live", None, "refused")
