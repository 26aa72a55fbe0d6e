import pytest

from statlake import TableMeta, search_catalog, search_rows, source_mismatch
from statlake.functions.fixed_values import PUBLISHERS, TABLE_META_KEYS
from statlake.operators import catalog as cat
from statlake.operators.search import compact_hits, expand_terms

ROWS = [
    ("firms_employment", "Firm employment", "Stats NZ", None),
    ("nz_unemployment", "Unemployment Rate", "OECD", None),
    ("rbnz_m9_labour_market", "Labour Market", "RBNZ", "M9"),
    ("nz_cpi", "CPI, annual change", "OECD", None),
    ("rbnz_m1_prices", "Prices and inflation", "RBNZ", None),
    ("wholesale", "Wholesale rates", "RBNZ", "OCR and swaps; see Kapiti note"),
    ("kcdc_floods", "Flood extents", "Councils", None),
    ("odd", "100% (a+b)", "OECD", "None"),
]


@pytest.fixture()
def listing(spark):
    return spark.createDataFrame(ROWS, "name string, title string, source string, description string")


def names(df):
    return [r["name"] for r in df.collect()]


def test_terms():
    assert "labour force" in expand_terms(" HLFS ")
    assert expand_terms("Rent") == ("rent",)
    assert expand_terms("  ") == expand_terms(None) == ()


def test_alias_hits_are_ranked_and_tight(listing):
    assert names(search_catalog(listing, "HLFS")) == ["nz_unemployment", "rbnz_m9_labour_market"]
    assert names(search_catalog(listing, "cpi")) == ["rbnz_m1_prices", "nz_cpi"]


def test_name_only_alias_skips_descriptions(listing):
    assert names(search_catalog(listing, "kapiti")) == ["kcdc_floods"]
    assert names(search_catalog(listing, "ocr")) == ["wholesale"]


def test_source_filter_blank_query_and_literal_text(listing):
    assert names(search_catalog(listing, "", source="RBNZ")) == ["rbnz_m9_labour_market", "rbnz_m1_prices", "wholesale"]
    assert names(search_catalog(listing, "cpi", source="OECD")) == ["nz_cpi"]
    assert names(search_catalog(listing, "(A+B)")) == ["odd"]
    assert names(search_catalog(listing, "none")) == ["odd"]  # missing text is empty, not a word


def test_absent_columns_count_as_empty(listing):
    assert names(search_rows(listing.drop("title", "description"), "cpi")) == ["nz_cpi", "rbnz_m1_prices"]
    assert compact_hits(listing).columns == ["name", "title", "source"]


def test_metadata_allowlist_and_labels(spark):
    info = {"name": "t", "title": None, "secret": 1, "pk_columns": ["id"], "layout": " Long ",
            "columns": [{"name": "a", "description": " first "}, {"name": "a", "description": "x"}, {"name": "b", "description": " "}]}
    meta = TableMeta.of(info)
    assert set(meta.table) == {"name", "title", "pk_columns", "layout"}
    assert meta.layout.kind == "long"
    assert (meta.column_label("a"), meta.column_label("b"), meta.column_label("c")) == ("first", None, None)
    assert len(TABLE_META_KEYS) == 26 and len(PUBLISHERS) == 35
    df = cat.labelled(spark.createDataFrame([(1,)], "a int"), meta)
    assert df.schema["a"].metadata["comment"] == "first"


def test_formats_and_routes(spark):
    schema = "name string, geometry_type string, geometry_wkt string, has_geometry boolean, bulk_export_class string, row_count_at_last_refresh long"
    df = spark.createDataFrame([
        ("plain", None, None, None, "open", 10), ("big", "", "none", False, "Open", 100_001),
        ("edge", "none", None, False, "open", 100_000), ("shape", "polygon", None, False, "open", 67),
        ("wkt", None, "geometry_wkt", None, None, None), ("flag", None, None, True, "open", 67),
        ("shut", None, None, True, "None", 10**7), ("blank", None, None, True, "", 10**7)], schema)
    formats = {r["name"]: r["format"] for r in cat.with_format(df).collect()}
    assert [n for n, f in formats.items() if f == "geoparquet"] == ["shape", "wkt", "flag", "shut", "blank"]
    routes = {r["name"]: (r["route"], r["bulk_allowed"], r["bulk_refused"]) for r in cat.with_route(df).collect()}
    assert routes["plain"] == routes["edge"] == routes["shape"] == ("live", True, False)
    assert routes["big"] == routes["flag"] == ("bulk", True, False)
    assert routes["shut"] == ("live", False, True)
    assert routes["blank"] == ("live", False, False)
    without = {r["name"]: r["route"] for r in cat.with_route(df, geometry=False).collect()}
    assert (without["flag"], without["big"]) == ("live", "bulk")


def test_describe_keeps_nested_fields(spark):
    catalog = spark.createDataFrame([("t", ["id"], [{"name": "id", "description": "key"}])],
                                    "name string, pk_columns array<string>, columns array<struct<name:string,description:string>>")
    meta = cat.describe(catalog, "t")
    assert meta.get("pk_columns") == ["id"] and meta.column_label("id") == "key"
    assert cat.describe(catalog, "u") is None


def test_provenance_wins_unless_blank(spark, rows):
    catalog = spark.createDataFrame([("a", "t", "cc", "x"), ("b", "t", "cc", "x")], "name string, title string, licence string, source string")
    records = spark.createDataFrame([("a", "cc0", ""), ("c", "own", "y")], "name string, licence string, source string")
    assert rows(cat.override_provenance(catalog, records).select("name", "licence", "source")) == [
        ("cc", "b", "x"), ("cc0", "a", "x"), ("own", "c", "y")]


def test_source_mismatch_ignores_blank(spark, rows):
    df = spark.createDataFrame([(1, "a", "OECD"), (2, "a", " "), (3, "a", None), (4, "a", "RBNZ "), (5, "b", "OECD")],
                               "id int, k string, source string")
    expected = spark.createDataFrame([("a", "RBNZ")], "k string, expected_source string")
    assert [r["id"] for r in source_mismatch(df, expected, ["k"]).collect()] == [1]
