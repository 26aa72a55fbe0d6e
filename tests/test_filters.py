import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from statlake import (
    Layout, TableMeta, current_state, date_range, dimension_contains, from_publisher, from_source,
    resolve_date_column, without_geometry,
)


def test_source_is_exact_and_unknown_gives_nothing(spark, rows):
    df = spark.createDataFrame([("a", "Stats NZ"), ("b", "stats nz"), ("c", None)], "name string, source string")
    assert rows(from_source(df, "Stats NZ")) == [("a", "Stats NZ")]
    assert rows(from_source(df, "statsnz")) == []
    assert rows(from_publisher(df, "statsnz")) == rows(from_publisher(df, "Stats NZ")) == [("a", "Stats NZ")]
    assert rows(from_source(df, "Nobody")) == []
    assert len(rows(from_source(df, None))) == 3


def test_date_column_explicit_null_wins_over_candidates():
    glossary = [{"name": "start_date"}, {"name": "time_frame"}]
    assert resolve_date_column(TableMeta.of({"date_filter_column": "when", "columns": glossary}), []) == "when"
    assert resolve_date_column(TableMeta.of({"date_filter_column": None, "columns": glossary}), ["date"]) is None
    assert resolve_date_column(TableMeta.of({"columns": glossary}), ["date"]) == "time_frame"
    assert resolve_date_column(TableMeta.of({"columns": [{"name": "id"}]}), ["date"]) is None
    assert resolve_date_column(None, ["x", "open_date"]) == "open_date"
    assert resolve_date_column(None, ["x"]) is None


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_date_range_is_inclusive_for_every_type(spark, kind):
    df = spark.createDataFrame([(d,) for d in ("2020-01-01", "2020-06-30", "2020-07-01", None)], "date string")
    df = df.withColumn("date", F.col("date").cast(kind))
    assert date_range(df, "2020-01-01", "2020-06-30").count() == 2
    assert date_range(df, start="2020-06-30").count() == 2
    assert date_range(df, end="2020-01-01").count() == 1
    assert date_range(df).count() == 4


def test_end_bound_is_taken_as_given(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 6, 30, 0, 0),), (dt.datetime(2020, 6, 30, 9, 0),)], "date timestamp")
    assert date_range(df, end="2020-06-30").count() == 1


def test_no_date_axis_keeps_rows_and_warns(spark):
    df = spark.createDataFrame([(1, "2020-01-01")], "id int, date string")
    with pytest.warns(UserWarning, match="no date column"):
        assert date_range(df, "2021-01-01", meta=TableMeta.of({"name": "t", "date_filter_column": None})).count() == 1
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert date_range(df, meta=TableMeta.of({"date_filter_column": None})).count() == 1


def test_malformed_bound_is_refused(spark):
    df = spark.createDataFrame([("2020-01-01",)], "date string")
    with pytest.raises(ValueError):
        date_range(df, start="last week")


def test_dimension_contains(spark, rows):
    df = spark.createDataFrame(
        [(1, "North Shore", "Rent", "x"), (2, "South", "NORTHERN rents", "x"), (3, None, "100%", "north")],
        "id int, area string, measure string, geometry_wkt string")
    take = lambda d: sorted(r["id"] for r in d.collect())
    assert take(dimension_contains(df, "nORTH")) == [1, 2]  # geometry is no dimension
    assert take(dimension_contains(df, "0%")) == [3]  # literal text
    assert take(dimension_contains(df, "north", columns=["area"])) == [1]
    layout = Layout("long", id_columns=("area", "measure"), time_columns=("measure",))
    assert take(dimension_contains(df, "north", layout=layout)) == [1]
    assert take(dimension_contains(df, None)) == [1, 2, 3]


def test_without_geometry_keeps_rows(spark):
    df = spark.createDataFrame([(1, "POINT (1 2)")], "id int, geometry_wkt string")
    assert without_geometry(df).columns == ["id"]
    assert without_geometry(df.drop("geometry_wkt")).count() == 1


@pytest.mark.parametrize("kind,values", [("boolean", [True, False, None]), ("string", ["TRUE", "False", None])])
def test_state_rule_matches_booleans_however_stored(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"is_current {kind}")
    assert current_state(df, "is_current = true").count() == 1
    assert current_state(df, " is_current=FALSE ").count() == 1


def test_state_rule_text_and_numbers(spark):
    df = spark.createDataFrame([("active", 1), ("Active", 2), (None, 2)], "status string, version long")
    assert current_state(df, "status = active").count() == 1
    assert current_state(df, "status = none").count() == 0  # null never matches
    assert current_state(df, "version = 2").count() == 2
    assert current_state(df, "version = 02").count() == 2
    assert current_state(df, "version = two").count() == 0


def test_state_rule_that_does_not_apply(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert current_state(df, "is_current = true").count() == 1
    assert current_state(df, None).count() == 1
    assert current_state(df, "  ").count() == 1
    with pytest.warns(UserWarning, match="not of the form"):
        assert current_state(df, "id > 3").count() == 1
