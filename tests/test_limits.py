import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statlake import capped, first_n, most_recent, preview, sort_by_date
from statlake.operators import limits
from statlake.operators.ranking import with_row_index

SERIES = [("2020-03-01", 3), ("2020-01-01", 1), (None, 9), ("2020-04-01", 4), ("2020-02-01", 2)]


@pytest.fixture()
def series(spark):
    return spark.createDataFrame(SERIES, "date string, value int")


def values(df):
    return [r["value"] for r in df.collect()]


def test_sort_is_ascending_with_undated_last(series):
    assert values(sort_by_date(series)) == [1, 2, 3, 4, 9]
    assert values(sort_by_date(series.drop("date"))) == [3, 1, 9, 4, 2]


def test_sort_is_stable(spark):
    df = spark.createDataFrame([("2020-01-01", i) for i in range(50)] + [("2019-01-01", -1)], "date string, value int")
    assert values(sort_by_date(df, stable=True)) == [-1, *range(50)]
    assert values(sort_by_date(df, tie_break=["value"])) == [-1, *range(50)]
    assert sorted(values(sort_by_date(df))) == [-1, *range(50)]


def test_sort_splits_a_hot_date(spark):
    df = spark.range(20_000).select(F.lit("2020-01-01").alias("date"), "id", F.create_map("id", "id").alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sort_by_date(df).select(F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = Counter(r["p"] for r in found)
    assert len(sizes) > 1 and max(sizes.values()) < 10_000


def test_most_recent_returns_ascending(series):
    assert values(most_recent(series, 2)) == [4, 9]
    assert values(most_recent(series, 2, undated="exclude")) == [3, 4]
    assert values(most_recent(series, 100)) == [1, 2, 3, 4, 9]


@pytest.mark.parametrize("n", [None, 0, -1])
def test_no_limit_keeps_all(series, n):
    assert len(values(most_recent(series, n))) == 5


def test_ties_go_to_tie_break_then_later_row(spark):
    df = spark.createDataFrame([("d", 5), ("d", 7), ("d", 6)], "date string, value int")
    assert values(most_recent(df, 1, tie_break=["value"])) == [7]
    assert values(most_recent(df, 1)) == [6]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
@pytest.mark.parametrize("undated", ["latest", "exclude"])
def test_two_passes_give_the_same(spark, n, undated):
    df = spark.createDataFrame([("b", 1), ("c", 2), ("c", 3), (None, 4), ("a", 5)], "date string, value int")
    take = lambda d: values(most_recent(d, n, tie_break=["value"], undated=undated, two_pass=True))
    assert take(df) == values(most_recent(df, n, tie_break=["value"], undated=undated))
    undated_only = df.filter("date is null")
    assert take(undated_only) == ([4] if undated == "latest" else [])


def test_first_n_without_date(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "value int")
    assert values(most_recent(df, 2)) == [3, 1]
    assert values(first_n(df, 2, ["value"])) == [1, 2]


@pytest.mark.parametrize("n", [1, 7, 250, 999, 2000])
@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,2)", "date", "timestamp", "string", "boolean", "binary"])
def test_one_plan_for_every_number_and_type(spark, n, kind):
    """Ties, nulls and NaN, against a sort of all rows."""
    number = F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 37) % 97 - 40)
    if kind == "double":
        number = F.when(F.col("id") % 13 == 0, float("nan")).otherwise(number)
    value = {"date": F.date_add(F.lit("2020-01-01").cast("date"), number.cast("int")), "timestamp": F.timestamp_seconds(number * 100_000),
             "boolean": number % 2 == 0}.get(kind, number.cast("string").cast(kind) if kind == "binary" else number.cast(kind))
    df = spark.range(0, 1000, 1, 5).select(value.alias("date"), F.col("id").alias("value"))
    latest = df.orderBy(F.col("date").desc_nulls_first(), F.col("value").desc()).limit(n).collect()
    assert sorted(values(most_recent(df, n, tie_break=["value"]))) == sorted(r["value"] for r in latest)
    first = [r["value"] for r in df.orderBy(F.col("date").asc_nulls_last(), "value").limit(n).collect()]
    assert sorted(values(first_n(df, n, ["date", "value"]))) == sorted(first)
    assert sorted(values(first_n(df, n, ["value"]))) == list(range(min(n, 1000)))


def test_the_cut_off_leaves_about_the_rows_asked_for(spark):
    df = spark.range(0, 200_000, 1, 8).select(((F.col("id") * 7919) % 200_003).alias("date"), "id")
    for descending in (True, False):
        left = limits._within_cut_off(df, 5000, "date", descending).count()
        assert 5000 <= left <= 2 * (5000 + limits.SKETCH_ERROR * 200_000)


def test_a_sketch_that_is_off_does_no_harm(spark, monkeypatch):
    monkeypatch.setattr(limits, "SKETCH_ERROR", -0.02)  # asks for too few rows
    df = spark.range(0, 50_000, 1, 8).select(F.col("id").alias("date"))
    assert [r["date"] for r in most_recent(df, 1100).collect()] == list(range(48_900, 50_000))


def test_row_index_is_dense_over_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.lit(4999) - F.col("id")).alias("k"))
    got = with_row_index(df.repartition(7), ["k"])
    assert got.filter("k != row_index").count() == 0 and got.count() == 5000


def test_row_index_splits_a_hot_value(spark):
    df = spark.range(4000).select(F.lit(1).alias("hot"), "id")
    got = with_row_index(df, ["hot", "id"])
    assert got.filter("id != row_index").count() == 0


def test_preview_hides_geometry_and_caps(spark):
    df = spark.range(30).withColumn("geometry_wkt", F.lit("POINT (1 2)"))
    assert preview(df).columns == ["id"]
    assert preview(df, 25).count() == 10
    assert preview(df, 3).count() == 3


def test_capped_export(spark):
    df = spark.range(600).select("id", F.lit(None).cast("string").alias("note"))
    out = capped(df, 10_000)
    assert (out.limit, len(out.records), out.truncated) == (500, 500, True)
    assert json.loads(out.records[0]) == {"id": 0, "note": None}
    whole = capped(df.limit(3), 5)
    assert (len(whole.records), whole.truncated) == (3, False)
    assert capped(df, 0).limit == 1
    assert capped(df, 5).total is None and capped(df, 5, count=True).total == 600
