import pytest
from pyspark.sql import functions as F

from statlake import Layout, LayoutError, TableMeta, same_rows, to_long, to_wide
from statlake.operators import reshape

RATES = [("2024-01", 0.5, 1.5, None), ("2024-02", 0.6, float("nan"), 2.5)]
WIDE = Layout("wide", ("date",), ("usd", "aud", "eur"), ("date",), "currency")
LONG = Layout("long", ("date",), ("value",), ("date",), "currency")


@pytest.fixture()
def rates(spark):
    return spark.createDataFrame(RATES, "date string, usd double, aud double, eur double")


def test_to_long_drops_null_and_nan(rates, rows):
    long, layout = to_long(rates, WIDE)
    assert rows(long) == [("aud", "2024-01", 1.5), ("eur", "2024-02", 2.5),
                          ("usd", "2024-01", 0.5), ("usd", "2024-02", 0.6)]
    assert layout == LONG
    assert to_long(rates, WIDE, keep_nulls=True)[0].count() == 6


def test_name_column_falls_back(rates):
    assert to_long(rates, WIDE.but(measure_name_column=None))[0].columns == ["date", "measure", "value"]
    assert to_long(rates, WIDE, names_to="m", values_to="v")[0].columns == ["date", "m", "v"]


def test_ids_default_to_the_rest_and_undeclared_columns_vanish(rates):
    extra = rates.withColumn("note", F.lit("n"))
    assert "note" not in to_long(extra, WIDE)[0].columns
    assert "note" in to_long(extra, WIDE.but(id_columns=()))[0].columns


def test_series_ids(rates, rows):
    meta = TableMeta.of({"layout": "wide", "id_columns": ["date"], "value_columns": ["usd", "aud"], "columns": [
        {"name": "usd", "series_id": "S1"}, {"name": "aud"}, {"name": "date", "series_id": ""}]})
    long, _ = to_long(rates, meta.layout)
    assert {(r["measure"], r["series_id"]) for r in long.collect()} == {("usd", "S1"), ("aud", None)}


def test_whole_and_fractional_measures_are_widened(spark):
    df = spark.createDataFrame([(1, 2, 0.5)], "id int, a int, b double")
    long, _ = to_long(df, Layout("wide", ("id",), ("a", "b")))
    assert sorted(r["value"] for r in long.collect()) == [0.5, 2.0]


def test_round_trip_on_dense_data(spark):
    names = [f"m{i:02d}" for i in range(20)]
    wide = spark.range(40).select(F.col("id").cast("string").alias("date"),
                                  *[(F.col("id") * i + 0.5).alias(n) for i, n in enumerate(names)])
    long, layout = to_long(wide, Layout("wide", ("date",), tuple(names), ("date",)))
    assert long.count() == 800
    back, layout = to_wide(long, layout)
    assert layout.kind == "wide" and layout.value_columns == tuple(names)
    assert same_rows(back, wide)
    again, _ = to_long(back, layout)
    assert same_rows(again, long)


LONG_ROWS = [("d1", "q", "n", "rent", 1.0), ("d1", "q", "n", "sales", 2.0), ("d2", "q", None, "rent", 3.0)]


@pytest.mark.parametrize("direct", [True, False])
def test_to_wide_with_two_dimensions_and_the_measure_among_ids(spark, rows, monkeypatch, direct):
    if not direct:
        monkeypatch.setattr(reshape, "DIRECT_MEASURES", 0)
    df = spark.createDataFrame(LONG_ROWS, "date string, period string, area string, measure string, value double")
    layout = Layout("long", ("date", "period", "area", "measure"), ("value",), ("date",), "measure")
    wide, declared = to_wide(df, layout)
    assert wide.columns == ["date", "period", "area", "rent", "sales"]
    assert rows(wide) == [("n", "d1", "q", 1.0, 2.0), (None, "d2", "q", 3.0, None)]
    assert declared.id_columns == ("date", "period", "area")
    filled, _ = to_wide(df, layout, fill=0)
    assert rows(filled) == [("n", "d1", "q", 1.0, 2.0), (None, "d2", "q", 3.0, 0.0)]
    assert rows(to_wide(df, layout, names=["sales", "rent"])[0]) == rows(wide)


@pytest.mark.parametrize("direct", [True, False])
@pytest.mark.parametrize("second", [5.0, None])
def test_two_rows_for_a_cell_are_an_error(spark, monkeypatch, direct, second):
    if not direct:
        monkeypatch.setattr(reshape, "DIRECT_MEASURES", 0)
    df = spark.createDataFrame([("d1", "usd", None), ("d1", "usd", second)], "date string, currency string, value double")
    with pytest.raises(Exception, match="two rows share one id"):
        to_wide(df, LONG)[0].collect()


@pytest.mark.parametrize("direct", [True, False])
def test_measure_outside_the_given_names_is_an_error(spark, monkeypatch, direct):
    if not direct:
        monkeypatch.setattr(reshape, "DIRECT_MEASURES", 0)
    df = spark.createDataFrame([("d1", "usd", 1.0), ("d1", "nzd", 1.0)], "date string, currency string, value double")
    with pytest.raises(Exception, match="not in the given names"):
        to_wide(df, LONG, names=["usd"])[0].collect()


@pytest.mark.parametrize("direct", [True, False])
def test_null_measure_name_and_text_values(spark, rows, monkeypatch, direct):
    if not direct:
        monkeypatch.setattr(reshape, "DIRECT_MEASURES", 0)
    df = spark.createDataFrame([("d1", None, "x"), ("d1", "b", "y")], "date string, currency string, value string")
    wide, _ = to_wide(df, LONG)
    assert wide.columns == ["date", "b", "null"] and rows(wide) == [("y", "d1", "x")]


def test_explicit_ids_and_columns(spark, rows):
    df = spark.createDataFrame([(1, "a", 2, 9)], "id int, what string, amount int, other int")
    wide, layout = to_wide(df, Layout("long"), names_from="what", values_from="amount", id_columns=["id"])
    assert rows(wide) == [(2, 1)] and layout.value_columns == ("a",)


def test_refusals(spark, rates):
    geo = rates.withColumn("geometry_wkt", F.lit("POINT (1 1)"))
    long = spark.createDataFrame([("d", "usd", 1.0)], "date string, currency string, value double")
    refused = [
        lambda: to_long(rates, None), lambda: to_wide(long, None),
        lambda: to_long(rates, Layout("feature")), lambda: to_wide(long, Layout("Entity ")),
        lambda: to_long(geo, WIDE), lambda: to_wide(geo, LONG),
        lambda: to_long(rates, LONG), lambda: to_wide(long, WIDE),
        lambda: to_long(rates, Layout("wide", ("date",), ("gone",))),
        lambda: to_wide(long, LONG.but(measure_name_column=None)),
        lambda: to_wide(long, LONG.but(value_columns=("value", "currency"))),
        lambda: to_wide(long, LONG, names_from="gone"), lambda: to_wide(long, LONG, values_from="gone"),
        lambda: to_long(rates, WIDE, values_to="usd"), lambda: to_long(rates, WIDE, names_to="DATE"),
        lambda: to_long(rates.withColumn("aud", F.lit("x")), WIDE),
        lambda: to_wide(spark.createDataFrame([("d", "USD", 1.0), ("d", "usd", 1.0)], long.schema), LONG),
    ]
    for attempt in refused:
        with pytest.raises(LayoutError):
            attempt()


def test_many_measures_are_not_widened_before_the_shuffle(spark):
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 700).alias("id"), (F.col("id") % 80).alias("m"), F.lit(1.0).alias("v")).distinct()
    layout = Layout("long", ("id",), ("v",), measure_name_column="m")
    wide = to_wide(df, layout, names=list(range(80)), tasks=9)[0]
    assert wide.count() == 700
    plan = wide._jdf.queryExecution().executedPlan().toString()
    above, found, _ = plan.partition("Exchange")
    assert found and ", 9), REPARTITION_BY_NUM" in plan and "pivotfirst" in above
    assert "pivotfirst" not in plan[len(above):]
    assert {tuple(r) for r in wide.collect()} == {tuple(r) for r in to_wide(df, layout, names=list(range(80)))[0].collect()}


def test_wide_many_uses_as_many_tasks_as_the_rows_ask_for(spark, tmp_path, monkeypatch):
    from statlake.plans import queries, sizing
    lines = spark.range(0, 9000, 1, 3).select((F.col("id") % 4000).alias("l_orderkey"), ((F.col("id") * 7) % 500).alias("l_partkey"),
                                              (F.col("id") % 31 + 0.5).alias("l_extendedprice"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries, "tasks_for", lambda df: sizing.tasks_for(df, 1000))
    wide = queries.lineitem_to_wide_many(spark, str(tmp_path))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count(", 9), REPARTITION_BY_NUM") == 1  # the second finds its rows dealt already
    got = {r["l_orderkey"]: sum(r[c] for c in wide.columns[1:]) for r in wide.collect()}
    want = {r["l_orderkey"]: r["s"] for r in lines.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s")).collect()}
    assert got == want
