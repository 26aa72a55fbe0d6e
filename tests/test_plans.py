"""What the physical plans look like, and how they behave when a key is hot."""

import contextlib

import pytest
from pyspark.sql import functions as F

from statlake.operators.cdc import without_keys
from statlake import (
    Layout, VersionedTable, date_range, dimension_contains, envelope, latest_per_key, merge_changes,
    most_recent, read_table, search_rows, sync_changelog, to_long, to_wide, within_bbox, without_geometry,
)
from statlake.operators.quality import duplicate_keys, signed_difference
from statlake.operators.ranking import with_row_index

FEED = "_seq long, _op string, id long, val string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def stored(spark, tmp_path):
    df = spark.range(1000).select(
        "id", (F.col("id") % 5).cast("string").alias("area"), F.lit("POINT (1 2)").alias("geometry_wkt"),
        F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp")).alias("date"),
        F.rand(1).alias("v1"), F.rand(2).alias("v2"))
    df.write.parquet(str(tmp_path / "t"))
    return str(tmp_path / "t")


def test_date_range_and_columns_reach_the_scan(spark, stored):
    text = plan(date_range(read_table(spark, stored, geometry=False), "2020-02-01", "2020-03-01").select("id"))
    assert "GreaterThanOrEqual(date" in text and "LessThanOrEqual(date" in text
    assert "geometry_wkt" not in text and "v1" not in text
    assert "Exchange" not in text


def test_geometry_is_never_read(spark, stored):
    assert "geometry_wkt" not in plan(without_geometry(read_table(spark, stored)))


def test_feed_cursor_reaches_the_scan(spark, tmp_path):
    from statlake import read_changes
    spark.createDataFrame([(1, "I", 1, "a")], FEED).write.parquet(str(tmp_path / "f"))
    assert "GreaterThan(_seq,5)" in plan(read_changes(spark, str(tmp_path / "f"), since=5))


@pytest.mark.parametrize("build", [
    lambda df: dimension_contains(df, "x"), lambda df: search_rows(df, "cpi", columns=("area",)),
    lambda df: to_long(df.drop("geometry_wkt"), Layout("wide", ("id",), ("v1", "v2")))[0],
    lambda df: envelope(df), lambda df: within_bbox(df, 0, 0, 1, 1)])
def test_narrow_operators_neither_shuffle_nor_use_python(spark, stored, build):
    text = plan(build(read_table(spark, stored)))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_box_filter_searches_the_text_once(spark, stored):
    text = plan(within_bbox(read_table(spark, stored), 0, 0, 1, 1).select("id"))
    filters = [line for line in text.splitlines() if "Filter exists" in line]
    assert len(filters) == 1 and filters[0].count("regexp_extract_all") == 1


def test_most_recent_is_a_top_k(spark, stored):
    text = plan(most_recent(read_table(spark, stored), 10, tie_break=["id"]))
    assert "TakeOrderedAndProject" in text and "kll_sketch_agg" in text
    # One plan, with two subqueries on the date alone, whatever the number of rows.
    for n in (1_001, 5_000, 1_000_000):
        more = plan(most_recent(read_table(spark, stored), n, tie_break=["id"]))
        assert [x for x in ("TakeOrderedAndProject", "Window", "rangepartitioning") if x in more] == [
            x for x in ("TakeOrderedAndProject", "Window", "rangepartitioning") if x in text]


def test_two_pass_skips_old_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id") \
        .repartitionByRange(10, "id").write.parquet(path)
    df = most_recent(spark.read.parquet(path), 20, two_pass=True)
    assert "GreaterThanOrEqual(date,ScalarSubquery" in plan(df)
    assert [r["id"] for r in df.collect()] == list(range(980, 1000))


def test_wide_is_one_shuffle_with_partial_aggregation(spark, stored):
    df = read_table(spark, stored).select("id", "area", "v1")
    wide, _ = to_wide(df, Layout("long", ("id",), ("v1",), measure_name_column="area"), names=["0", "1"])
    text = plan(wide)
    assert text.count("Exchange hashpartitioning") == 1 and text.count("partial_count") >= 1


def test_merge_broadcasts_small_keys_and_moves_no_state(spark, stored):
    state = read_table(spark, stored).select("id", "area")
    feed = spark.createDataFrame([(1, "U", 1, "x")], "_seq long, _op string, id long, area string")
    text = plan(without_keys(state, feed, ["id"], broadcast=True))
    anti = text[text.index("BroadcastHashJoin"):]
    assert "LeftAnti" in anti and "Exchange" not in anti[:anti.index("FileScan")]


def test_null_safe_keys_are_still_a_hash_join(spark, stored):
    state = read_table(spark, stored).select("id", "area")
    feed = spark.createDataFrame([(1, "U", 1, "x")], "_seq long, _op string, id long, area string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        text = plan(merge_changes(state, feed, ["id", "area"]))
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def _final_plan(df) -> str:
    df.collect()
    return plan(df)


def test_hot_key_in_the_state_is_split(spark):
    """A third of the state has one key; no single task gets all of it."""
    n = 300_000
    state = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("val"))
    feed = spark.range(1, n, 7).select((F.col("id")).alias("_seq"), F.lit("D").alias("_op"), "id", F.lit("").alias("val"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1,
                  spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
                  spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
                  spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.5,
                  spark__sql__adaptive__advisoryPartitionSizeInBytes="1m"):
        merged = merge_changes(state, feed, ["id"])
        text = _final_plan(merged)
        assert "SortMergeJoin(skew=true)" in text
        touched = {i for i in range(1, n, 7)}
        assert merged.filter("id = -1").count() == n // 3
        assert merged.count() == n // 3 + sum(1 for i in range(n) if i % 3 and i not in touched)


@pytest.mark.parametrize("build", [
    lambda f: latest_per_key(f, ["id"]), lambda f: duplicate_keys(f, ["id"]),
    lambda f: signed_difference(f.select("id", "val"), f.select("id", "val").limit(0), "__n"),
    lambda f: merge_changes(f.drop("_seq", "_op").limit(0), f, ["id"], keep="latest")])
def test_hot_keys_are_combined_before_the_shuffle(spark, build):
    """With one key for all rows, each task sends at most one row per distinct group."""
    feed = spark.range(0, 100_000, 1, 8).select(
        F.col("id").alias("_seq"), F.lit("U").alias("_op"), F.lit(7).cast("long").alias("id"), F.lit("v").alias("val"))
    text = plan(build(feed))
    partial = [line for line in text.splitlines() if "partial_" in line]
    assert partial
    assert build(feed).count() == 1


def test_row_index_uses_no_single_task_window_over_data(spark):
    df = with_row_index(spark.range(1000).select(F.col("id").alias("k")), ["k"])
    text = plan(df)
    for line in text.splitlines():
        if "Window" in line:
            assert "__n" in line  # only the per-partition counts


def test_only_touched_buckets_are_listed(spark, tmp_path):
    root = str(tmp_path / "t")
    base = spark.range(500).select("id", F.lit("v").alias("val"))
    feed = spark.createDataFrame([(1, "U", 3, "w")], FEED)
    sync_changelog(spark, root, feed.limit(0), base, key=["id"], bucket_count=50)
    table = VersionedTable(spark, root)
    assert len(table.read(buckets=[3]).inputFiles()) == 1
    sync_changelog(spark, root, feed, base)
    assert table.commit().rows_written < 60


def test_hot_bucket_is_written_as_several_files(spark, tmp_path):
    root = str(tmp_path / "t")
    base = spark.range(0, 60_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("week"), "id",
        F.sha2(F.col("id").cast("string"), 512).alias("val"))
    feed = spark.createDataFrame([], "_seq long, _op string, week string, id long, val string")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="300k",
                  spark__sql__adaptive__coalescePartitions__minPartitionSize="1k"):
        sync_changelog(spark, root, feed, base, key=["week", "id"], bucket_by=["week"], bucket_count=4)
    table = VersionedTable(spark, root)
    files = max(len(table.read(buckets=[b]).inputFiles()) for b in table.commit().buckets)
    assert files > 1 and table.read().count() == 60_000
