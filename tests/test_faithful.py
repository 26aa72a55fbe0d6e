"""What must not get lost: nulls in digests, unnumbered rows, part files, blanks and line breaks, cells."""

import glob
import json
import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from statlake import Layout, to_wide
from statlake.model import SyncError
from statlake.operators.cdc import diff_rows, diff_snapshots
from statlake.operators.filters import date_range
from statlake.sources.readers import read_records, read_table
from statlake.sources.writers import to_records, write_table
from statlake.streaming.stream import polling_interval, read_feed_stream, stream_changelog
from statlake.streaming.sync import sync_changelog, sync_snapshot
from statlake.streaming.versions import VersionedTable

SCHEMA = "a long, b string, c array<string>, d struct<x: string, y: string>"
maybe = st.none() | st.sampled_from(["", "x", "null"])
row = st.tuples(st.none() | st.integers(0, 2), maybe, st.none() | st.lists(maybe, max_size=2), st.none() | st.tuples(maybe, maybe))


@given(st.lists(row, max_size=6), st.lists(row, max_size=6))
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_digests_see_nulls_in_every_column(spark, old, new):
    before, after = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    plain = lambda df: Counter(map(repr, df.collect()))
    assert plain(diff_rows(before, after, by_digest=True)) == plain(diff_rows(before, after))


def test_a_value_that_moves_between_nullable_columns(spark):
    old = spark.createDataFrame([(1, None, "x", [None, "a"])], "k long, a string, b string, c array<string>")
    new = spark.createDataFrame([(1, "x", None, [None, "a"])], old.schema)
    turned = spark.createDataFrame([(1, None, "x", ["a", None])], old.schema)
    assert sorted(r["_op"] for r in diff_rows(old, new, by_digest=True).collect()) == ["D", "I"]
    assert sorted(r["_op"] for r in diff_rows(old, turned, by_digest=True).collect()) == ["D", "I"]


def test_one_key_of_a_diff_spreads_over_tasks(spark):
    new = spark.range(20_000).selectExpr("1L AS k", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        feed = diff_snapshots(new.limit(0), new, ["k"])
        assert feed.count() == 20_000
        assert [r[0] for r in feed.orderBy("_seq").select("_seq").limit(3).collect()] == [1, 2, 3]
        assert feed.selectExpr("spark_partition_id() AS p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _feed(spark, rows):
    return spark.createDataFrame(rows, "_seq long, _op string, k long, v string")


def test_a_feed_row_without_a_number_is_refused(spark, tmp_path):
    state = spark.createDataFrame([(1, "a")], "k long, v string")
    sync_changelog(spark, str(tmp_path / "t"), _feed(spark, []), state, key=["k"], bucket_count=2)
    with pytest.raises(SyncError, match="no sequence number"):
        sync_changelog(spark, str(tmp_path / "t"), _feed(spark, [(1, "I", 2, "b"), (None, "I", 9, "z")]), state, key=["k"])


@pytest.mark.parametrize("format", ["parquet", "csv", "csv_gz", "json", "orc"])
def test_a_lost_part_file_is_noticed(spark, tmp_path, format):
    root, rows = str(tmp_path / "t"), spark.range(100).selectExpr("id", "concat('  text ', id, '\\n') AS t").repartition(4)
    assert sync_snapshot(spark, root, rows, "a", format=format).status == "downloaded"
    assert sync_snapshot(spark, root, rows, "a", format=format).status == "unchanged"
    assert Counter(VersionedTable(spark, root).read().collect()) == Counter(rows.collect())
    os.remove(sorted(glob.glob(f"{root}/data/*/part-*"))[0])
    assert sync_snapshot(spark, root, rows, "a", format=format).status == "updated"
    assert VersionedTable(spark, root).read().count() == 100


def test_a_stream_starts_on_a_feed_with_history(spark, tmp_path):
    root, pages, at = (str(tmp_path / n) for n in ("t", "feed", "checkpoint"))
    state = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    old, new, late = ([(1, "U", 1, "a")], [(3, "U", 1, "c"), (4, "D", 2, None)], [(2, "U", 1, "late")])
    _feed(spark, old).write.mode("append").parquet(pages)
    sync_changelog(spark, root, spark.read.parquet(pages), state, key=["k"], bucket_count=2)
    follow = lambda: stream_changelog(read_feed_stream(spark, pages, _feed(spark, []).schema), root, checkpoint=at)
    follow().awaitTermination()
    _feed(spark, new).write.mode("append").parquet(pages)
    follow().awaitTermination()
    assert [tuple(r) for r in VersionedTable(spark, root).read().select("k", "v").collect()] == [(1, "c")]
    _feed(spark, late).write.mode("append").parquet(pages)
    with pytest.raises(Exception, match="arrived late"):
        follow().awaitTermination()


AWKWARD = [(1, "  padded  "), (2, ""), (3, None), (4, "two\nlines"), (5, 'a "quote"'), (6, "a,b"), (7, "\r"), (8, "end\r\n"),
           (9, "#no comment"), (10, '"'), (11, " "), (12, "\\"), (13, "null"), (14, "back\\\"slash")]


@pytest.mark.parametrize("format", ["csv", "csv_gz"])
def test_texts_survive_csv(spark, tmp_path, format):
    df = spark.createDataFrame(AWKWARD, "id long, text string")
    path = write_table(df, str(tmp_path / "t"), format)
    assert sorted(map(tuple, read_table(spark, path, format, schema=df.schema).collect())) == AWKWARD


def test_nan_inside_nested_values(spark):
    nan = float("nan")
    df = spark.createDataFrame([([1.0, nan], (nan, "x"), {"k": nan}, [(nan,)]), (None, None, None, None)],
                               "a array<double>, s struct<f: double, t: string>, m map<string, float>, n array<struct<f: double>>")
    got = [json.loads(r[0]) for r in to_records(df).collect()]
    assert got == [{"a": [1.0, None], "s": {"f": None, "t": "x"}, "m": {"k": None}, "n": [{"f": None}]},
                   {"a": None, "s": None, "m": None, "n": None}]


def test_a_payload_with_a_null_list_has_no_row(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": null}')
    schema = spark.createDataFrame([], "a long, b string").schema
    assert read_records(spark, str(tmp_path / "p.json"), schema).count() == 0


@pytest.mark.parametrize("direct", [0, 64])
def test_two_rows_for_one_cell_always_raise(spark, monkeypatch, direct):
    from statlake.operators import reshape
    monkeypatch.setattr(reshape, "DIRECT_MEASURES", direct)
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "b", 3.0)], "id long, m string, v double")
    wide, _ = to_wide(df, Layout("long", ("id",), ("v",), measure_name_column="m"))
    for use in (lambda: wide.count(), lambda: wide.select("b").collect(), lambda: wide.collect()):
        with pytest.raises(Exception, match="two rows share"):
            use()


def test_wide_columns_are_named_by_one_rule(spark, monkeypatch):
    from statlake.operators import reshape
    df = spark.createDataFrame([(1, 1e20, 1.0), (1, 0.5, 2.0)], "id long, m double, v double")
    layout, found = Layout("long", ("id",), ("v",), measure_name_column="m"), []
    for direct in (0, 64):
        monkeypatch.setattr(reshape, "DIRECT_MEASURES", direct)
        found.append(to_wide(df, layout, fill=0.0)[0].collect())
    assert found[0] == found[1] and found[0][0].asDict() == {"id": 1, "0.5": 2.0, "1e+20": 1.0}


def test_text_that_is_no_date(spark):
    df = spark.createDataFrame([("2024-03-01",), ("2024Q1",), (None,), ("2020-01-01",)], "date string")
    with pytest.raises(Exception, match="no date"):
        date_range(df, "2024-01-01").collect()
    assert [r[0] for r in date_range(df, "2024-01-01", unreadable="drop").collect()] == ["2024-03-01"]
    assert [r[0] for r in date_range(df, "2024-01-01", unreadable="keep").collect()] == ["2024-03-01", "2024Q1"]


def test_plain_seconds():
    assert polling_interval("60") == "60 seconds"


def test_the_latest_commit_is_found_in_a_few_log_files(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(7):
        sync_snapshot(spark, root, spark.range(i + 1), f"s{i}")
    table = VersionedTable(spark, root)
    assert table.commit().version == 7 and table.commit(2).snapshot_id == "s1" and len(table._newest_log_files()) == 4


def test_a_truncated_feed_is_noticed_by_its_floor(spark, tmp_path):
    from statlake import Lake
    data, feed, root = (str(tmp_path / n) for n in ("data", "feed", "copy"))
    spark.createDataFrame([(1, "a")], "k long, v string").write.parquet(data)
    _feed(spark, [(1, "I", 1, "a")]).write.parquet(feed)
    listing = spark.createDataFrame([("t", data, feed, "changelog", ["k"], "s")],
                                    "name string, path string, feed_path string, cdc_serving_tier string, pk_columns array<string>, current_snapshot_id string")
    lake = Lake(spark, listing)
    lake.sync("t", root, bucket_count=2)
    spark.createDataFrame([(1, "later")], "k long, v string").write.mode("overwrite").parquet(data)
    _feed(spark, [(9, "I", 5, "z")]).write.mode("overwrite").parquet(feed)
    (tmp_path / "feed.floor").write_text("9")
    assert lake.sync("t", root, bucket_count=2).status == "updated"
    assert [tuple(r) for r in VersionedTable(spark, root).read().select("k", "v").collect()] == [(1, "later")]
