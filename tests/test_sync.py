import pytest
from pyspark.sql import functions as F

from statlake import (
    SyncError, TableMeta, VersionedTable, polling_interval, read_feed_stream, stream_changelog,
    sync, sync_changelog, sync_log, sync_snapshot,
)
from statlake.streaming import sync as sync_module, versions

COLUMNS = "id long, val string"
FEED = "_seq long, _op string, id long, val string"


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "table")


def state(spark, *values):
    return spark.createDataFrame(list(values), COLUMNS)


def changes(spark, *values):
    return spark.createDataFrame(list(values), FEED)


def current(spark, root):
    return sorted(tuple(r) for r in VersionedTable(spark, root).read().collect())


# ------------------------------------------------------------------ snapshots

def test_snapshot_statuses(spark, root):
    first = sync_snapshot(spark, root, state(spark, (1, "a")), "s1")
    assert (first.status, first.previous_snapshot_id, first.current_snapshot_id) == ("downloaded", None, "s1")
    assert first.bytes_written > 0

    def untouched():
        raise AssertionError("an unchanged table must not be read")
    same = sync_snapshot(spark, root, untouched, "s1")
    assert (same.status, same.bytes_written, same.previous_snapshot_id) == ("unchanged", 0, "s1")
    new = sync_snapshot(spark, root, lambda: state(spark, (2, "b")), "s2")
    assert (new.status, new.previous_snapshot_id) == ("updated", "s1")
    assert current(spark, root) == [(2, "b")]
    assert sync_snapshot(spark, root, state(spark, (3, "c")), "s2", force=True).status == "updated"
    assert current(spark, root) == [(3, "c")]


def test_blank_snapshot_id_never_counts_as_equal(spark, root):
    sync_snapshot(spark, root, state(spark, (1, "a")), "")
    assert sync_snapshot(spark, root, state(spark, (2, "b")), "").status == "updated"
    assert current(spark, root) == [(2, "b")]


def test_missing_files_are_written_again(spark, root):
    sync_snapshot(spark, root, state(spark, (1, "a")), "s1")
    table = VersionedTable(spark, root)
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.data_path(table.commit(1).attempt))
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    assert sync_snapshot(spark, root, state(spark, (1, "a")), "s1").status == "updated"
    assert current(spark, root) == [(1, "a")]


def test_empty_snapshot_is_refused_and_leaves_the_table(spark, root):
    sync_snapshot(spark, root, state(spark, (1, "a")), "s1")
    with pytest.raises(SyncError, match="no rows"):
        sync_snapshot(spark, root, state(spark).limit(0), "s2")
    assert current(spark, root) == [(1, "a")]
    assert sync_snapshot(spark, root, state(spark).limit(0), "s2", allow_empty=True).status == "updated"
    assert current(spark, root) == []


@pytest.mark.parametrize("format", ["csv_gz", "csv", "json", "geoparquet"])
def test_snapshot_formats(spark, root, format):
    sync_snapshot(spark, root, state(spark, (1, "a,\"b\""), (2, None)), "s1", format=format)
    assert current(spark, root) == [(1, "a,\"b\""), (2, None)]
    assert sync_snapshot(spark, root, state(spark), "s1", format=format).status == "unchanged"


def test_failed_write_leaves_the_table(spark, root):
    sync_snapshot(spark, root, state(spark, (1, "a")), "s1")
    broken = spark.range(4).select("id", F.raise_error(F.lit("torn")).cast("string").alias("val"))
    with pytest.raises(Exception, match="torn"):
        sync_snapshot(spark, root, broken, "s2")
    assert current(spark, root) == [(1, "a")]
    assert sync_snapshot(spark, root, state(spark, (2, "b")), "s2").status == "updated"
    assert current(spark, root) == [(2, "b")]


# ------------------------------------------------------------------ changelogs

def test_changelog_life(spark, root):
    base = state(spark, *[(i, f"v{i}") for i in range(1, 21)])
    old = changes(spark, (5, "I", 20, "v20"))
    first = sync_changelog(spark, root, old, base, key=["id"], snapshot_id="s1", bucket_count=4)
    assert (first.status, first.previous_seq, first.current_seq, first.ops_applied) == ("downloaded", None, 5, 0)
    quiet = sync_changelog(spark, root, old, base)
    assert (quiet.status, quiet.previous_seq, quiet.current_seq) == ("unchanged", 5, 5)

    more = old.unionByName(changes(
        spark, (6, "D", 1, ""), (7, "D", 2, ""), (8, "I", 2, "new"), (9, "I", 21, "x"), (10, "D", 21, "x")))
    merged = sync_changelog(spark, root, more, base)
    assert (merged.status, merged.previous_seq, merged.current_seq, merged.ops_applied) == ("updated", 5, 10, 5)
    want = sorted([(2, "new"), *[(i, f"v{i}") for i in range(3, 21)]])
    assert current(spark, root) == want
    log = [(r["version"], r["status"], r["current_seq"], r["current_snapshot_id"])
           for r in sync_log(spark, root).orderBy("version").collect()]
    assert log == [(1, "downloaded", 5, "s1"), (2, "updated", 10, "s1")]


def test_only_touched_buckets_are_rewritten(spark, root):
    base = state(spark, *[(i, "v") for i in range(200)])
    sync_changelog(spark, root, changes(spark).limit(0), base, key=["id"], bucket_count=32)
    sync_changelog(spark, root, changes(spark, (1, "U", 7, "w")), base)
    commit = VersionedTable(spark, root).commit()
    assert list(commit.buckets.values()).count(commit.attempt) == 1 and commit.rows_written < 40
    assert len(current(spark, root)) == 200 and (7, "w") in current(spark, root)


def test_emptied_bucket_and_emptied_table(spark, root):
    base = state(spark, (1, "a"), (2, "b"))
    sync_changelog(spark, root, changes(spark).limit(0), base, key=["id"], bucket_count=16)
    feed = changes(spark, (1, "D", 1, "a"))
    sync_changelog(spark, root, feed, base)
    assert current(spark, root) == [(2, "b")]
    feed = feed.unionByName(changes(spark, (2, "D", 2, "b")))
    sync_changelog(spark, root, feed, base)
    assert current(spark, root) == []
    sync_changelog(spark, root, feed.unionByName(changes(spark, (3, "I", 9, "z"))), base)
    assert current(spark, root) == [(9, "z")]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_shuffled_and_broadcast_merges_agree(spark, root, limit):
    base = spark.range(500).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit("v").alias("val"))
    sync_changelog(spark, root, changes(spark).limit(0), base, key=["id"], bucket_count=4)
    feed = changes(spark, (1, "D", None, ""), *[(i + 2, "U", i * 3, "w") for i in range(1, 100)])
    table = VersionedTable(spark, root)
    sync_module.apply_changes(table, table.commit(), feed, broadcast_limit=limit)
    got = {r["id"]: r["val"] for r in table.read().collect()}
    assert len(got) == 499 and None not in got and sum(v == "w" for v in got.values()) == 99


def test_bucket_by_part_of_the_key(spark, root):
    base = spark.createDataFrame([("w1", i) for i in range(20)] + [("w2", i) for i in range(20)], "week string, id int")
    sync_changelog(spark, root, spark.createDataFrame([], "_seq long, _op string, week string, id int"), base,
                   key=["week", "id"], bucket_by=["week"], bucket_count=64)
    feed = spark.createDataFrame([(i + 1, "I", "w3", i) for i in range(20)], "_seq long, _op string, week string, id int")
    sync_changelog(spark, root, feed, base)
    assert VersionedTable(spark, root).commit().rows_written == 20
    assert VersionedTable(spark, root).read().count() == 60
    with pytest.raises(ValueError, match="bucket_by"):
        sync_changelog(spark, root, feed, base, key=["week"], bucket_by=["id"])


def test_feed_key_of_another_numeric_type(spark, root):
    base = state(spark, *[(i, "v") for i in range(50)])
    feed = changes(spark, (1, "D", 7, ""), (2, "U", 8, "w")).withColumn("id", F.col("id").cast("int"))
    sync_changelog(spark, root, feed.limit(0), base, key=["id"], bucket_count=16)
    sync_changelog(spark, root, feed, base)
    got = dict(current(spark, root))
    assert 7 not in got and got[8] == "w" and len(got) == 49


def test_new_columns_in_the_feed(spark, root):
    base = state(spark, *[(i, "v") for i in range(20)])
    feed = changes(spark, (1, "U", 7, "w")).withColumn("note", F.lit("n"))
    sync_changelog(spark, root, feed.limit(0), base, key=["id"], bucket_count=8)
    sync_changelog(spark, root, feed, base)
    got = {r["id"]: r["note"] for r in VersionedTable(spark, root).read().collect()}
    assert got[7] == "n" and got[6] is None and len(got) == 20


@pytest.mark.parametrize("column,kind", [("val", "long"), ("id", "double"), ("id", "string")])
def test_feed_that_changes_a_type_is_refused(spark, root, column, kind):
    base = state(spark, (1, "a"))
    feed = changes(spark, (1, "U", 1, "5")).withColumn(column, F.col(column).cast(kind))
    sync_changelog(spark, root, changes(spark).limit(0), base, key=["id"], bucket_count=2)
    with pytest.raises((SyncError, TypeError), match="in the feed"):
        sync_changelog(spark, root, feed, base)
    assert current(spark, root) == [(1, "a")]


def test_key_that_does_not_fit_is_an_error(spark, root):
    base = state(spark, (1, "a")).withColumn("id", F.col("id").cast("int"))
    sync_changelog(spark, root, changes(spark).limit(0), base, key=["id"], bucket_count=2)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        sync_changelog(spark, root, changes(spark, (1, "U", 2**40, "b")), base)


def test_expired_cursor_takes_the_baseline_again(spark, root):
    base = state(spark, (1, "a"))
    sync_changelog(spark, root, changes(spark, (5, "I", 1, "a")), base, key=["id"], bucket_count=2)
    feed = changes(spark, (8, "I", 2, "b"))
    assert sync_changelog(spark, root, feed, base, retention_floor=6).ops_applied == 1  # 5 was the last missed none
    again = sync_changelog(spark, root, changes(spark, (20, "I", 3, "c")), state(spark, (3, "c")),
                           retention_floor=15, snapshot_id="s2")
    assert (again.status, again.ops_applied, again.previous_seq, again.current_seq) == ("updated", 0, 8, 20)
    assert current(spark, root) == [(3, "c")]


def test_history_rows_never_enter_the_table(spark, root):
    columns = "id long, val string, is_current boolean"
    base = spark.createDataFrame([(1, "a", True), (1, "old", False)], columns)
    feed = spark.createDataFrame([(1, "D", 1, "a", True), (2, "I", 1, "a2", True), (3, "I", 1, "a", False)],
                                 "_seq long, _op string, " + columns)
    sync_changelog(spark, root, feed.limit(0), base, key=["id"], state_filter="is_current = true", bucket_count=2)
    assert current(spark, root) == [(1, "a", True)]
    sync_changelog(spark, root, feed, base)  # key and filter are remembered
    assert current(spark, root) == [(1, "a2", True)]


def test_dispatch_by_tier(spark, root):
    base = state(spark, (1, "a"))
    snapshot = TableMeta.of({"name": "t", "current_snapshot_id": "s1"})
    assert sync(spark, root, snapshot, base).sync_mode == "snapshot"
    served = TableMeta.of({"name": "t", "cdc_serving_tier": "changelog", "pk_columns": ["id"]})
    turned = sync(spark, root, served, base, changes(spark).limit(0), bucket_count=2)
    assert (turned.sync_mode, turned.status) == ("changelog", "downloaded")
    with pytest.raises(SyncError):
        sync(spark, root, served, base)
    with pytest.raises(ValueError, match="parquet"):
        sync(spark, root, served, base, changes(spark), format="csv")
    back = sync(spark, root, snapshot, base)
    assert (back.sync_mode, back.status) == ("snapshot", "updated")


def test_crash_before_the_log_row_changes_nothing(spark, root, monkeypatch):
    base, feed = state(spark, (1, "a"), (2, "b")), changes(spark, (1, "U", 1, "z"))
    sync_changelog(spark, root, feed.limit(0), base, key=["id"], bucket_count=2)
    with monkeypatch.context() as patch:
        patch.setattr(versions.VersionedTable, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            sync_changelog(spark, root, feed, base)
    assert current(spark, root) == [(1, "a"), (2, "b")]
    assert sync_changelog(spark, root, feed, base).ops_applied == 1
    assert current(spark, root) == [(1, "z"), (2, "b")]


def test_a_second_writer_leaves_committed_rows_alone(spark, root, monkeypatch):
    """Two writers that start from one commit write different directories, whichever commits last."""
    df = spark.range(10)
    sync_snapshot(spark, root, df, "s1")
    table = VersionedTable(spark, root)
    first = table.commit()
    monkeypatch.setattr(VersionedTable, "commit", lambda self, version=None: first)
    sync_snapshot(spark, root, spark.range(20), "s2")
    sync_snapshot(spark, root, spark.range(30), "s3")
    monkeypatch.undo()
    assert [r["version"] for r in table.log().orderBy("version").collect()] == [1, 2, 2]
    assert table.read(first).count() == 10 and table.read(table.commit()).count() == 30


# ------------------------------------------------------------------ streaming

def page(spark, path, *values):
    changes(spark, *values).coalesce(1).write.mode("append").parquet(path)


def follow(spark, path, root, checkpoint):
    schema = changes(spark).schema
    query = stream_changelog(read_feed_stream(spark, path, schema), root, checkpoint=checkpoint)
    query.awaitTermination()
    return query


@pytest.fixture()
def streamed(spark, root, tmp_path):
    base = state(spark, *[(i, "v") for i in range(10)])
    sync_changelog(spark, root, changes(spark).limit(0), base, key=["id"], bucket_count=4)
    return str(tmp_path / "feed"), root, str(tmp_path / "checkpoint")


def test_stream_applies_each_page_once(spark, streamed):
    feed, root, checkpoint = streamed
    page(spark, feed, (1, "U", 1, "a"), (2, "D", 2, ""))
    follow(spark, feed, root, checkpoint)
    page(spark, feed, (3, "I", 2, "b"), (4, "U", 1, "c"))
    follow(spark, feed, root, checkpoint)
    follow(spark, feed, root, checkpoint)
    got = dict(current(spark, root))
    assert (got[1], got[2], len(got)) == ("c", "b", 10)
    assert [r["current_seq"] for r in sync_log(spark, root).orderBy("version").collect()] == [0, 2, 4]


def test_stream_resumes_after_a_crash_on_either_side_of_the_commit(spark, streamed, monkeypatch):
    feed, root, checkpoint = streamed
    page(spark, feed, (1, "U", 1, "a"))
    real = versions.VersionedTable.append
    for before in (True, False):
        def torn(self, commit):
            if not before:
                real(self, commit)
            raise RuntimeError("killed")
        with monkeypatch.context() as patch:
            patch.setattr(versions.VersionedTable, "append", torn)
            with pytest.raises(Exception, match="killed"):
                follow(spark, feed, root, checkpoint)
    follow(spark, feed, root, checkpoint)
    assert dict(current(spark, root))[1] == "a"
    assert sync_log(spark, root).count() == 2


def test_stream_that_keeps_polling(spark, streamed):
    feed, root, checkpoint = streamed
    page(spark, feed, (1, "U", 1, "a"))
    query = stream_changelog(read_feed_stream(spark, feed, changes(spark).schema, files_per_trigger=1), root,
                             checkpoint=checkpoint, every="1s")
    try:
        query.processAllAvailable()
        page(spark, feed, (2, "D", 1, ""))
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(current(spark, root)) == 9
    assert [r["current_seq"] for r in sync_log(spark, root).orderBy("version").collect()] == [0, 1, 2]


def test_stream_refuses_rows_that_come_late(spark, streamed):
    feed, root, checkpoint = streamed
    page(spark, feed, (5, "U", 1, "a"))
    follow(spark, feed, root, checkpoint)
    page(spark, feed, (4, "U", 3, "late"))
    with pytest.raises(Exception, match="arrived late"):
        follow(spark, feed, root, checkpoint)


def test_stream_needs_a_baseline(spark, tmp_path):
    feed = str(tmp_path / "feed")
    page(spark, feed, (1, "I", 1, "a"))
    with pytest.raises(Exception, match="no changelog baseline"):
        follow(spark, feed, str(tmp_path / "none"), str(tmp_path / "checkpoint"))


@pytest.mark.parametrize("text,interval", [
    ("30s", "30 seconds"), ("15m", "15 minutes"), (" 6H ", "6 hours"), ("1d", "1 days"),
    ("hourly", "1 hour"), ("Daily", "1 day"), ("weekly", "7 days")])
def test_polling_intervals(text, interval):
    assert polling_interval(text) == interval


@pytest.mark.parametrize("text", ["", "0s", "0", "5w", "-1h", "monthly"])
def test_bad_polling_intervals(text):
    with pytest.raises(ValueError):
        polling_interval(text)
