"""Trees of digests: differences found, and how much is read to find them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statlake import diff_stored, same_stored, write_digested
from statlake.operators import digesttree

SCHEMA = "id long, part string, v double"


def stored(spark, tmp_path, name, rows, **options):
    path = str(tmp_path / name)
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA)
    write_digested(df, path, ["id", "part"], **options)
    return path


def plain_diff(old, new):
    old, new = Counter(map(repr, old)), Counter(map(repr, new))
    return Counter({("D", r): n for r, n in (old - new).items()}) + Counter({("I", r): n for r, n in (new - old).items()})


def got_diff(spark, old, new):
    return Counter((r["_op"], repr((r["id"], r["part"], r["v"]))) for r in diff_stored(spark, old, new).collect())


@pytest.mark.parametrize("seed, bits", [(1, 4), (2, 8), (3, 16)])
def test_random_changes_with_nulls_and_copies(spark, tmp_path, seed, bits):
    draw = random.Random(seed)
    row = lambda: (draw.choice([None, *range(40)]), draw.choice([None, "", "a", "b"]), draw.choice([None, 0.0, 1.5, float("nan")]))
    old = [row() for _ in range(300)]
    new = [r for r in old if draw.random() > .05] + [row() for _ in range(10)] + old[:3]
    a, b = (stored(spark, tmp_path, n, r, bits=bits) for n, r in (("a", old), ("b", new)))
    assert got_diff(spark, a, b) == plain_diff(old, new)
    assert not same_stored(spark, a, b)


def test_equal_tables_empty_tables_and_swapped_copies(spark, tmp_path):
    rows = [(i, "x", float(i)) for i in range(50)]
    a, b = stored(spark, tmp_path, "a", rows), stored(spark, tmp_path, "b", rows[::-1])
    assert same_stored(spark, a, b) and diff_stored(spark, a, b).count() == 0
    none = stored(spark, tmp_path, "none", [])
    assert Counter(r["_op"] for r in diff_stored(spark, a, none).collect()) == {"D": 50}
    assert Counter(r["_op"] for r in diff_stored(spark, none, a).collect()) == {"I": 50}
    twice = [(1, "x", 1.0)] * 2 + [(1, "x", 2.0)] * 2
    other = [(1, "x", 3.0)] * 4  # pairs of equal rows would cancel out under exclusive or
    assert got_diff(spark, stored(spark, tmp_path, "c", twice), stored(spark, tmp_path, "d", other)) == plain_diff(twice, other)


def test_tables_of_other_shape_are_refused(spark, tmp_path):
    a, b = stored(spark, tmp_path, "a", [(1, "x", 1.0)], bits=8), stored(spark, tmp_path, "b", [(2, "x", 1.0)], bits=16)
    with pytest.raises(ValueError, match="different numbers of bits"):
        diff_stored(spark, a, b)
    with pytest.raises(ValueError, match="multiple"):
        write_digested(spark.createDataFrame([(1, "x", 1.0)], SCHEMA), str(tmp_path / "z"), ["id"], bits=7)


def _rows_scanned(df):
    """Rows that the scans of an executed plan gave."""
    found, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if "AdaptiveSparkPlanExec" in node.getClass().getName():
            waiting.append(node.executedPlan())
            continue
        if "QueryStageExec" in node.getClass().getName():
            waiting.append(node.plan())
            continue
        if "FileSourceScanExec" in node.getClass().getName():
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_reads_about_the_share_that_changed(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 100_000, 1, 8).select("id", F.lit("x").alias("part"), (F.col("id") / 3).alias("v"))
        changed = rows.withColumn("v", F.when(F.col("id").isin(77, 50_001, 99_000), -1.0).otherwise(F.col("v")))
        a, b = stored(spark, tmp_path, "a", rows), stored(spark, tmp_path, "b", changed)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    leaves, ranges = digesttree.changed_leaves(spark, a, b)
    assert leaves.count() == 3 and len(ranges) == 3
    old, new = digesttree.changed_rows(spark, a, b)
    for part in (old, new):
        assert part._jdf.queryExecution().executedPlan().toString().count("GreaterThanOrEqual(__leaf") >= 1
        got = part.select("id", "v")
        assert {r["id"] for r in got.collect()} >= {77, 50_001, 99_000}
        # Three changed rows lie in at most three of 64 files.
        assert _rows_scanned(got) <= 100_000 * 4 / 64
    assert diff_stored(spark, a, b).count() == 6
