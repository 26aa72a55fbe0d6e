"""Rows at a sequence number, against a replay of the feed."""

import random

import pytest
from pyspark.sql import functions as F

from statlake import rows_at

FEED = "_seq long, _op string, _committed_at string, _snapshot_id string, id long, part string, v int"


def replay(feed, key, at):
    if at is None:
        return None, None
    last = None
    for seq, op, _, _, *rest in sorted((f for f in feed if f[0] is not None), key=lambda f: f[0]):
        if seq <= at and tuple(rest[:2]) == key:
            last = None if op == "D" else (seq, rest[2])
    return last or (None, None)


@pytest.mark.parametrize("block", [1, 7, 100, 1 << 20])
def test_against_a_replay(spark, block):
    draw = random.Random(block)
    feed = [(s, draw.choice("IUUD"), "t", "s", draw.choice([None, 1, 1, 1, 2, 3]), draw.choice([None, "a"]), draw.choice([None, s]))
            for s in draw.sample(range(-20, 400), 200)] + [(None, "I", "t", "s", 1, "a", 77)]
    asked = [(draw.choice([None, 1, 2, 3, 4]), draw.choice([None, "a"]), draw.choice([None, *range(-30, 420, 7)]), f"q{i}") for i in range(150)]
    asked += asked[:5] + [(1, "a", 10**12, "late"), (1, "a", -10**12, "early")]
    got = rows_at(spark.createDataFrame(feed, FEED).repartition(3), spark.createDataFrame(asked, "id long, part string, at long, name string"),
                  ["id", "part"], block=block)
    assert got.columns == ["id", "part", "at", "name", "_seq", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((*q, *replay(feed, q[:2], q[2])) for q in asked), key=repr)


def test_a_hot_key_stays_in_blocks(spark):
    """No window sees more rows of one key than a block has numbers, or than there are blocks."""
    feed = spark.range(1, 30_001).select(F.col("id").alias("_seq"), F.lit("U").alias("_op"), F.lit("t").alias("_committed_at"),
                                         F.lit("s").alias("_snapshot_id"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("id"),
                                         F.col("id").alias("v"))
    asked = spark.range(0, 30_000, 1000).select(F.lit(0).cast("long").alias("id"), F.col("id").alias("at"))
    got = {r["at"]: r["v"] for r in rows_at(feed, asked, ["id"], block=100).collect()}
    assert got == {at: (at if at % 3 else at - 1) if at else None for at in range(0, 30_000, 1000)}
    plan = rows_at(feed, asked, ["id"], block=100)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "__block" in plan


def test_refusals_and_empty_inputs(spark):
    feed = spark.createDataFrame([(1, "I", "t", "s", 1, "a", 5)], FEED)
    asked = spark.createDataFrame([(1, "a", 1)], "id long, part string, at long")
    assert rows_at(feed.limit(0), asked, ["id", "part"]).collect()[0]["v"] is None
    assert rows_at(feed, asked.limit(0), ["id", "part"]).count() == 0
    with pytest.raises(ValueError, match="share"):
        rows_at(feed, asked.withColumn("V", F.lit(1)), ["id", "part"])
    with pytest.raises(TypeError):
        rows_at(feed, asked.withColumn("id", F.col("id").cast("string")), ["id", "part"])
