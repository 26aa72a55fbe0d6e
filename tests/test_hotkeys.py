"""Keys with a large share of the rows, against plain counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from statlake import hot_keys


@pytest.mark.parametrize("share", [0.001, 0.01, 0.2, 1])
def test_every_key_above_the_share_and_no_other(spark, share):
    draw = random.Random(4)
    rows = [(draw.choice([None, 1, 1, 1, int(draw.expovariate(.01))]), draw.choice([None, "a", "b"])) for _ in range(20_000)]
    got = hot_keys(spark.createDataFrame(rows, "id long, part string").repartition(7), ["id", "part"], share).collect()
    want = {k: n for k, n in Counter(rows).items() if n >= share * len(rows)}
    assert {(r["id"], r["part"]): r["copies"] for r in got} == want
    assert all(r["share"] == pytest.approx(r["copies"] / 20_000) for r in got)


def test_a_hot_key_among_many_rare_ones(spark):
    df = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    assert [(r["id"], r["copies"]) for r in hot_keys(df, ["id"], 0.005).collect()] == [(-1, 100_000)]


def test_nothing_hot(spark):
    assert hot_keys(spark.range(0), ["id"]).count() == 0
    assert hot_keys(spark.range(1000), ["id"], 0.01).count() == 0
    with pytest.raises(ValueError):
        hot_keys(spark.range(5), ["id"], 0)
