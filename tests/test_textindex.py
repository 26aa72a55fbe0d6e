"""Trigram postings: the rows of a plain search, and how much is read."""

import random

import pytest
from pyspark.sql import functions as F

from statlake import add_rows, search_index, search_rows
from statlake.operators import textindex

SCHEMA = "id long, name string, note string"
LOOK = {"columns": ("name",), "long_columns": ("note",), "aliases": {}, "name_only": ()}


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    """Rows in two batches of several tasks, with nulls, empty and long texts, letters outside ASCII and equal rows."""
    draw, path = random.Random(3), str(tmp_path_factory.mktemp("index") / "i")
    text = lambda: "".join(draw.choice("abÄéB z\n𝒳%_") for _ in range(draw.choice([0, 2, 5, 40])))
    rows = [(i, draw.choice([None, text()]), draw.choice([None, text()])) for i in range(400)]
    rows += [(900, "tail", "x" * 70_000 + " Needle " + "y" * 10), (901, "abc", "bca"), (902, None, None)] + rows[:5]
    df = spark.createDataFrame(rows, SCHEMA)
    add_rows(df.filter("id % 3 = 0").repartition(3), path, ["name", "note"])
    add_rows(df.filter("id % 3 <> 0").repartition(2), path, ["name", "note"])
    return df, path


@pytest.mark.parametrize("query", ["ab", "aba", "ÄÉB", " z\n", "𝒳%_", "needle", "bca", "abcbca", "c\x00b", "nowhere", "", None, "z", "B Z"])
def test_same_rows_as_a_plain_search(spark, indexed, rows, query):
    df, path = indexed
    assert rows(search_index(spark, path, query, **LOOK)) == rows(search_rows(df, query, **LOOK))


def test_aliases_and_short_needles(spark, indexed, rows):
    df, path = indexed
    look = LOOK | {"aliases": {"two": ("aba", "needle"), "short": ("needle", "z")}, "name_only": ("two",)}
    for query in ("two", "short"):
        assert rows(search_index(spark, path, query, **look)) == rows(search_rows(df, query, **look))


def test_candidates_hold_all_trigrams(spark, indexed):
    df, path = indexed
    found = textindex.candidates(spark, path, ["needle"]).collect()
    assert len(found) == len(set(found)) == 1
    numbers = textindex._rows(spark, path).select(textindex.ROW).collect()
    assert len(numbers) == len(set(numbers)) == df.count()


def test_only_needed_postings_and_chunks_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "CHUNK_BITS", 7)
    path = str(tmp_path / "i")
    df = spark.range(0, 4000, 1, 4).select("id", F.concat(F.lit("item "), F.md5(F.col("id").cast("string"))).alias("name"))
    add_rows(df, path, ["name"])
    found = search_index(spark, path, df.filter("id = 1234").first()["name"], **LOOK)
    assert [r["id"] for r in found.collect()] == [1234]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [" in plan and "dynamicpruning" in plan.lower()
    # Rows read from the table of rows: those of one chunk of 128, not all 4,000.
    waiting, read = [found._jdf.queryExecution().executedPlan()], []
    while waiting:
        node = waiting.pop()
        name = node.getClass().getName()
        if "AdaptiveSparkPlanExec" in name:
            waiting.append(node.executedPlan())
        elif "QueryStageExec" in name:
            waiting.append(node.plan())
        else:
            if "FileSourceScanExec" in name and "__chunk" in node.toString():
                read.append(node.metrics().apply("numOutputRows").value())
            waiting += [node.children().apply(i) for i in range(node.children().size())]
    assert read == [128]
    added = df.limit(1).select(F.lit(9999).cast("long").alias("id"), F.lit("late item").alias("name"))
    before = {f for f in spark.read.parquet(f"{path}/postings").inputFiles()}
    add_rows(added, path, ["name"])
    assert before < set(spark.read.parquet(f"{path}/postings").inputFiles())
    assert [r["id"] for r in search_index(spark, path, "LATE item", **LOOK).collect()] == [9999]
