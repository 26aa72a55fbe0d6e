"""CSV files read in splits, against the values that were written."""

import random

import pytest

from statlake import read_table, write_table

SCHEMA = "id long, text string, other string, d double"


@pytest.fixture()
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed, files", [(1, 1), (2, 1), (3, 3)])
def test_awkward_values_in_many_splits(spark, tmp_path, rows, tiny_splits, seed, files):
    draw = random.Random(seed)
    text = lambda: draw.choice([None, "", " ", '"', '""', "\n", "a,b", 'say "hi"\nthere', "x" * 1500 + "\n" * 3 + '"' * 5,
                                "\r", "é\r\n𝒳", "\n\n\n", "plain", "'", "\\", '\\"'])
    df = spark.createDataFrame([(i, text(), text(), draw.choice([None, 1.5, -2e300])) for i in range(120)], SCHEMA)
    path = write_table(df.coalesce(files) if files == 1 else df.repartition(files), str(tmp_path / "t"), "csv")
    got = read_table(spark, path, "csv", schema=df.schema, split=True)
    assert spark.read.text(path).rdd.getNumPartitions() > 10
    assert rows(got) == rows(df) == rows(read_table(spark, path, "csv", schema=df.schema))


def test_header_empty_table_and_refusals(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "b", 2.0)], SCHEMA)
    path = write_table(df, str(tmp_path / "t"), "csv")
    with pytest.raises(Exception, match="does not name the columns"):
        read_table(spark, path, "csv", schema="id long, words string, other string, d double", split=True).collect()
    none = write_table(df.limit(0), str(tmp_path / "none"), "csv")
    assert read_table(spark, none, "csv", schema=df.schema, split=True).count() == 0
    with pytest.raises(ValueError, match="schema"):
        read_table(spark, path, "csv", split=True)


def test_the_query_writes_a_file_for_so_many_bytes(spark, tmp_path, rows, monkeypatch):
    from pyspark.sql import functions as F
    from statlake.plans import queries
    docs = spark.range(0, 400, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"), F.col("id").cast("int").alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    written = []
    write = queries.writers.write_table
    monkeypatch.setattr(queries.writers, "write_table", lambda df, path, *more: written.append(write(df, path, *more)) or path)
    got = rows(queries.sink_csv_split(spark, str(tmp_path)))
    monkeypatch.setattr(queries, "_CSV_FILE_BYTES", 8000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows(queries.sink_csv_split(spark, str(tmp_path))) == got == rows(queries._awkward_texts(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = [spark.read.text(p).select(F.input_file_name()).distinct().count() for p in written]
    assert files[0] == 1 and 2 <= files[1] <= 4
