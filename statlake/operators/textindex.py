"""Substring search through an index of character trigrams with bitmap postings.

An index holds the rows, each with a number, and for every three characters that follow each other in a row's lower-cased
texts a bitmap of the rows that have them, in buckets of 32,768 rows.  A text that contains a needle has all trigrams of the needle:
their bitmaps are intersected bucket by bucket, and what is left is read and searched.  Numbers follow the tasks that wrote the rows, so
nothing is sorted or counted before; rows lie in a directory per chunk of numbers, and a search reads only chunks with candidates.
New rows are added with numbers of their own and new postings; nothing that was written before is touched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.fixed_values import NAME_ONLY_ALIASES, SEARCH_ALIASES
from ..plans.sizing import broadcast_if_small, quoted
from .search import expand_terms, search_rows

GRAM = 3
CHUNK_BITS = 20  # rows of a chunk: about a million, all of one task
TASK_BITS = 33  # of a row's number: task above, position below
ROW, CHUNK = "__row", "__chunk"
_SEPARATOR = "\x00"  # between the texts of a row; a trigram across it is never asked for


def grams(text: Column) -> Column:
    """Different trigrams of a text, in one pass however long it is."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def grams_of(needle: str) -> list[str]:
    return sorted({needle[i:i + GRAM] for i in range(len(needle) - GRAM + 1)})


def add_rows(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Add rows to the index under ``path``, which is made if it is not there; ``columns`` are the texts to search."""
    spark = df.sparkSession
    first = _next_number(spark, path)
    numbered = df.withColumn(ROW, F.monotonically_increasing_id() + F.lit(first))
    batch = f"{path}/rows/__batch={first >> TASK_BITS}"
    numbered.withColumn(CHUNK, F.shiftright(ROW, CHUNK_BITS)).write.partitionBy(CHUNK).parquet(batch)
    rows = spark.read.schema(numbered.schema).parquet(batch)
    text = F.concat_ws(_SEPARATOR, *[F.lower(F.coalesce(F.col(quoted(c)).cast("string"), F.lit(""))) for c in columns])
    found = rows.select(ROW, F.explode(grams(text)).alias("gram"))
    place = F.col(ROW) + 1  # bitmaps count from one
    postings = (found.groupBy("gram", F.bitmap_bucket_number(place).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("rows")))
    postings.repartitionByRange("gram", "bucket").sortWithinPartitions("gram", "bucket").write.mode("append").parquet(f"{path}/postings")


def _next_number(spark: SparkSession, path: str) -> int:
    """A number above all in the index, at the beginning of a task's range."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0
    last = _rows(spark, path).agg(F.max(ROW)).first()[0]
    return 0 if last is None else ((last >> TASK_BITS) + 1) << TASK_BITS


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(f"{path}/rows")


def candidates(spark: SparkSession, path: str, needles: Sequence[str]) -> DataFrame:
    """Numbers of the rows that have all trigrams of one of the needles, none of which is shorter than a trigram."""
    postings = spark.read.parquet(f"{path}/postings")
    buckets = []
    for needle in needles:
        wanted = grams_of(needle)
        buckets.append(postings.filter(F.col("gram").isin(wanted)).groupBy("bucket")
                       .agg(F.bitmap_and_agg("rows").alias("rows"), F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") == len(wanted)).select("bucket", "rows"))
    either = reduce(DataFrame.unionByName, buckets)
    if len(buckets) > 1:  # a row is a candidate once, however many needles it may hold
        either = either.groupBy("bucket").agg(F.bitmap_or_agg("rows").alias("rows"))
    # Bytes that are not zero, then their bits, lowest first.
    each = either.filter(F.bitmap_count("rows") > 0).select("bucket", F.posexplode(F.regexp_extract_all(F.hex("rows"), F.lit("(..)"), F.lit(1))))
    bits = each.filter(F.col("col") != "00").select(
        "bucket", "pos", F.conv("col", 16, 10).cast("int").alias("byte"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    inside = bits.filter(F.expr("shiftright(byte, bit)").bitwiseAND(F.lit(1)) == 1)
    return inside.select(((F.col("bucket") - 1) * 32_768 + F.col("pos") * 8 + F.col("bit")).alias(ROW))


def search_index(
    spark: SparkSession,
    path: str,
    query: str | None,
    *,
    columns: Sequence[str] = ("name", "title"),
    long_columns: Sequence[str] = ("description",),
    aliases: Mapping[str, Sequence[str]] = SEARCH_ALIASES,
    name_only: Sequence[str] = NAME_ONLY_ALIASES,
) -> DataFrame:
    """The rows that ``search_rows`` finds in the indexed rows.

    The index has to cover the columns.  A needle of fewer than three characters has no trigram: all rows are searched then.
    """
    needles = expand_terms(query, aliases)
    rows = _rows(spark, path)
    if needles and all(len(n) >= GRAM for n in needles):
        found = candidates(spark, path, needles)
        found = broadcast_if_small(found.select(ROW, F.shiftright(ROW, CHUNK_BITS).cast(rows.schema[CHUNK].dataType).alias(CHUNK)))
        rows = rows.join(found, [CHUNK, ROW], "left_semi")
    return search_rows(rows, query, columns=columns, long_columns=long_columns, aliases=aliases,
                       name_only=name_only).drop(ROW, CHUNK, "__batch")
