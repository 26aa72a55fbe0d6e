"""One large CSV file read by many tasks, though its values may hold line breaks.

A file is read line by line in splits.  Whether a line begins a record depends on the number of quotes before it: it does if that is
even (a quote inside a value is written twice).  The parity is a prefix sum, first inside each split, then over the splits of a file, of
which only one row each is looked at.  Lines that are records by themselves stay where they are; the others are put together by record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .formats import CSV_READ, empty_texts

_FROM_CSV = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_READ.items() if k not in ("header", "multiLine")}


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``record`` (its text) and ``first`` (whether it is the file's first) of all records; blank lines are none."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value")
    odd = ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).cast("int")
    # Windows over the lines of one split, which the session's split size bounds.
    inside = Window.partitionBy("file", "split").orderBy("at")
    before = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("odd", odd).withColumn("open", before)
    lines = lines.withColumn("if_even", F.sum(1 - F.col("open")).over(inside)).withColumn("if_odd", F.sum("open").over(inside))

    # One row per split: is a record open where it begins, and which record is it?
    splits = lines.groupBy("file", "split").agg((F.sum("odd") % 2).alias("odd"), F.max("if_even").alias("if_even"), F.max("if_odd").alias("if_odd"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("entered", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("entered") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    last = F.when(begun > 0, F.struct(F.col("split").alias("split"), begun.alias("number")))
    splits = splits.select("file", "split", "entered", F.last(last, ignorenulls=True).over(earlier).alias("held"))

    placed = lines.join(splits, ["file", "split"])
    number = F.when(F.col("entered") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    begins = F.col("open") == F.col("entered")
    own = F.struct("split", number.alias("number"))
    placed = placed.select("file", "split", "at", "value", F.when(number > 0, own).otherwise(F.col("held")).alias("of"),
                           (begins & (F.col("odd") == 0)).alias("alone"))
    whole = placed.filter("alone").select("file", F.col("value").alias("record"), "of")
    parts = (placed.filter("NOT alone").groupBy("file", "of")
             .agg(F.sort_array(F.collect_list(F.struct("split", "at", "value"))).alias("lines"))
             .select("file", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"), "of"))
    first = (F.col("of.split") == 0) & (F.col("of.number") == 1)
    return whole.filter(F.col("record") != "").unionByName(parts).select("file", "record", first.alias("first"))


def read_split_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """The rows of CSV files with a header, as ``read_table`` gives them; a header with other names is an error.

    Not for compressed files, which one task has to read in any case.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = T.StructType([T.StructField(f"_{at}", T.StringType()) for at in range(len(schema.fields))])
    found = records(spark, path)
    header = F.from_csv("record", F.lit(names.simpleString()[7:-1].replace(":", " ")), _FROM_CSV)
    same = F.array(*[header[f.name] for f in names.fields]) == F.array(*[F.lit(f.name) for f in schema.fields])
    wrong = F.raise_error(F.concat(F.lit("the header of "), "file", F.lit(" does not name the columns of the schema: "), "record"))
    rows = found.filter(F.when(F.col("first"), F.when(F.coalesce(same, F.lit(False)), F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(True))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return empty_texts(rows.select(F.from_csv("record", F.lit(ddl), _FROM_CSV).alias("r")).select("r.*"))
