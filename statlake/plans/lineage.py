"""Scratch space and cutting lineage through written tables.

Intermediate tables go to the shared folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting (tests,
a laptop) gets a temporary folder of its own; a cluster without it is an error,
because a folder on one machine is not readable from the others.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="statlake-")
        root = _local_roots[context.applicationId]
    return f"{root.rstrip('/')}/statlake/{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote there; DataFrames that read it stop working."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once and go on from the written table.

    What was written does not change when an executor is lost, so values that
    depend on row placement stay put, and later stages prune columns from Parquet.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
