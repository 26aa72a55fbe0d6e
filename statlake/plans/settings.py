"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Skewed joins are split and rebalanced writes are sized at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Timestamps with statistics, so a date range skips row groups; the default form has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session.

    ``spark.sql.shuffle.partitions`` is left to the cluster: about the bytes shuffled by the
    largest stage divided by 200 MB; AQE merges what turns out too small.
    """
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark
