"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Smallest share of a table that is worth a task of its own, in bytes.
SHARE_BYTES = 256 * 1024
# Stored bytes of a table that one delivered file stands for, at most about.
DELIVERY_BYTES = 32 << 20


def _stored_bytes(spark: SparkSession, path: str) -> int:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(location).getLength()


def _split_bytes(spark: SparkSession) -> int:
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan of a Parquet table that keeps all cores busy.

    A table of less than one full split per core, often a single row group,
    would be one task; such a table, and no other, is dealt out to the cores.
    Filters and column selection still reach the scan.
    """
    scan = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    size = _stored_bytes(spark, path)
    if size >= cores * _split_bytes(spark):
        return scan
    shares = min(cores, -(-size // SHARE_BYTES))
    return scan.repartition(shares) if shares > 1 else scan


def deliveries(spark: SparkSession, path: str, least: int) -> int:
    """How many files a table is delivered in: ``least``, or as many times that as its size needs."""
    return least * max(1, -(-_stored_bytes(spark, path) // (least * DELIVERY_BYTES)))
