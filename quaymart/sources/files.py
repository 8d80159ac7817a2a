"""Sinks and file formats: one writer with modes, CSV, JSON metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, mode: str = "replace",
                partition_by: str | None = None, key: str | None = None) -> DataFrame:
    """Write parquet and return the table as read back from storage.

    ``replace`` drops the old rows, ``append`` adds, ``upsert`` replaces rows by
    ``key``. Counting the returned frame verifies what was really written.
    """
    spark = df.sparkSession
    if mode == "upsert":
        from quaymart.operators.incremental import upsert_table

        if key is None:
            raise ValueError("mode 'upsert' needs key=")
        return upsert_table(spark, path, df, key, partition_by)
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown load mode {mode!r}")
    writer = df.write.mode("overwrite" if mode == "replace" else "append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV as a folder of parts, one per partition (no single-file funnel)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a declared schema; a row that does not fit fails the job."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .schema(schema).csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hadoop).exists(p)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The entries of a folder; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []


def load_csv_tables(spark: SparkSession, files: Mapping[str, str], schemas: Mapping[str, T.StructType],
                    target: str) -> dict[str, DataFrame]:
    """Bulk load: file path per table name; absent files are skipped."""
    loaded = {}
    for name, path in files.items():
        if path_exists(spark, path):
            loaded[name] = write_table(read_csv(spark, path, schemas[name]), f"{target}/{name}")
    return loaded


def write_json_row(spark: SparkSession, path: str, values: Mapping, schema: T.StructType) -> DataFrame:
    """One metadata record (model features, row count, time) as JSON."""
    row = tuple(values[f.name] for f in schema.fields)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(schema).json(path)


def write_month_partitions(df: DataFrame, path: str, ts: str, month: str = "purchase_month") -> DataFrame:
    """Table partitioned by month of ``ts``.

    The rebalance groups rows by month and lets the adaptive planner split a
    month that is too big for one task and merge small ones.
    """
    from quaymart.functions import month_start

    spark = df.sparkSession
    tagged = df.withColumn(month, month_start(ts))
    (tagged.hint("rebalance", F.col(month)).write.mode("overwrite")
     .partitionBy(month).parquet(path))
    return spark.read.parquet(path)
