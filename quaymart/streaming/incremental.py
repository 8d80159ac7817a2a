"""High-watermark loading as a file stream that runs until it has caught up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_new_files(spark: SparkSession, source: str, schema: T.StructType, target: str,
                   checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Append the files that arrived since the last run to the target table.

    The checkpoint remembers which files were read, so unlike a timestamp
    watermark nothing is lost that is late or shares the stored maximum, and a
    failed run resumes without duplicates. ``availableNow`` takes the backlog in
    bounded batches and then stops.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
    if transform:
        stream = transform(stream)
    job = (stream.writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def upsert_new_files(spark: SparkSession, source: str, schema: T.StructType, target: str,
                     checkpoint: str, key: str, at: str, partition_by: str | None = None,
                     ties: Sequence[str] = ()) -> DataFrame:
    """Upsert the files that arrived since the last run, the latest row per key.

    Latest is by ``at``, then by ``ties``, over the batch and the stored row, so
    a row that arrives late does not replace a newer one. Each micro-batch is
    one upsert; repeating a batch after a failure gives the same rows again.
    """
    from quaymart.operators.incremental import latest_per_key, read_keyed, upsert_table

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert_table(batch.sparkSession, target, latest_per_key(batch, key, at, *ties), key,
                         partition_by, order=[at, *ties])

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
    job = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    job.awaitTermination()
    return read_keyed(spark, target, schema)
