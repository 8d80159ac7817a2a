"""Session settings and the shared folder used to cut lineage or write tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on. ANSI stays on: a bad cast or an
# overflowing sum fails the job instead of turning into NULL.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_SCRATCH: list[str] = []
_STORED: dict[tuple[str, str], DataFrame] = {}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on a session that already exists."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "quaymart", cpus: int | None = None, **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    cpus = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture costs a stack walk for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "quaymart-warehouse"))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine only, so an unset option is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    fallback = tempfile.mkdtemp(prefix="quaymart-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from there.

    Used where two branches of a plan must see the very same rows in the very
    same place, and where computing the input again would cost more than
    writing it. The table survives the loss of any executor, is read column by
    column, and tells the planner its true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, name: str, build: Callable[[], DataFrame],
           partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
           write: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """A table built at its first use in this session and only read from then on.

    For lookups: the table holds what its sources held at that time. Rows are
    dealt to files and sorted in them so that a filter skips folders or row groups,
    unless ``write`` does it another way.
    """
    key = (spark.sparkContext.applicationId, name)
    if key not in _STORED:
        df, path = build(), scratch_path(spark, "stored")
        if write is not None:
            _STORED[key] = write(df, path)
            return _STORED[key]
        near = [*partition_by, *sort_by]
        if near:
            df = df.repartitionByRange(*near).sortWithinPartitions(*near)
        df.write.partitionBy(*partition_by).parquet(path)
        _STORED[key] = spark.read.parquet(path)
    return _STORED[key]


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process made; frames built on them are void."""
    _STORED.clear()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        done += path.getFileSystem(conf).delete(path, True)
    return done
