"""Watermark reads and upserts into parquet tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymart.session import scratch_path

# Watermark of an empty target, by kind of load.
EPOCH = dt.datetime(1900, 1, 1)
FIRST_RUN = dt.datetime(2000, 1, 1)


def watermark(target: DataFrame | None, col: str, empty: dt.datetime = EPOCH) -> dt.datetime:
    """Largest loaded value, one row brought to the driver."""
    if target is None:
        return empty
    return target.agg(F.max(col)).first()[0] or empty


def newer_than(source: DataFrame, col: str, mark: dt.datetime, lookback_days: int = 0) -> DataFrame:
    """Rows above the watermark. The bound is a literal, so it reaches the scan.

    The comparison is strict: rows that share the stored maximum, or arrive
    late, are lost unless ``lookback_days`` reads them again (an upsert by key
    makes that harmless).
    """
    bound = mark - dt.timedelta(days=lookback_days)
    return source.where(F.col(col) > F.lit(bound).cast("timestamp_ntz"))


def sync_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with the columns of ``new``: added ones NULL, dropped ones gone."""
    have = set(old.columns)
    return old.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in new.schema.fields])


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch replace rows of the target with the same key; NULL is a key like any other."""
    kept = target.join(batch.select(F.col(key).alias("__key")), F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    return sync_columns(kept, batch).unionByName(batch)


# A keyed table is a folder with data folders and pointers:
#
#   <path>/data-<id>/__part=<hash>/*.parquet    rows of one partition as one upsert wrote them
#   <path>/pointer-<n>.json                     schema, and the data folder and value of each partition, version n
#
# A pointer is written after its data, under a name that must not exist yet; readers take the
# largest n. So a run that dies leaves the version before it, and of two writers one fails.
# Partition folders are named by a hash, and the value itself stays in the files: nothing is
# inferred from names, and NULL or slashes in a value are no special case.
BUCKETS = 32
_PART, _VALUE = "__part", "__value"


def _jvm_fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _jvm_fs(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def current_version(spark: SparkSession, path: str) -> dict | None:
    """What the newest pointer of a folder says; None if there is none."""
    found = [p for p in _listed(spark, path) if "/pointer-" in p]
    if not found:
        return None
    last = max(found, key=lambda p: int(p.rsplit("-", 1)[1].removesuffix(".json")))
    fs, hadoop = _jvm_fs(spark, last)
    stream = fs.open(hadoop)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def commit_version(spark: SparkSession, path: str, state: dict) -> None:
    """Make a version current. Fails if another writer has made the same version."""
    fs, hadoop = _jvm_fs(spark, f"{path}/pointer-{state['version']}.json")
    out = fs.create(hadoop, False)
    try:
        out.write(bytearray(json.dumps(state).encode()))
    finally:
        out.close()


def _plain(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a parquet table that was never upserted; data of a run that died is none."""
    entries = _listed(spark, path)
    return bool(entries) and not any("/data-" in e for e in entries)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | None = None, since: str | None = None) -> DataFrame:
    """The current rows of a keyed table, with its stored schema or a newer one.

    With ``since`` only partitions whose value, as text, is not below it are opened.
    """
    state = current_version(spark, path)
    if state is None:
        if not _plain(spark, path):
            raise FileNotFoundError(f"no table at {path}")
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    parts = [p for p, v in state["values"].items() if since is None or (v is not None and v >= since)]
    return _rows(spark, state, schema or T.StructType.fromJson(state["schema"]), parts)


def stored_mark(spark: SparkSession, path: str, at: str):
    """The largest stored value of ``at``; None for an empty or absent table.

    ``at`` must not decrease from one partition value to the next (the month of a
    time, say): only the last partition that has a value is read.
    """
    state = current_version(spark, path)
    if state is None:
        return None
    for value, part in sorted(((v, p) for p, v in state["values"].items() if v is not None), reverse=True):
        mark = _rows(spark, state, T.StructType.fromJson(state["schema"]), [part]).agg(F.max(at)).first()[0]
        if mark is not None:
            return mark
    return None


def _rows(spark: SparkSession, state: dict, schema: T.StructType, parts) -> DataFrame:
    folders = [state["parts"][p] for p in parts if p in state["parts"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _part_of(key: str, partition_by: str | None) -> tuple[Column, Column]:
    """The name of a row's partition, and its value as text."""
    if partition_by is None:
        bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string")
        return bucket, bucket
    text = F.col(partition_by).cast("string")
    return F.sha2(F.coalesce(F.concat(F.lit("v"), text), F.lit("null")).cast("binary"), 256), text


def _write_parts(spark: SparkSession, rows: DataFrame, path: str, key: str,
                 partition_by: str | None) -> dict[str, str]:
    """Write rows to a new data folder; its partition folders."""
    root = f"{path}/data-{uuid.uuid4().hex}"
    name, _ = _part_of(key, partition_by)
    (rows.withColumn(_PART, name).hint("rebalance", F.col(_PART))
     .write.partitionBy(_PART).parquet(root))
    mark = f"/{_PART}="
    return {p.rsplit(mark, 1)[1]: p for p in _listed(spark, root) if mark in p}


def _values(rows: DataFrame, key: str, partition_by: str | None) -> dict[str, str | None]:
    """Name and value of each partition of some rows: one entry per partition, as any file listing has."""
    name, value = _part_of(key, partition_by)
    return {r[0]: r[1] for r in rows.select(name.alias(_PART), value.alias(_VALUE)).distinct().collect()}


def _refuse_repeated(rows: DataFrame, key: str) -> None:
    """NULL is a key like any other, so it may come once, too."""
    again = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).first()
    if again is not None:
        raise ValueError(f"the batch has {again['n']} rows with {key} = {again[0]}; give an order, or fold them first")


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: str,
                 partition_by: str | None = None, order: Sequence[str] = (), fixed: bool = False) -> DataFrame:
    """Upsert into a keyed table; returns its rows with the batch's columns.

    With ``order`` (columns, most significant first) the largest of the stored and
    the new rows of a key stays, so late rows cannot replace newer ones; without
    it the batch wins and must hold one row per key, else it is refused. NULL is a
    key like any other. Only partitions that receive or lose rows are written
    again; the others keep their folders. Without ``partition_by`` rows are dealt
    to ``BUCKETS`` by the hash of the key, and only buckets with keys of the batch
    are read. With it, the key column of all partitions is read to find rows that
    move, unless ``fixed`` says that a key never changes its partition: then only
    partitions of the batch are opened. The driver handles one entry per partition
    folder, as any file listing does.
    """
    schema = batch.schema
    state = current_version(spark, path)
    if state is None:
        if not order and not _plain(spark, path):
            return _first_upsert(spark, path, batch, key, partition_by)
        state = {"version": 0, "by": [key, partition_by], "parts": {}, "values": {}, "schema": json.loads(schema.json())}
    if state["by"] != [key, partition_by]:
        raise ValueError(f"{path} is kept by {state['by']}, not by {[key, partition_by]}")
    aside = scratch_path(spark, "upsert")
    batch.write.parquet(aside)
    batch = spark.read.schema(schema).parquet(aside)
    if not order:
        _refuse_repeated(batch, key)
    touched = _values(batch, key, partition_by)
    if not state["version"] and _plain(spark, path):
        old = spark.read.parquet(path)
        touched |= _values(old, key, partition_by)
    else:
        stored = T.StructType.fromJson(state["schema"])
        if partition_by is not None and not fixed:
            target = _rows(spark, state, stored, state["parts"])
            touched |= _values(target.join(batch.select(F.col(key).alias("__key")), F.col(key).eqNullSafe(F.col("__key")), "left_semi"),
                               key, partition_by)
        old = _rows(spark, state, stored, sorted(touched))
    fresh = _write_parts(spark, _merged(sync_columns(old, batch), batch, key, order), path, key, partition_by)
    kept = {p: folder for p, folder in state["parts"].items() if p not in touched}
    values = {p: v for p, v in (state["values"] | touched).items() if p in kept or p in fresh}
    commit_version(spark, path, {"version": state["version"] + 1, "parts": kept | fresh, "values": values, "by": [key, partition_by],
                          "schema": json.loads(schema.json())})
    return read_keyed(spark, path, schema)


def _first_upsert(spark: SparkSession, path: str, batch: DataFrame, key: str, partition_by: str | None) -> DataFrame:
    """The first version of a table: the batch is written once, checked as stored, and then made current."""
    schema = batch.schema
    state = {"version": 1, "parts": _write_parts(spark, batch, path, key, partition_by), "by": [key, partition_by],
             "schema": json.loads(schema.json())}
    rows = _rows(spark, state, schema, state["parts"])
    _refuse_repeated(rows, key)
    commit_version(spark, path, state | {"values": _values(rows, key, partition_by)})
    return read_keyed(spark, path, schema)


def _merged(old: DataFrame, batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Stored rows and a batch as one row per key."""
    if not order:
        return upsert(old, batch, key)
    return latest_per_key(old.unionByName(batch), key, *order)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete data folders and pointers that the current version does not use. No reader may be
    busy with an older version, and no writer with a newer one."""
    state = current_version(spark, path)
    if state is None:
        return 0
    used = {folder.rsplit(f"/{_PART}=", 1)[0] for folder in state["parts"].values()}
    gone = 0
    for entry in _listed(spark, path):
        stale = (entry not in used and "/data-" in entry) or (
            "/pointer-" in entry and not entry.endswith(f"/pointer-{state['version']}.json"))
        if stale:
            fs, hadoop = _jvm_fs(spark, entry)
            gone += fs.delete(hadoop, True)
    return gone


def latest_per_key(batch: DataFrame, key: str, at: Column | str, *ties: str) -> DataFrame:
    """One row per key, the latest by ``at``, then by ``ties``; an aggregate, so copies combine map-side."""
    at = F.col(at) if isinstance(at, str) else at
    rest = F.struct(*[F.col(c) for c in batch.columns])
    return batch.groupBy(key).agg(F.max_by(rest, F.struct(at.alias("at"), *ties)).alias("r")).select("r.*")
