"""Change history: type-2 snapshots and queries over them."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymart.operators.filters import top_k
from quaymart.operators.incremental import commit_version, current_version

VALID_FROM, VALID_TO, UPDATED_AT = "dbt_valid_from", "dbt_valid_to", "dbt_updated_at"
VALIDITY = [VALID_FROM, VALID_TO, UPDATED_AT]


def first_snapshot(source: DataFrame, at: dt.datetime) -> DataFrame:
    """Every source row as an open version."""
    when = F.lit(at).cast("timestamp_ntz")
    return source.withColumns({VALID_FROM: when, VALID_TO: F.lit(None).cast("timestamp_ntz"),
                               UPDATED_AT: when})


def apply_snapshot(history: DataFrame, source: DataFrame, key: str, check: Sequence[str],
                   at: dt.datetime) -> DataFrame:
    """History after seeing ``source`` at time ``at``.

    A key whose checked columns differ (NULL equals NULL) closes its open
    version and gets a new one; a new key gets one; a key missing from the
    source stays open. Closed versions pass through without a shuffle. One
    full outer join on the key yields zero to two rows per key.
    """
    columns = [c for c in history.columns if c not in VALIDITY]
    when = F.lit(at).cast("timestamp_ntz")
    closed = history.where(F.col(VALID_TO).isNotNull())
    open_rows = history.where(F.col(VALID_TO).isNull()).select(
        F.col(key).alias("__old_key"), F.struct(*columns, *VALIDITY).alias("old"))
    seen = source.select(F.col(key).alias("__new_key"), F.struct(*columns).alias("new"))
    both = open_rows.join(seen, F.col("__old_key") == F.col("__new_key"), "full_outer")
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))

    def old(valid_to, updated):
        return F.struct(*[F.col(f"old.{c}").alias(c) for c in columns],
                        F.col(f"old.{VALID_FROM}").alias(VALID_FROM),
                        valid_to.alias(VALID_TO), updated.alias(UPDATED_AT))

    fresh = F.struct(*[F.col(f"new.{c}").alias(c) for c in columns], when.alias(VALID_FROM),
                     F.lit(None).cast("timestamp_ntz").alias(VALID_TO), when.alias(UPDATED_AT))
    kept = old(F.col(f"old.{VALID_TO}"), F.col(f"old.{UPDATED_AT}"))
    versions = (F.when(F.col("__old_key").isNull(), F.array(fresh))
                .when(F.col("__new_key").isNull() | same, F.array(kept))
                .otherwise(F.array(old(when, when), fresh)))
    current = both.select(F.explode(versions).alias("v")).select("v.*")
    return closed.select(*columns, *VALIDITY).unionByName(current)


def row_hash(columns: Sequence[str]) -> Column:
    """One hash of the checked columns, as 32 bytes; NULL differs from every value."""
    marked = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.unhex(F.sha2(F.to_json(F.array(*marked)).cast("binary"), 256))


class SnapshotStore:
    """A type-2 table that only grows: no visit writes a stored row again.

        <path>/visit-<id>/started    versions that began at a visit, whole rows with their hash
        <path>/visit-<id>/ended      key and start of the versions that ended at it
        <path>/pointer-<n>.json      the visits so far, version n

    A version is open until some visit lists it as ended. A visit compares the
    source with the hashes of the open versions: key, start and hash are read of
    them, no other column, and what it writes is what has changed. As with keyed
    tables the pointer comes last, so a visit that dies leaves nothing visible,
    and of two writers one fails.

    A key whose checked columns differ ends its open version and starts one; a
    new key starts one; a key that is missing from the source stays open. The
    source has one row per key; NULL is a key like any other. Visits go forward
    in time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, check: Sequence[str]):
        self.spark, self.path, self.key, self.check = spark, path, key, list(check)

    def _state(self) -> dict:
        return current_version(self.spark, self.path) or {"version": 0, "visits": [], "schema": None, "last": None}

    def _started(self, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{v}/started" for v in state["visits"]])

    def _ended(self, state: dict) -> DataFrame:
        fields = T.StructType.fromJson(state["schema"])
        kinds = T.StructType([T.StructField("__ended_key", fields[self.key].dataType), T.StructField("__ended_from", T.TimestampNTZType()),
                              T.StructField(VALID_TO, T.TimestampNTZType())])
        return self.spark.read.schema(kinds).parquet(*[f"{v}/ended" for v in state["visits"]])

    def _same_version(self) -> Column:
        return F.col(self.key).eqNullSafe(F.col("__ended_key")) & (F.col(VALID_FROM) == F.col("__ended_from"))

    def visit(self, source: DataFrame, at: dt.datetime) -> str:
        """Record what the source looks like at a time; the folder of the visit."""
        state = self._state()
        if state["last"] is not None and at.isoformat() <= state["last"]:
            raise ValueError(f"the last visit was at {state['last']}, this one is at {at.isoformat()}")
        folder = f"{self.path}/visit-{uuid.uuid4().hex}"
        hashed = row_hash(self.check)
        if state["version"] and T.StructType.fromJson(state["schema"])["__hash"].dataType == T.StringType():
            hashed = F.lower(F.hex(hashed))             # a store that began with hashes as text keeps them
        seen = source.withColumn("__hash", hashed)
        when = F.lit(at).cast("timestamp_ntz")
        if state["version"]:
            open_ = self._started(state).select(self.key, VALID_FROM, "__hash").join(self._ended(state), self._same_version(), "left_anti")
            open_ = open_.select(F.col(self.key).alias("__key"), F.col(VALID_FROM).alias("__from"), F.col("__hash").alias("__was"))
            known = F.col(self.key).eqNullSafe(F.col("__key"))
            changed = seen.join(open_, known & (F.col("__hash") != F.col("__was")))
            ended = changed.select(F.col(self.key).alias("__ended_key"), F.col("__from").alias("__ended_from"), when.alias(VALID_TO))
            fresh = seen.join(open_, known & (F.col("__hash") == F.col("__was")), "left_anti")
        else:
            fresh = seen
            ended = seen.limit(0).select(F.col(self.key).alias("__ended_key"), when.alias("__ended_from"), when.alias(VALID_TO))
        started = fresh.withColumn(VALID_FROM, when)
        started.write.parquet(f"{folder}/started")
        ended.write.parquet(f"{folder}/ended")
        schema = json.loads(started.schema.json())
        commit_version(self.spark, self.path, {"version": state["version"] + 1, "visits": [*state["visits"], folder],
                                               "schema": schema, "last": at.isoformat()})
        return folder

    def history(self) -> DataFrame:
        """All versions with their validity, as ``apply_snapshot`` has them."""
        state = self._state()
        if not state["version"]:
            raise FileNotFoundError(f"no visit at {self.path}")
        versions = self._started(state).drop("__hash").join(self._ended(state), self._same_version(), "left")
        versions = versions.withColumn(UPDATED_AT, F.coalesce(VALID_TO, VALID_FROM))
        return versions.drop("__ended_key", "__ended_from")


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


def recent_current(history: DataFrame, key: str, n: int = 10) -> DataFrame:
    return top_k(current_versions(history), n, F.col(VALID_FROM).desc_nulls_first(), key)


def changed_keys(history: DataFrame, key: str) -> DataFrame:
    """All versions of keys that have more than one."""
    many = history.groupBy(key).agg(F.count(F.lit(1)).alias("version_count")).where(
        F.col("version_count") > 1)
    return history.join(many.select(key), key, "left_semi")


def snapshot_summary(history: DataFrame, key: str) -> DataFrame:
    """Total, current and historical rows and distinct keys, folded per key first."""
    per_key = history.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(VALID_TO).isNull()).alias("open"))
    return per_key.agg(
        F.sum("n").alias("total_rows"), F.sum("open").alias("current_rows"),
        (F.sum("n") - F.sum("open")).alias("historical_rows"), F.count(key).alias("unique_orders"))
