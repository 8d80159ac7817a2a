"""Load jobs: extract, transform, load, export, with retry and an audit trail."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from decimal import Decimal
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymart.operators.incremental import stored_mark, upsert_table
from quaymart.sources.files import write_csv, write_table

log = logging.getLogger("quaymart.jobs")

AUDIT_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("rows_loaded", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("elapsed_s", T.DecimalType(8, 3)),
    T.StructField("error_message", T.StringType()),
    T.StructField("run_at", T.TimestampNTZType(), False),
])


@dataclass(frozen=True)
class Retry:
    """How often an attempt is made, and the wait before attempt n + 1: n times ``pause_s``."""

    attempts: int = 3
    pause_s: float = 2
    sleep: Callable[[float], None] = time.sleep

    def __post_init__(self) -> None:
        if self.attempts < 1:
            raise ValueError(f"at least one attempt is needed, not {self.attempts}")

    def waits(self) -> Iterator[float | None]:
        """The wait after each attempt; None after the last."""
        yield from (n * self.pause_s for n in range(1, self.attempts))
        yield None


@dataclass(frozen=True)
class Outcome:
    """What became of one run: how far it came, and what it left behind."""

    job: str
    source: str
    target: str
    status: str
    began: dt.datetime
    ended: dt.datetime
    tries: int = 1
    rows_in: int | None = None
    rows_out: int = 0
    export: str | None = None
    error: str | None = None

    @property
    def seconds(self) -> float:
        return (self.ended - self.began).total_seconds()

    def audit_row(self) -> tuple:
        took = Decimal(str(round(self.seconds, 3)))
        return (self.job, self.source, self.target, self.rows_out, self.status, took, self.error, self.ended)


class JobFailed(Exception):
    """All attempts failed; carries the outcome, which is in the audit trail by then."""

    def __init__(self, outcome: Outcome):
        super().__init__(f"{outcome.job} failed after {outcome.tries} attempts: {outcome.error}")
        self.outcome = outcome


class Job:
    """A load from one table to another. Subclasses say what to ``extract`` and how to ``transform``.

    Everything stays lazy up to ``load``, the one action. The count of rows
    read comes from an observed metric of that action (unknown where the
    planner proves the input empty), the count of rows written from the footers
    of the written table, so neither runs the plan again. The default load
    replaces its target, so a repeated attempt is safe. With ``audit_path``
    every run leaves its record, also one that fails.
    """

    source_table = ""
    target_table = ""

    def __init__(self, spark: SparkSession, target_path: str, retry: Retry | None = None,
                 audit_path: str | None = None):
        self.spark, self.target_path = spark, target_path
        self.retry, self.audit_path = retry or Retry(), audit_path

    def extract(self) -> DataFrame:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        return df

    def load(self, df: DataFrame) -> DataFrame:
        return write_table(df, self.target_path)

    def export_csv(self, loaded: DataFrame) -> str | None:
        """Export from the written table, so the plan does not run twice."""
        return write_csv(loaded, f"{self.target_path}_csv")

    def before(self) -> None:
        """Called once before the first attempt."""

    def after(self, outcome: Outcome) -> None:
        """Called once with the outcome, good or bad."""

    def _attempt(self) -> dict:
        seen = Observation()
        source = self.extract().observe(seen, F.count(F.lit(1)).alias("rows"))
        loaded = self.load(self.transform(source))
        rows_out = loaded.count()
        # No metric arrives where the optimizer dropped the scan; asking would raise.
        return {"export": self.export_csv(loaded), "rows_out": rows_out, "rows_in": seen.get["rows"] if rows_out else None}

    def run(self) -> Outcome:
        self.before()
        began, error, done = dt.datetime.now(), None, None
        for tries, wait in enumerate(self.retry.waits(), 1):
            try:
                done = self._attempt()
                break
            except Exception as exc:
                error = str(exc)
                log.error("%s: attempt %d: %s", type(self).__name__, tries, error)
                if wait is not None:
                    self.retry.sleep(wait)
        outcome = Outcome(type(self).__name__, self.source_table, self.target_table,
                          "failed" if done is None else "success", began, dt.datetime.now(), tries,
                          error=error if done is None else None, **(done or {}))
        if self.audit_path is not None:
            append_audit(self.spark, self.audit_path, outcome)
        self.after(outcome)
        if done is None:
            raise JobFailed(outcome)
        return outcome

    def loaded(self) -> DataFrame:
        return self.spark.read.parquet(self.target_path)


def append_audit(spark: SparkSession, path: str, *outcomes: Outcome) -> bool:
    """Append audit records. A failing audit is logged and never fails the job."""
    try:
        rows = spark.createDataFrame([o.audit_row() for o in outcomes], AUDIT_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(path)
        return True
    except Exception as exc:
        log.warning("audit record not written: %s", exc)
        return False


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def sla_missed(outcome: Outcome, limit_s: float) -> Outcome | None:
    """The record of a run that took longer than agreed; None if it did not."""
    if outcome.seconds <= limit_s:
        return None
    return replace(outcome, job=f"{outcome.job}.SLA_MISS", status="sla_miss", rows_out=0,
                   error=f"took {outcome.seconds:.1f} s, agreed are {limit_s:.1f} s")


def row_gate(loaded: DataFrame, full: int) -> DataFrame:
    """Which branch follows a load: full validation or a low-count notice."""
    return loaded.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
        "rows_loaded", F.when(F.col("rows_loaded") >= full, "validate_full_load")
        .otherwise("notify_low_count").alias("next_step"))


# --- model chains -------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """A named frame built from other models: kept as a view or written as a table.

    An ``incremental`` model with ``at`` sees its own target: ``build`` gets, beside
    the models, the time from which rows are wanted (None for all: there is no
    target yet), which is the largest stored ``at`` less ``lookback_days``. It
    should put that time into its scans; rows below it are left out in any case.
    ``partition_by`` must follow ``at`` and never change for a key.
    """

    build: Callable[..., DataFrame]
    needs: Sequence[str] = ()
    materialized: str = "table"
    key: str | None = None
    at: str | None = None
    partition_by: str | None = None
    lookback_days: int = 0


def _since(spark: SparkSession, model: Model, path: str) -> dt.datetime | None:
    mark = stored_mark(spark, path, model.at)
    return None if mark is None else mark - dt.timedelta(days=model.lookback_days)


def _increment(spark: SparkSession, model: Model, built: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Build what is newer than the target and upsert it."""
    if model.at is None:
        return upsert_table(spark, path, model.build(built), model.key, model.partition_by)
    since = _since(spark, model, path)
    batch = model.build(built, since)
    if since is not None:
        batch = batch.where(F.col(model.at) > F.lit(since).cast("timestamp_ntz"))
    return upsert_table(spark, path, batch, model.key, model.partition_by, fixed=True)


def build_models(spark: SparkSession, models: Mapping[str, Model], folder: str,
                 workers: int = 4) -> dict[str, DataFrame]:
    """Build models in dependency order; independent tables run as parallel jobs.

    Views stay lazy, so pruning crosses them. Tables are written and read back;
    ``incremental`` ones keep what an earlier build stored in ``folder`` and
    compute only what is newer (see ``Model``).
    """
    built: dict[str, DataFrame] = {}
    order = TopologicalSorter({n: set(m.needs) for n, m in models.items()})
    order.prepare()

    def make(name: str) -> tuple[str, DataFrame]:
        model = models[name]
        if model.materialized == "incremental":
            return name, _increment(spark, model, built, f"{folder}/{name}")
        df = model.build(built)
        return name, write_table(df, f"{folder}/{name}") if model.materialized == "table" else df

    with ThreadPoolExecutor(workers) as pool:
        while order.is_active():
            ready = order.get_ready()
            for name, df in pool.map(make, ready):
                built[name] = df
                order.done(name)
    return built
