"""Data checks: named checks, generic tests, profiles.

Checks on the same table share one scan. A test yields violation rows; its
verdict is their count.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymart.functions import pct, rint_to
from quaymart.operators.quantiles import brackets, column_quantiles
from quaymart.session import stage


@dataclass(frozen=True)
class Check:
    """A named aggregate of a table and the value it should have."""

    name: str
    table: str
    value: Column
    expected: int


def run_checks(frames: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check_name, value, expected, status, error): PASS, FAIL or ERROR.

    All checks of a table run in one aggregate. A check that cannot be resolved
    (unknown table or column), or that fails while it runs (a bad cast), becomes
    an ERROR row and does not stop the rest: where the shared aggregate fails,
    its checks run one by one.
    """
    spark = next(iter(frames.values())).sparkSession
    rows: dict[str, tuple] = {}

    def attempt(table: str, group: Sequence[Check]) -> None:
        values = frames[table].agg(*[c.value.cast("bigint").alias(f"v{i}") for i, c in enumerate(group)]).first()
        for c, v in zip(group, values):
            rows[c.name] = (c.name, v, c.expected, "PASS" if v == c.expected else "FAIL", None)

    for table in dict.fromkeys(c.table for c in checks):
        group = [c for c in checks if c.table == table]
        try:
            attempt(table, group)
        except Exception:
            for c in group:
                try:
                    attempt(table, [c])
                except Exception as exc:
                    known = exc.getCondition() if isinstance(exc, PySparkException) else None
                    reason = "unknown table" if isinstance(exc, KeyError) else known or type(exc).__name__
                    rows[c.name] = (c.name, None, c.expected, "ERROR", reason)
    schema = "check_name string, value bigint, expected bigint, status string, error string"
    return spark.createDataFrame([rows[c.name] for c in checks], schema)


def check_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status") == "PASS").alias("passed"),
                       F.count_if(F.col("status") != "PASS").alias("failed"))


def null_share(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Share of NULL in percent and whether it exceeds the threshold."""
    one = df.agg(F.count_if(F.col(col).isNull()).alias("null_count"),
                 F.count(F.lit(1)).alias("total"))
    share = pct("null_count", "total", 1)
    over = F.col("null_count") * 100 > F.col("total") * threshold
    return one.select(F.lit(col).alias("column_name"), "null_count", "total",
                      share.alias("null_pct"),
                      F.when(over, "WARNING").otherwise("OK").alias("status"))


# --- generic tests: violation rows -------------------------------------------

def not_unique(df: DataFrame, *cols: str, where: Column | None = None) -> DataFrame:
    """Values that occur more than once, with their count; NULL is not a value."""
    df = df if where is None else df.where(where)
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def is_null(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    df = df if where is None else df.where(where)
    return df.where(F.col(col).isNull())


def not_accepted(df: DataFrame, col: str, values: Iterable, where: Column | None = None) -> DataFrame:
    """Unexpected values and how often they occur; NULL passes."""
    df = df if where is None else df.where(where)
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")))


def orphans(child: DataFrame, col: str, parent: DataFrame, key: str,
            where: Column | None = None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent.

    References are reduced to distinct values first, so a reference shared by
    very many rows meets the parent once.
    """
    child = child if where is None else child.where(where)
    refs = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return refs.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


def verdict(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("test_name"), "failures", (F.col("failures") == 0).alias("passed"))


def run_tests(tests: Mapping[str, DataFrame]) -> DataFrame:
    """One verdict row per test; a test passes when it finds no violation."""
    out = None
    for name, violations in tests.items():
        row = verdict(name, violations)
        out = row if out is None else out.unionByName(row)
    return out


def count_violations(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Verdict rows of tests that look at one row at a time: all of a frame in one aggregate.

    A test is the condition of a violation; NULL is none.
    """
    counts = df.agg(*[F.count_if(bad).alias(f"t{i}") for i, bad in enumerate(tests.values())])
    rows = [F.struct(F.lit(name).alias("test_name"), F.col(f"t{i}").alias("failures"), (F.col(f"t{i}") == 0).alias("passed"))
            for i, name in enumerate(tests)]
    return counts.select(F.inline(F.array(*rows)))


# --- profiles -----------------------------------------------------------------

def duplicate_rows(df: DataFrame) -> Column:
    """Surplus copies of identical rows, as a scalar subquery.

    Equal rows share a hash, so only rows whose 8-byte hash repeats are
    compared in full; the rest of the table is shuffled as hashes alone. Map
    columns cannot be compared and are left out.
    """
    cols = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    tagged = df.select(*cols, F.xxhash64(*cols).alias("__h"))
    repeated = tagged.groupBy("__h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("__h")
    same = tagged.join(repeated, "__h", "left_semi").groupBy(*cols).agg(
        F.count(F.lit(1)).alias("c"))
    return same.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint")).scalar()


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, NULLs, and for numbers min, quartiles, max, mean, deviation.

    One aggregate serves all columns, with a bounded sketch for each number; a
    second pass over the rows counts the values inside the sketched brackets.
    """
    probs, accuracy = (0.25, 0.5, 0.75), 10_000
    fields = df.schema.fields
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"{f.name}__null"))
        if f.name in numeric:
            v = F.col(f.name).cast("double")
            aggs += [F.min(v).alias(f"{f.name}__min"), F.max(v).alias(f"{f.name}__max"),
                     rint_to(F.avg(v), 4).alias(f"{f.name}__avg"),
                     rint_to(F.stddev_samp(v), 4).alias(f"{f.name}__std"), brackets(probs, accuracy, v).alias(f"{f.name}__brackets")]
    none = F.lit(None).cast("double")
    entries = [F.struct(
        F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
        F.col(f"{f.name}__null").alias("null_count"),
        *[(F.col(f"{f.name}__{s}") if f.name in numeric else none).alias(n)
          for s, n in (("min", "min_value"), ("max", "max_value"), ("avg", "mean_value"),
                       ("std", "std_value"))]) for f in fields]
    wide = stage(df.agg(*aggs))
    long = wide.select(F.col("__rows").alias("row_count"), F.explode(F.array(*entries)).alias("e"))
    long = long.select("e.*", "row_count").withColumn(
        "null_pct", pct("null_count", "row_count", 1))
    heads = wide.select(*[F.col(f"{c}__brackets").alias(c) for c in numeric]).first().asDict() if numeric else {}
    quartiles = column_quantiles(df, heads, probs).select(
        "column_name", *[rint_to(F.col(f"q{i}"), 4).alias(n)
                         for i, n in enumerate(("q25", "q50", "q75"))])
    return (long.join(quartiles, "column_name", "left")
            .withColumn("duplicate_rows", duplicate_rows(df)))


def key_profile(frames: Mapping[str, tuple[DataFrame, str, int]]) -> DataFrame:
    """Per table: rows against a minimum, NULL cells, and the span of the key.

    ``frames`` maps a table name to (frame, key column, minimum rows).
    """
    out = None
    for name, (df, key, floor) in frames.items():
        nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("bigint"))
        row = df.agg(F.count(F.lit(1)).alias("row_count"), nulls.alias("null_count"),
                     (F.max(key) - F.min(key)).cast("bigint").alias("key_range"))
        row = row.select(F.lit(name).alias("table_name"), "row_count",
                         F.lit(floor).cast("bigint").alias("min_rows"),
                         (F.col("row_count") >= floor).alias("passed"), "null_count", "key_range")
        out = row if out is None else out.unionByName(row)
    return out


def pass_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"),
                       F.count_if(~F.col("passed")).alias("failed"))


def config_count_check(spark: SparkSession, config_json: str, counts: DataFrame) -> DataFrame:
    """Minimum row counts from a JSON text ``{name: {target, min_rows}}``.

    A target without a count fails instead of vanishing.
    """
    parsed = F.from_json(F.lit(config_json), "map<string, struct<target: string, min_rows: bigint>>")
    rules = spark.range(1).select(F.explode(parsed).alias("job", "c")).select(
        "job", F.col("c.target").alias("table_name"), F.col("c.min_rows").alias("min_rows"))
    return rules.join(counts.select("table_name", "row_count"), "table_name", "left").select(
        "job", "table_name", "row_count", "min_rows",
        F.coalesce(F.col("row_count") >= F.col("min_rows"), F.lit(False)).alias("passed"))
