"""Table scans: one lazy DataFrame per table, explicit schemas, inventory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymart.session import apply_settings
from quaymart.sources.files import listed

_L, _I, _D, _S, _TS = (T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(),
                       T.TimestampNTZType())


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols.items()])


TABLES: dict[str, T.StructType] = {
    "region": _schema(r_regionkey=_I, r_name=_S),
    "nation": _schema(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _schema(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "supplier": _schema(s_suppkey=_L, s_name=_S, s_nationkey=_I, s_acctbal=_D),
    "part": _schema(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _schema(o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D,
                      o_orderdate=_TS, o_orderpriority=_S),
    "lineitem": _schema(l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I,
                        l_quantity=_D, l_extendedprice=_D, l_discount=_D, l_tax=_D,
                        l_returnflag=_S, l_linestatus=_S, l_shipdate=_TS),
    "events": _schema(event_id=_L, ts=_TS, user_id=_L, event_type=_S, value=_D, props=_S),
    "documents": _schema(doc_id=_L, text=_S, lang=_S, source=_S, n_chars=_L),
    "embeddings": _schema(vec_id=_L, embedding=T.ArrayType(T.FloatType()), label=_I),
    "pages": _schema(page_id=_L, url=_S, html=_S),
    "benchmark": _schema(item_id=_L, text=_S),
    "labels": _schema(doc_id=_L, quality=_I, toxic=_I),
    "conversations": _schema(conv_id=_L, turn=_L, role=_S, text=_S),
}

# Keys of each table, kept here because files do not declare them.
KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
    "events": "event_id", "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id",
    "benchmark": "item_id", "labels": "doc_id",
}
# (table, column) -> (referenced table, column)
FOREIGN_KEYS = {
    ("nation", "n_regionkey"): ("region", "r_regionkey"),
    ("customer", "c_nationkey"): ("nation", "n_nationkey"),
    ("supplier", "s_nationkey"): ("nation", "n_nationkey"),
    ("orders", "o_custkey"): ("customer", "c_custkey"),
    ("lineitem", "l_orderkey"): ("orders", "o_orderkey"),
    ("lineitem", "l_partkey"): ("part", "p_partkey"),
    ("lineitem", "l_suppkey"): ("supplier", "s_suppkey"),
}


class Tables:
    """Lazy scans of a folder of ``<name>.parquet`` tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.scan(name)

    def scan(self, name: str) -> DataFrame:
        """The declared schema saves the footer-reading job of an inferred one."""
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def register(self, names: Iterable[str] = TABLES) -> None:
        """Temp views, so that SQL text can name the tables."""
        for name in names:
            self.scan(name).createOrReplaceTempView(name)

    def sql(self, text: str, names: Iterable[str], **args) -> DataFrame:
        """SQL text over the named tables with named parameter markers."""
        self.register(names)
        return self.spark.sql(text, args=args or None)

    def inventory(self, names: Iterable[str] = TABLES) -> DataFrame:
        """Rows and columns of every table; counts come from file metadata."""
        rows = None
        for name in names:
            one = self.scan(name).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count",
                F.lit(len(TABLES[name])).cast("bigint").alias("column_count"))
            rows = one if rows is None else rows.unionByName(one)
        return rows


def jdbc_scan(spark: SparkSession, url: str, table: str, column: str, lower, upper,
              parts: int, **options: str) -> DataFrame:
    """Parallel read of a database table, split on a numeric or date column."""
    return (spark.read.format("jdbc")
            .options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower),
                     upperBound=str(upper), numPartitions=str(parts), **options)
            .load())


def register_folder(spark: SparkSession, folder: str, database: str) -> list[str]:
    """Put every ``<name>.parquet`` of a folder into the session catalog as an external table.

    The tables read the files where they lie; a table that was registered before
    is replaced, one whose files are gone is dropped. Names are those that the
    catalog takes: letters, digits and underscores.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = sorted(p.rstrip("/").rsplit("/", 1)[1].removesuffix(".parquet") for p in listed(spark, folder) if p.rstrip("/").endswith(".parquet"))
    for known in spark.catalog.listTables(database):
        if not known.isTemporary:
            spark.sql(f"DROP TABLE {database}.`{known.name}`")
    for name in names:
        spark.catalog.createTable(f"{database}.`{name}`", path=f"{folder.rstrip('/')}/{name}.parquet", source="parquet")
    return names


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """``table_name, column_name, data_type, position`` of all tables, as the session catalog has them."""
    rows = [(t.name, c.name, c.dataType, at)
            for t in spark.catalog.listTables(database) if not t.isTemporary
            for at, c in enumerate(spark.catalog.listColumns(f"{database}.`{t.name}`"), start=1)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, position int")


def with_keys(columns: DataFrame) -> DataFrame:
    """Adds ``is_key`` and ``references_column``, which a catalog of files cannot know, from the declared keys."""
    key, ref = F.lit(False), F.lit(None).cast("string")
    for table, column in KEYS.items():
        key = key | ((F.col("table_name") == table) & (F.col("column_name") == column))
    for (table, column), target in FOREIGN_KEYS.items():
        ref = F.when((F.col("table_name") == table) & (F.col("column_name") == column), ".".join(target)).otherwise(ref)
    return columns.withColumns({"is_key": key, "references_column": ref})


def schema_columns(names: Iterable[str] = TABLES) -> list[tuple]:
    """(table, column, type, position, is_key, references) for the catalog query."""
    out = []
    for name in names:
        for pos, field in enumerate(TABLES[name].fields, start=1):
            ref = FOREIGN_KEYS.get((name, field.name))
            out.append((name, field.name, field.dataType.simpleString(), pos,
                        KEYS.get(name) == field.name, ".".join(ref) if ref else None))
    return out
