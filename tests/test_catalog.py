"""The session catalog over a folder of tables."""

from quaymart.session import scratch_path
from quaymart.sources import tables as T


def test_tables_come_and_go(spark):
    folder = scratch_path(spark, "tables")
    spark.range(3).write.parquet(f"{folder}/orders.parquet")
    spark.sql("SELECT 1 AS a, array(1.5D) AS b").write.parquet(f"{folder}/odd_1.parquet")
    assert T.register_folder(spark, folder, "quaymart_catalog_test") == ["odd_1", "orders"]
    got = sorted(tuple(r) for r in T.catalog_columns(spark, "quaymart_catalog_test").collect())
    assert got == [("odd_1", "a", "int", 1), ("odd_1", "b", "array<double>", 2), ("orders", "id", "bigint", 1)]
    spark.sql("SELECT 1L AS o_orderkey, 2L AS o_custkey").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    spark.range(1).write.parquet(f"{folder}/late.parquet")
    T.register_folder(spark, folder, "quaymart_catalog_test")
    got = {(r.table_name, r.column_name): r for r in T.with_keys(T.catalog_columns(spark, "quaymart_catalog_test")).collect()}
    assert ("late", "id") in got and ("orders", "id") not in got
    assert got["orders", "o_orderkey"].is_key and got["orders", "o_custkey"].references_column == "customer.c_custkey"
    assert spark.table("quaymart_catalog_test.late").count() == 1
