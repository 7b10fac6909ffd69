"""Flags of suppliers at the edge of a limit: sums follow the table's order, in whatever order rows are read."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone.plans.scanner import Q37, q37_fundamental_flags


@pytest.mark.parametrize("order", ["l_discount desc", "l_discount"])
def test_an_average_at_the_limit_is_that_of_the_sql(spark, tmp_path, order):
    line = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").filter("l_suppkey in (770, 771)")
    line.coalesce(1).sortWithinPartitions("l_orderkey", "l_linenumber").write.parquet(f"{tmp_path}/whole")
    line.coalesce(1).sortWithinPartitions(F.expr(order.split()[0]).desc() if "desc" in order else order).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet("/root/testdata/sf0.1/supplier.parquet").filter("s_suppkey in (770, 771, 772)").write.parquet(f"{tmp_path}/supplier.parquet")
    with duckdb.connect() as c:
        c.sql("SET threads = 1")
        for name, folder in (("lineitem", "whole"), ("supplier", "supplier.parquet")):
            c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{folder}/*.parquet'")
        want = sorted(c.sql(Q37).fetchall())
    assert sorted(tuple(r) for r in q37_fundamental_flags(spark, str(tmp_path)).collect()) == want
