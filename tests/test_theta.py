"""join_theta on odd parts, over the edges of blocks, and on one group that holds every part."""

import random

import duckdb
from pyspark.sql import functions as F

from millrace.operators import relational
from millrace.sources.tables import Tables

SCHEMA = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def stored(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return Tables(spark, str(tmp_path))


def test_odd_parts_over_many_blocks_equal_the_sql(spark, tmp_path, monkeypatch):
    pick = random.Random(3).choice
    prices = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1.5, 1.5, 2.0, 7.25, -3.0]
    rows = [(pick([None, k, k % 40]), "x", pick([None, "", "A", "A", "B"]), pick([None, "", "t", "t"]), pick([None, -1, 0, 1, 1, 2, 50]), pick(prices)) for k in range(400)]
    tables = stored(spark, tmp_path, rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    order = lambda found: sorted(map(tuple, found), key=str)
    want = order(con.sql(relational.SQL["join_theta"]).fetchall())
    assert len(want) > 1000
    for block in (1, 3, 1024):
        monkeypatch.setattr(relational, "BLOCK_ROWS", block, raising=False)
        assert order(relational.join_theta(tables).collect()) == want


def test_no_parts_give_no_pairs(spark, tmp_path):
    assert relational.join_theta(stored(spark, tmp_path, [])).count() == 0


def test_pairs_of_one_group_are_made_in_several_tasks(spark, tmp_path):
    tables = stored(spark, tmp_path, [(k, "x", "A", "t", k % 50, k * 37 % 6000 / 8) for k in range(6000)])
    tasks = relational.join_theta(tables).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1
    assert max(n for _, n in tasks) < 0.6 * sum(n for _, n in tasks)
